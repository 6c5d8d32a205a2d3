"""Mining of candidates for queries: keywords, search with variants, one list of candidates, review, selection.

Search results are rows (search_query, rank, ...) of any source (sources.search). All steps are keyed on
the query; a search query with very many results is cut to the wanted ranks before it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.functions.text import archive_id, is_pdf_link, list_in_prose, object_in_prose, search_variants, strip, title_key, venue_of_summary, year_in
from corpusforge.operators.textmodel import Model, answered, rendered

# Labels of a review; names kept; results asked for at least; keywords and authors kept.
LABELS = ("positive", "hard_negative", "ignored")
LEAST_RESULTS, MOST_KEYWORDS, MOST_AUTHORS, MOST_NEGATIVES = 3, 5, 6, 5
ARCHIVE_PDF = "https://arxiv.org/pdf/"


def keywords_in(answer: Column, most: int = MOST_KEYWORDS) -> Column:
    """The first entries of the array in an answer, stripped, without blanks; an empty array where there is none."""
    words = F.transform(list_in_prose(answer), lambda w: strip(F.coalesce(F.try_variant_get(w, "$", "string"), F.to_json(w))))
    return F.coalesce(F.slice(F.filter(words, lambda w: w != ""), 1, most), F.array().cast("array<string>"))


def results_per_variant(n_variants: Column, most: int) -> Column:
    """How many results to ask for with each of several search queries."""
    return F.greatest(F.lit(LEAST_RESULTS), F.floor(F.lit(most) / F.greatest(n_variants, F.lit(1)))).cast("int")


def pdf_link(pdf_url: Column, archive: Column, url: Column) -> Column:
    """The link of the text: as given, else by archive number, else the page's own if it is a PDF."""
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(blank(pdf_url), F.concat(F.lit(ARCHIVE_PDF), blank(archive), F.lit(".pdf")), F.when(is_pdf_link(strip(url)), strip(url)))


def download_state(link: Column, kept: Column, error: Column, size: Column, head: Column, content_type: Column, download: bool = True) -> tuple[Column, Column]:
    """(status, error) of the text of a candidate: url_only or unavailable without downloads, else downloaded, failed or unavailable.

    kept: the file is there already. error: of the request. size, head, content_type: of what came back; a text begins with
    %PDF or is declared as a PDF.
    """
    none = F.lit("no link of a PDF")
    if not download:
        return F.when(link.isNotNull(), "url_only").otherwise("unavailable"), F.when(link.isNull(), none)
    pdf = F.startswith(F.coalesce(head, F.lit("")), F.lit("%PDF")) | F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("pdf"))
    wrong = F.when(error.isNotNull(), error).when(F.coalesce(size, F.lit(0)) <= 0, "empty response").when(~pdf, F.concat(F.lit("no PDF: "), F.coalesce(content_type, F.lit("unknown"))))
    have = F.coalesce(kept, F.lit(False))
    return F.when(link.isNull(), "unavailable").when(have | wrong.isNull(), "downloaded").otherwise("failed"), F.when(link.isNull(), none).when(~have, wrong)


def searched(queries: DataFrame, index: DataFrame, on: list[str], most: int) -> DataFrame:
    """(on, place, columns of index): candidates of every query (on, variants array<string>).

    Each variant takes its first results by rank; of several results with one title the first by variant and
    rank holds; blank titles are left out; place counts from 0 and stays below `most`.
    """
    most = max(LEAST_RESULTS, most)
    asked = queries.select(*on, F.posexplode("variants").alias("_variant", "_q"), results_per_variant(F.size("variants"), most).alias("_n")).withColumn("_q", F.lower(strip(F.col("_q"))))
    ranked = index.withColumn("_q", F.lower(strip(F.col("search_query")))).withColumn("_k", F.row_number().over(W.partitionBy("_q").orderBy("rank"))).where(F.col("_k") <= most)
    met = asked.join(ranked, "_q").where(F.col("_k") <= F.col("_n")).withColumn("_t", title_key(F.col("paper_title"))).where("_t is not null")
    first = met.withColumn("_f", F.row_number().over(W.partitionBy(*on, "_t").orderBy("_variant", "_k"))).where("_f = 1")
    placed = first.withColumn("place", F.row_number().over(W.partitionBy(*on).orderBy("_variant", "_k")) - 1).where(F.col("place") < most)
    return placed.drop("_q", "_n", "_k", "_t", "_f", "_variant", "search_query", "rank")


def review_prompt(query: Column) -> Column:
    """The prompt that a candidate (paper_title, authors, year, venue, abstract, pdf_url) is reviewed with; it names the link of the text, for models that read it."""
    fields = {
        "query": query, "title": F.col("paper_title"), "authors": F.coalesce(F.nullif(F.array_join(F.slice("authors", 1, MOST_AUTHORS), ", "), F.lit("")), F.lit("unknown")),
        "year": F.coalesce(F.col("year").cast("string"), F.lit("unknown")), "venue": F.coalesce("venue", F.lit("unknown")), "abstract": F.coalesce("abstract", F.lit("none")), "link": F.col("pdf_url"),
    }
    return rendered("Query: {{query}}\nTitle: {{title}}\nAuthors: {{authors}}\nYear: {{year}}\nVenue: {{venue}}\nAbstract: {{abstract}}\nText: {{link}}\nAnswer as JSON with label and reason.", fields)


def reviewed(candidates: DataFrame, query: str, model: Model, **calls) -> DataFrame:
    """candidates with pdf_url, label and reason. Those without a link of their text are not asked for; answers with no known label are left out."""
    linked = candidates.withColumn("pdf_url", pdf_link(F.col("pdf_url"), F.col("arxiv_id"), F.col("url"))).where("pdf_url is not null")
    out = answered(linked.withColumn("_prompt", review_prompt(F.col(query))), "_prompt", model, **calls)
    data = object_in_prose(F.col("answer"))
    get = lambda p: strip(F.coalesce(F.try_variant_get(data, p, "string"), F.lit("")))
    return out.withColumns({"label": F.lower(get("$.label")), "reason": get("$.reason")}).where(F.col("label").isin(*LABELS)).drop("_prompt", "prompt_hash", "answer")


def selected(reviews: DataFrame, on: list[str], most: int = MOST_NEGATIVES) -> DataFrame:
    """Positives, and the first hard negatives of every query, with k from 1 by place."""
    k = F.row_number().over(W.partitionBy(*on, "label").orderBy("place"))
    return reviews.where("label in ('positive', 'hard_negative')").withColumn("k", k).where((F.col("label") == "positive") | (F.col("k") <= most))


def mined(queries: DataFrame, index: DataFrame, on: list[str], query: str, keyword_model: Model, review_model: Model, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """(queries with keywords, variants and n_candidates; the selected candidates): the whole way from a query to its candidates."""
    prompt = rendered("Give up to five keywords as a JSON array.\n{{query}}", {"query": F.regexp_replace(F.col(query), r"[\r\n]+", " ")})
    asked = answered(queries.withColumn("_prompt", prompt), "_prompt", keyword_model).withColumn("keywords", keywords_in(F.col("answer"))).drop("_prompt", "prompt_hash", "answer")
    asked = asked.withColumn("variants", search_variants(F.col(query), F.col("keywords")))
    found = searched(asked.select(*on, "variants"), index, on, most)
    counts = found.groupBy(*on).agg(F.count("*").alias("n_candidates"))
    runs = asked.join(counts, on, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    return runs, selected(reviewed(found.join(queries.select(*on, query), on), query, review_model), on)


CANDIDATE = ("paper_title", "arxiv_id", "abstract", "venue", "year", "authors", "url", "pdf_url", "citations", "source")


def _strings_of(value: Column) -> Column:
    """All texts in a variant: itself, or the texts of its elements and fields, down to the fourth level (such records are no deeper)."""
    text = lambda v: F.array_compact(F.array(F.when(~F.coalesce(F.schema_of_variant(v), F.lit("VOID")).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(v, "$", "string"))))
    below = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<variant>"))
    levels = [F.array(value)]
    for _ in range(4):
        levels.append(F.flatten(F.transform(levels[-1], below)))
    return F.concat(*[F.flatten(F.transform(level, text)) for level in levels])


def _first_of(values: Column, found) -> Column:
    return F.get(F.filter(F.transform(values, found), lambda x: x.isNotNull()), F.lit(0))


def record_of_service(item: Column) -> dict[str, Column]:
    """CANDIDATE columns of a result of a search service (a variant with title, link, snippet, publication_info, resources, inline_links)."""
    get = lambda p, kind="string": F.try_variant_get(item, p, kind)
    info = get("$.publication_info", "variant")
    summary = F.coalesce(get("$.publication_info.summary"), F.when(F.schema_of_variant(info) == "STRING", F.try_variant_get(info, "$", "string")))
    names = F.filter(F.transform(get("$.publication_info.authors", "array<variant>"), lambda a: strip(F.try_variant_get(a, "$.name", "string"))), lambda n: n != "")
    texts = F.concat(_strings_of(get("$.link", "variant")), F.coalesce(_strings_of(get("$.resources", "variant")), F.array().cast("array<string>")), F.coalesce(_strings_of(info), F.array().cast("array<string>")))
    links = F.concat(F.coalesce(_strings_of(get("$.resources", "variant")), F.array().cast("array<string>")), F.coalesce(_strings_of(get("$.link", "variant")), F.array().cast("array<string>")))
    archive = _first_of(texts, archive_id)
    return {
        "paper_title": strip(get("$.title")), "arxiv_id": archive, "abstract": F.nullif(strip(get("$.snippet")), F.lit("")), "venue": venue_of_summary(summary), "year": year_in(summary), "authors": F.coalesce(names, F.array().cast("array<string>")),
        "url": get("$.link"), "pdf_url": F.coalesce(_first_of(links, lambda t: F.when(is_pdf_link(strip(t)), strip(t))), F.concat(F.lit(ARCHIVE_PDF), archive, F.lit(".pdf"))),
        "citations": get("$.inline_links.cited_by.total", "int"), "source": F.lit("google_scholar_serpapi"),
    }


def record_of_library(item: Column) -> dict[str, Column]:
    """CANDIDATE columns of a publication of a search library (a variant with bib, pub_url, eprint_url, num_citations)."""
    get = lambda p, kind="string": F.try_variant_get(item, p, kind)
    text = lambda *paths: F.coalesce(*[F.nullif(strip(get(p)), F.lit("")) for p in paths])
    names = F.coalesce(get("$.bib.author", "array<string>"), F.split(get("$.bib.author"), " and "))
    several = lambda *paths: F.array_compact(F.array(*[get(p) for p in paths]))
    archive = _first_of(several("$.pub_url", "$.eprint_url", "$.bib.url"), archive_id)
    return {
        "paper_title": text("$.bib.title", "$.title"), "arxiv_id": archive, "abstract": text("$.bib.abstract"), "venue": text("$.bib.venue", "$.bib.journal"), "year": get("$.bib.pub_year").try_cast("int"),
        "authors": F.coalesce(F.filter(F.transform(names, strip), lambda n: n != ""), F.array().cast("array<string>")), "url": text("$.pub_url", "$.bib.url"),
        "pdf_url": F.coalesce(_first_of(several("$.eprint_url", "$.pub_url", "$.bib.url"), lambda t: F.when(is_pdf_link(strip(t)), strip(t))), F.concat(F.lit(ARCHIVE_PDF), archive, F.lit(".pdf"))),
        "citations": get("$.num_citations", "int"), "source": F.lit("google_scholar_scholarly"),
    }


def candidates_in(records: DataFrame, item: str, keep: list[str], of=record_of_service) -> DataFrame:
    """(keep, CANDIDATE) of raw records in the variant column `item`; records without a title are left out."""
    columns = of(F.col(item))
    return records.select(*keep, *[columns[c].alias(c) for c in CANDIDATE]).where(F.coalesce(F.col("paper_title"), F.lit("")) != "")


def as_selected(candidates: DataFrame, label: str, query: str) -> DataFrame:
    """Selected candidates under the names of their list: the reason as `<label>_reason`, the query as source_query."""
    return candidates.where(F.col("label") == label).withColumnRenamed("reason", f"{label}_reason").withColumn("source_query", F.col(query)).drop("label")
