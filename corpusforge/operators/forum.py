"""Forum threads as a download sees them: raw notes, papers made of submissions, kinds, what is kept and why.

Raw notes are rows (id, forum, replyto, invitation, invitations array<string>, number string, cdate,
tcdate, content variant, pos). Nulls in any column have a result: an unreadable number is 0, a note
without id gets one from its thread, kind and place, a thread without notes has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import is_fallback_venue, nonempty, strip, venue_of_path, year_in
from corpusforge.operators.notes import kind, renamed_fields
from corpusforge.operators.ranking import ranked

# Addresses of a thread and of its text; the invitation of a note that has none.
FORUM_URL, PDF_URL, NO_INVITATION = "https://openreview.net/forum?id=", "https://openreview.net/pdf?id=", "unknown_invitation"
NOTE_FIELDS = ("id", "invitation", "invitations", "number", "forum", "replyto", "signatures", "readers", "writers", "cdate", "tcdate", "content")


def normalized_content(content: Column) -> Column:
    """map<string,variant> of a content: every {"value": x} as x; an empty map for what is no object."""
    fields = F.try_variant_get(content, "$", "map<string,variant>")

    def plain(_: Column, value: Column) -> Column:
        inner = F.try_variant_get(value, "$", "map<string,variant>")
        return F.when(F.map_contains_key(inner, F.lit("value")), inner["value"]).otherwise(value)

    return F.coalesce(F.transform_values(fields, plain), F.from_json(F.lit("{}"), "map<string,string>").cast("map<string,variant>"))


def text_of(fields: Column, name: str) -> Column:
    """A field of a normalized content as text."""
    return F.try_variant_get(fields[name], "$", "string")


def review_content(fields: Column) -> Column:
    """map<string,string> of a normalized content under the newer field names, null values left out."""
    return renamed_fields(F.transform_values(fields, lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.nullif(F.to_json(v), F.lit("null")))))


def projected(notes: DataFrame) -> DataFrame:
    """NOTE_FIELDS of notes, with the content normalized; columns that a source lacks are null, others are left out."""
    have = set(notes.columns)
    return notes.select(*[normalized_content(F.col("content")).alias("content") if c == "content" else F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in NOTE_FIELDS])


def listed(value: Column) -> Column:
    """array<string> of a variant that is a list, or of a text parted by commas; blanks left out; else empty."""
    parts = F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.filter(F.transform(F.split(F.try_variant_get(value, "$", "string"), ","), strip), lambda x: x != ""))
    return F.coalesce(parts, F.array().cast("array<string>"))


def papers_of(submissions: DataFrame, venue: str, year: int) -> DataFrame:
    """(id, title, abstract, authors, keywords, venue, year, pdf_url, forum_url, venueid, submission_number) of submission notes.

    The venue is the first of: its name in the content, the name in its path, the one in the
    invitation, the path, the given one. The year likewise.
    """
    s = submissions.withColumn("_f", normalized_content(F.col("content")))
    get = lambda n: text_of(F.col("_f"), n)
    path, invited = nonempty(get("venueid")), F.concat_ws(" ", F.col("invitation"), F.array_join(F.col("invitations"), " "))
    return s.select(
        "id", F.coalesce(get("title"), F.lit("")).alias("title"), F.coalesce(get("abstract"), F.lit("")).alias("abstract"), listed(F.col("_f")["authors"]).alias("authors"), listed(F.col("_f")["keywords"]).alias("keywords"),
        F.coalesce(nonempty(get("venue"), get("venue_name"), venue_of_path(path), venue_of_path(F.nullif(invited, F.lit(""))), path), F.lit(venue)).alias("venue"),
        F.coalesce(year_in(nonempty(get("year"))), year_in(path), year_in(invited), F.lit(year)).alias("year"),
        F.concat(F.lit(PDF_URL), "id").alias("pdf_url"), F.concat(F.lit(FORUM_URL), "id").alias("forum_url"), path.alias("venueid"), F.col("number").try_cast("bigint").alias("submission_number"),
    )


def thread_notes(replies: DataFrame, notes: DataFrame) -> DataFrame:
    """The notes of threads from direct replies and from the threads themselves: of one id the first holds, replies before others; submissions and notes without id are left out."""
    both = replies.withColumn("_s", F.lit(0)).unionByName(notes.withColumn("_s", F.lit(1)), allowMissingColumns=True).where("id is not null and id <> '' and id <> forum")
    rest = [c for c in both.columns if c not in ("id", "forum", "_s")]
    first = both.groupBy("forum", "id").agg(F.min_by(F.struct(*rest), F.struct("_s", "pos")).alias("r"))
    return first.select("forum", "id", "r.*")


def split_notes(notes: DataFrame) -> DataFrame:
    """(forum, id, kind, invitation, number, content map<string,string>, pos): every note with its kind; ids and invitations that are missing are made up."""
    named = F.filter("invitations", lambda i: F.coalesce(i != "", F.lit(False)))
    fields = normalized_content(F.col("content"))
    all_invitations = F.concat_ws(" ", F.col("invitation"), F.array_join(F.coalesce(named, F.array().cast("array<string>")), " "))
    typed = notes.withColumn("_f", fields).withColumn("kind", kind(all_invitations, F.map_keys("_f")))
    return typed.select(
        "forum", F.coalesce(F.nullif(F.col("id"), F.lit("")), F.concat_ws("_", "forum", "kind", F.col("pos").cast("string"))).alias("id"), "kind",
        F.coalesce(F.nullif(F.col("invitation"), F.lit("")), F.get(named, F.lit(0)), F.lit(NO_INVITATION)).alias("invitation"), F.coalesce(F.col("number").try_cast("bigint"), F.lit(0)).alias("number"), review_content(F.col("_f")).alias("content"), "pos",
    )


def thread_states(papers: DataFrame, split: DataFrame, accepted: Column) -> DataFrame:
    """(id, n_reviews, n_decisions, state) of every paper: the first of no_reviews, no_decision, not_accepted that holds, else ok.

    `accepted` is a condition on `content` of the thread's first decision. Threads are folded to
    counts and one row before the join, so a hot thread costs nothing.
    """
    first = F.min_by(F.struct("content"), F.when(F.col("kind") == "decision", F.struct("pos", "id")))["content"]
    folded = split.groupBy(F.col("forum").alias("id")).agg(F.count_if(F.col("kind") == "review").alias("n_reviews"), F.count_if(F.col("kind") == "decision").alias("n_decisions"), first.alias("content"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    state = F.when(n("n_reviews") == 0, "no_reviews").when(n("n_decisions") == 0, "no_decision").when(~F.coalesce(accepted, F.lit(False)), "not_accepted").otherwise("ok")
    return papers.select("id").distinct().join(folded, "id", "left").select("id", n("n_reviews").alias("n_reviews"), n("n_decisions").alias("n_decisions"), state.alias("state"))


def requested_ids(spec: Column) -> Column:
    """The ids of a comma-separated text, stripped, in order, blanks and repeats left out."""
    return F.array_distinct(F.filter(F.transform(F.split(spec, ","), strip), lambda x: x != ""))


def to_fetch(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(id, stale): the wanted ids that are not present, and the present ones whose venue is only a fall-back name (stale)."""
    state = present.groupBy("id").agg(F.max_by("venue", "pos").alias("venue"))
    joined = wanted.select("id").where("id is not null").distinct().join(state.withColumn("_there", F.lit(True)), "id", "left")
    return joined.where(F.col("_there").isNull() | is_fallback_venue(F.col("venue"))).select("id", F.col("_there").isNotNull().alias("stale"))


def skipped_filter(papers: DataFrame) -> DataFrame:
    """papers as if they had passed the rules: passed, accepted and has_mentions true, is_similar false."""
    return papers.withColumns({"passed": F.lit(True), "accepted": F.lit(True), "is_similar": F.lit(False), "has_mentions": F.lit(True)})


def content_lines(split: DataFrame, sections: dict[str, str], page: int = 200) -> DataFrame:
    """(forum, section, page, text): notes as '[Section/Entry n/key] key: value' lines, in pages of so many entries, each section headed by its name.

    sections: kind -> name. A thread is many rows, so none grows with the thread; decisions have no entry.
    """
    names = F.create_map(*[F.lit(x) for pair in sections.items() for x in pair])
    rows = ranked(split.where(F.col("kind").isin(*sections)).withColumn("section", names[F.col("kind")]), ["forum", "section"], [F.col("pos"), F.col("id")], "n")
    where = F.when(F.col("kind") == "decision", F.col("section")).otherwise(F.concat(F.col("section"), F.lit("/Entry "), F.col("n").cast("string")))
    lines = F.transform(F.array_sort(F.map_entries("content")), lambda e: F.concat(F.lit("["), F.col("_w"), F.lit("/"), e["key"], F.lit("] "), e["key"], F.lit(": "), e["value"]))
    told = rows.withColumn("_w", where).select("forum", "section", F.floor((F.col("n") - 1) / page).cast("int").alias("page"), "n", F.array_join(lines, "\n").alias("text"))
    paged = told.groupBy("forum", "section", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return paged.select("forum", "section", "page", F.when(F.col("page") == 0, F.concat(F.lit("=== "), "section", F.lit(" ===\n"), "text")).otherwise(F.col("text")).alias("text"))
