"""A feedback store: unpivot, pivot, upsert, delete, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import field_id, strip

KEY = ["paper_forum_id", "query_id", "feedback_item_id", "reviewer_username"]
#: The two items that stand for the query itself; all others name a candidate.
QUERY_ITEMS = ("query_relevance", "human_like")


def upserted(stored: DataFrame, incoming: DataFrame, key: list[str] = KEY, when: str = "updated_at", row_id: str = "id") -> DataFrame:
    """Rows after an insert-or-update by key: the latest row of a key holds, with the created_at and id of its first.

    Later is by `when`, then id. Rows with a null in the key are each kept out. One shuffle on the key.
    """
    rows = stored.unionByName(incoming, allowMissingColumns=True)
    rows = rows.where(F.expr(" and ".join(f"`{c}` is not null" for c in key)))
    others = [c for c in rows.columns if c not in (*key, row_id, "created_at")]
    last = F.max_by(F.struct(*others), F.struct(when, row_id))
    return rows.groupBy(*key).agg(F.min(row_id).alias(row_id), F.min("created_at").alias("created_at"), last.alias("_r")).select(row_id, *key, "created_at", "_r.*")


def deleted(stored: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not among the doomed keys."""
    return stored.join(doomed.select(*key).distinct(), key, "left_anti")


def deleted_count(stored: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    """One row (n_deleted): how many rows deleted() takes away."""
    return stored.join(doomed.select(*key).distinct(), key, "left_semi").agg(F.count("*").alias("n_deleted"))


def kind_and_place(item: Column) -> tuple[Column, Column]:
    """('hard_negative', 3) of 'hard_negative:3'; place null for the items of the query itself."""
    return F.split_part(item, F.lit(":"), F.lit(1)), F.nullif(F.split_part(item, F.lit(":"), F.lit(2)), F.lit("")).try_cast("int")


def pivoted(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row per `by`: answers of the query items as columns, the candidates' answers as a map; later rows win."""
    at = F.struct(*order)
    last = rows.groupBy(*by, "feedback_item_id").agg(F.max_by("judgement", at).alias("judgement"))
    return last.groupBy(*by).agg(
        *[F.max(F.when(F.col("feedback_item_id") == item, F.col("judgement"))).alias(item) for item in QUERY_ITEMS],
        F.map_from_entries(F.array_sort(F.filter(F.collect_list(F.when(~F.col("feedback_item_id").isin(*QUERY_ITEMS), F.struct("feedback_item_id", "judgement"))), lambda x: x.isNotNull()))).alias("candidates"),
    )


def unpivoted(payloads: DataFrame, by: list[str]) -> DataFrame:
    """The rows of pivoted(): one per item with an answer."""
    fixed = F.array(*[F.struct(F.lit(i).alias("key"), F.col(i).alias("value")) for i in QUERY_ITEMS])
    items = F.concat(fixed, F.coalesce(F.map_entries("candidates"), F.array().cast("array<struct<key:string,value:string>>")))
    return payloads.select(*by, F.inline(items)).where("value is not null").select(*by, F.col("key").alias("feedback_item_id"), F.col("value").alias("judgement"))


def parsed_json(c: Column) -> Column:
    """Text that starts like an array or object as a parsed value, if it parses; else null."""
    return F.when(c.rlike(r"^\s*[\[{]"), F.try_parse_json(c))


def exported(rows: DataFrame) -> DataFrame:
    """(paper_forum_id, query_id, reviewer_username, items, latest): the export, one row per review with its items in order.

    Rows are written partitioned by paper, so the nesting paper, query, reviewer is that of the keys; a
    paper with a large part of all feedback never becomes one row.
    """
    return rows.groupBy("paper_forum_id", "query_id", "reviewer_username").agg(
        F.array_sort(F.collect_list(F.struct("feedback_item_id", "id", "judgement", "reason_note"))).alias("items"), F.max("updated_at").alias("latest")
    )


def export_counts(export: DataFrame) -> DataFrame:
    """(paper_forum_id, n_queries, n_reviews, n_rows, latest) of an export."""
    return export.groupBy("paper_forum_id").agg(F.count_distinct("query_id").alias("n_queries"), F.count_distinct(F.when(F.col("query_id").isNotNull() & F.col("reviewer_username").isNotNull(), F.struct("query_id", "reviewer_username"))).alias("n_reviews"), F.sum(F.size("items")).alias("n_rows"), F.max("latest").alias("latest"))


def overview(rows: DataFrame) -> DataFrame:
    """One row: distinct reviewers with a name, papers and queries."""
    return rows.agg(F.count_distinct(F.nullif("reviewer_username", F.lit(""))).alias("n_reviewers"), F.count_distinct("paper_forum_id").alias("n_papers"), F.count_distinct("query_id").alias("n_queries"))


# The full payload: what is kept of the answers besides the judgement.

PARTS = {"query_relevance": ("query_paper_relevance", "relevance"), "human_like": ("human_like_search", "real_researcher_search")}  # fixed values: item -> part of a payload, field of its judgement
CANDIDATE_FIELD, MOST_CANDIDATES = "label_correct", 8  # fixed values: field of a candidate's judgement, candidates judged at a time
PAPER_ALIASES, QUERY_ALIASES = ("paper_forum_id", "forum_id", "paper_id", "openreview_forum_id"), ("query_id", "query_key")


def paper_of(context: Column) -> Column:
    """The id of a paper under the first of its names that is not empty (context: map of texts)."""
    return F.coalesce(*[F.nullif(context[n], F.lit("")) for n in PAPER_ALIASES])


def query_of(context: Column) -> Column:
    """The id of a query: as given, else 'paper::view::number of the text'; null without a text."""
    made = F.concat_ws("::", paper_of(context), F.coalesce(F.nullif(context["source_view"], F.lit("")), F.lit("unknown_view")), field_id(context["query_text"]))
    return F.coalesce(*[F.nullif(context[n], F.lit("")) for n in QUERY_ALIASES], F.when(paper_of(context).isNotNull() & context["query_text"].isNotNull(), made))


def candidate_items(queries: DataFrame, negatives: str = "hard_negatives", positives: str = "positives", title: str = "paper_title") -> DataFrame:
    """queries with `items`: array<struct<key, label, expected>> of both lists, numbered from 1: 'hard_negative:1', 'Hard Negative 1: title'."""
    def of(column: str, key: str, name: str) -> Column:
        return F.transform(F.col(column), lambda c, i: F.struct(F.concat(F.lit(key + ":"), (i + 1).cast("string")).alias("key"), F.concat(F.lit(name + " "), (i + 1).cast("string"), F.lit(": "), F.coalesce(c[title], F.lit("Untitled"))).alias("label"), F.lit(name).alias("expected")))

    empty = F.array().cast("array<struct<key:string,label:string,expected:string>>")
    return queries.withColumn("items", F.concat(F.coalesce(of(negatives, "hard_negative", "Hard Negative"), empty), F.coalesce(of(positives, "positive", "Positive"), empty)))


def payload_rows(payloads: DataFrame, payload: str, by: list[str]) -> DataFrame:
    """(by, feedback_item_id, judgement, selection, reason_note, raw): one row per judged item of nested payloads (variant); items without a judgement are left out.

    selection is the JSON of a list (one value counts as a list), raw the JSON of the item as given.
    """
    p = F.col(payload)
    fixed = [F.struct(F.lit(item).alias("item"), F.lit(field).alias("field"), F.try_variant_get(p, f"$.{part}", "variant").alias("v")) for item, (part, field) in PARTS.items()]
    checks = F.transform(F.map_entries(F.coalesce(F.try_variant_get(p, "$.candidate_checks", "map<string,variant>"), F.create_map().cast("map<string,variant>"))), lambda e: F.struct(e["key"].alias("item"), F.lit(CANDIDATE_FIELD).alias("field"), e["value"].alias("v")))
    rows = payloads.select(*by, F.explode(F.concat(F.array(*fixed), checks)).alias("e"))
    get = lambda *names: F.coalesce(*[F.try_variant_get("e.v", f"$.{n}", "string") for n in names])
    judged = F.when(F.col("e.item") == "query_relevance", get("relevance")).when(F.col("e.item") == "human_like", get("real_researcher_search")).otherwise(get(CANDIDATE_FIELD))
    picked = F.coalesce(*[F.try_variant_get("e.v", f"$.{n}", "variant") for n in ("non_human_like_type", "wrong_label_type")])
    several = F.when(F.startswith(F.schema_of_variant(picked), F.lit("ARRAY")), F.nullif(F.to_json(picked), F.lit("[]"))).when(F.schema_of_variant(picked) != "VOID", F.concat(F.lit("["), F.to_json(picked), F.lit("]")))
    out = rows.select(*by, F.col("e.item").alias("feedback_item_id"), strip(judged).alias("judgement"), several.alias("selection"), F.nullif(get("notes"), F.lit("")).alias("reason_note"), F.to_json("e.v").alias("raw"))
    return out.where("judgement <> ''")


def payload_of(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, payload map item -> JSON text, reviewer, latest): rows put together again; later rows win; the stored JSON counts where it is an object with fields, else one is made of the columns.

    reviewer and latest are those of the latest row by updated_at, then id. With the reviewer among `by` there is one
    payload per reviewer, without it all are merged into one.
    """
    stored = F.try_parse_json("feedback_raw_json")
    full = F.startswith(F.schema_of_variant(stored), F.lit("OBJECT<")) & (F.to_json(stored) != "{}")
    notes = F.coalesce("reason_note", F.lit(""))
    picked = F.coalesce(F.try_parse_json("selection_type"), F.parse_json(F.lit("[]")))
    item = F.col("feedback_item_id")
    made = (
        F.when(item == "query_relevance", F.to_json(F.struct(F.col("judgement").alias("relevance"), notes.alias("notes"))))
        .when(item == "human_like", F.to_json(F.struct(F.col("judgement").alias("real_researcher_search"), picked.alias("non_human_like_type"), F.lit("").alias("non_human_like_other"), notes.alias("notes"))))
        .otherwise(F.to_json(F.struct(F.col("judgement").alias("label_correct"), picked.alias("wrong_label_type"), notes.alias("notes"))))
    )
    told = rows.where("feedback_item_id is not null and feedback_item_id <> ''").withColumn("_j", F.when(full, F.to_json(stored)).otherwise(made))
    at = F.struct("updated_at", "id")
    last = told.groupBy(*by, "feedback_item_id").agg(F.max_by("_j", at).alias("j"), F.max(at).alias("at"), F.max_by("reviewer_username", at).alias("who"))
    return last.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feedback_item_id", "j")))).alias("payload"), F.max_by("who", "at").alias("reviewer"), F.max("at")["updated_at"].alias("latest"))


def payload_errors(answers: DataFrame) -> Column:
    """array<string>: what is missing in answers (query_key, relevance, real_search, types array<string>, other, checks array<struct<label, label_correct, wrong_type array<string>>>)."""
    c = F.col
    blank = lambda x: F.coalesce(x == "", F.lit(True))
    none = lambda x: F.coalesce(F.size(x) <= 0, F.lit(True))
    no = F.coalesce(c("real_search") == "No", F.lit(False))
    other = no & F.coalesce(F.array_contains("types", F.lit("Other")), F.lit(False)) & blank(strip(c("other")))
    fixed = F.array(
        F.when(blank(c("relevance")), "query-paper relevance"), F.when(blank(c("real_search")), "human-like search"), F.when(no & none(c("types")), "non human-like type"), F.when(other, "non human-like other reason")
    )
    each = F.flatten(F.transform(F.slice(F.coalesce(c("checks"), F.array().cast("array<struct<label:string,label_correct:string,wrong_type:array<string>>>")), 1, MOST_CANDIDATES), lambda k: F.array(
        F.when(blank(k["label_correct"]), F.concat(k["label"], F.lit(" label check"))), F.when((k["label_correct"] == "No") & none(k["wrong_type"]), F.concat(k["label"], F.lit(" wrong-label type")))
    )))
    return F.when(blank(c("query_key")), F.array(F.lit("No query selected"))).otherwise(F.array_compact(F.concat(fixed, each)))


def has_feedback(queries: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """queries with `saved`: whether any row of theirs is stored."""
    known = rows.select(*on).where(F.expr(" and ".join(f"`{c}` is not null" for c in on))).distinct().withColumn("saved", F.lit(True))
    return queries.join(known, on, "left").withColumn("saved", F.coalesce("saved", F.lit(False)))


def listed(rows: DataFrame, reviewer: str | None = None) -> DataFrame:
    """Rows, of one reviewer if named, in the order of an export: paper, query, reviewer, item, then id."""
    kept = rows if reviewer is None else rows.where(F.col("reviewer_username") == reviewer)
    return kept.orderBy("paper_forum_id", "query_id", "reviewer_username", "feedback_item_id", "id")
