"""Summaries of papers by view, and queries made from them: prompts, reading of the answers, texts.

Answers are read in the JVM from variants. Defined cases: an answer without JSON gives one view (query) named `general`
with the start of the answer; a view that is missing or of another shape is empty; bullets may be
objects or plain text under several names, blanks are left out and the rest is numbered from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import object_in_prose, strip
from corpusforge.operators.notes import bullet_number

# Views of a paper; names under which parts of a bullet and of a query may stand, the newest first; lengths kept of an answer without JSON.
VIEWS = ("contribution", "method/dataset", "experiment/result", "limitation/scope")
BULLET_TEXT, BULLET_REFS = ("text", "bullet_point", "content"), ("source_refs", "sources", "source_paths")
JUSTIFICATION = ("related_bullet_justification", "related_bulletpoint_justification", "related_bullet_point_justification", "justification", "relation_justification")
SUMMARY_START, QUERY_START = 500, 200
MULTIMODAL = "(multimodal)"
BULLETS = "array<struct<index:int,text:string,source_refs:array<string>>>"


def view_key(name: Column) -> Column:
    """The name of a view as a key: '/' and blanks as underscores."""
    return F.regexp_replace(name, "[/ ]", "_")


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _text(value: Column, *paths: str) -> Column:
    """The first of the fields that is not blank, as it stands."""
    return F.coalesce(*[F.when(strip(F.try_variant_get(value, p, "string")) != "", F.try_variant_get(value, p, "string")) for p in paths])


def _listed(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def bullets(items: Column) -> Column:
    """BULLETS of an array of variants: objects or plain text; blanks are left out, the rest is numbered from 1."""

    def one(item: Column) -> Column:
        plain = ~F.startswith(_kind(item), F.lit("OBJECT"))
        text = F.when(plain, F.try_variant_get(item, "$", "string")).otherwise(_text(item, *[f"$.{n}" for n in BULLET_TEXT]))
        refs = F.coalesce(*[F.coalesce(F.try_variant_get(item, f"$.{n}", "array<string>"), F.array_compact(F.array(_text(item, f"$.{n}")))) for n in BULLET_REFS[:1]])
        for name in BULLET_REFS[1:]:
            own = F.coalesce(F.try_variant_get(item, f"$.{name}", "array<string>"), F.array_compact(F.array(_text(item, f"$.{name}"))))
            refs = F.when(F.size(refs) > 0, refs).otherwise(own)
        return F.struct(strip(text).alias("text"), F.filter(F.transform(refs, strip), lambda r: r != "").alias("source_refs"))

    kept = F.filter(F.transform(items, one), lambda b: F.coalesce(b["text"] != "", F.lit(False)))
    numbered = F.transform(kept, lambda b, i: F.struct((i + 1).cast("int").alias("index"), b["text"].alias("text"), F.coalesce(b["source_refs"], F.array().cast("array<string>")).alias("source_refs")))
    return F.coalesce(numbered, F.array().cast(BULLETS))


def parsed_views(answer: Column, views: tuple[str, ...] = VIEWS) -> Column:
    """array<struct<view_name, summary, bullets>> of an answer: an object of views by key or by name."""
    data = object_in_prose(answer)

    def view(name: str) -> Column:
        key = name.replace("/", "_").replace(" ", "_")
        value = F.coalesce(F.try_variant_get(data, f'$["{key}"]', "variant"), F.try_variant_get(data, f'$["{name}"]', "variant"))
        items = F.coalesce(_listed(value, "$"), _listed(value, "$.bullet_points"))
        return F.struct(F.lit(name).alias("view_name"), F.nullif(strip(F.try_variant_get(value, "$.summary", "string")), F.lit("")).alias("summary"), bullets(items).alias("bullets"))

    start = F.left(answer, F.lit(SUMMARY_START))
    lone = F.array(F.struct(F.lit(1).alias("index"), strip(start).alias("text"), F.array().cast("array<string>").alias("source_refs"))).cast(BULLETS)
    general = F.array(F.struct(F.lit("general").alias("view_name"), F.lit(None).cast("string").alias("summary"), lone.alias("bullets")))
    found = F.array(*[view(v) for v in views])
    return F.when(answer.isNull(), F.lit(None)).when(F.startswith(_kind(data), F.lit("OBJECT")), found).otherwise(general.cast("array<struct<view_name:string,summary:string,bullets:" + BULLETS + ">>"))


def summary_text(views: Column) -> Column:
    """Views as text: a heading, the summary if there is one, numbered bullets, a blank line."""

    def part(v: Column) -> Column:
        lines = F.transform(v["bullets"], lambda b: F.concat(b["index"].cast("string"), F.lit(". "), b["text"]))
        head = F.array_compact(F.array(F.concat(F.lit("### "), v["view_name"]), F.concat(F.lit("Summary: "), v["summary"])))
        return F.array_join(F.concat(head, lines, F.array(F.lit(""))), "\n")

    return F.array_join(F.transform(views, part), "\n")


def queries_in(df: DataFrame, answer: str, keep: list[str]) -> DataFrame:
    """(keep, qpos, query_text, is_multimodal, source_view, related_bullet_indice, related_bullet_justification): the queries of every answer.

    The lists of the answer's object in the order of their names, objects or plain text; a
    mark of multimodal queries is taken out and sets the flag; blank ones are left out. An answer
    without any query gives its start as one query of the view `general`.
    """
    text = F.col(answer)
    lists = F.map_entries(F.try_variant_get(object_in_prose(text), "$", "map<string,variant>"))

    def of(view: Column, item: Column) -> Column:
        plain = ~F.startswith(_kind(item), F.lit("OBJECT"))
        raw = F.when(plain, F.try_variant_get(item, "$", "string")).otherwise(F.coalesce(F.try_variant_get(item, "$.query_text", "string"), F.try_variant_get(item, "$.Q", "string")))
        marked = F.coalesce(F.when(~plain, F.try_variant_get(item, "$.is_multimodal", "boolean")), F.contains(raw, F.lit(MULTIMODAL)))
        fields = F.try_variant_get(item, "$", "map<string,variant>")
        return F.struct(
            strip(F.replace(raw, F.lit(MULTIMODAL))).alias("query_text"), marked.alias("is_multimodal"), view.alias("source_view"),
            bullet_number(F.transform_values(fields, lambda k, v: F.to_json(v))).alias("related_bullet_indice"), _text(item, *[f"$.{n}" for n in JUSTIFICATION]).alias("related_bullet_justification"),
        )

    found = F.flatten(F.transform(lists, lambda e: F.transform(F.coalesce(_listed(e["value"], "$"), F.array().cast("array<variant>")), lambda item: of(e["key"], item))))
    kept = F.filter(found, lambda q: F.coalesce(q["query_text"] != "", F.lit(False)))
    shape = "array<struct<query_text:string,is_multimodal:boolean,source_view:string,related_bullet_indice:int,related_bullet_justification:string>>"
    lone = F.array(F.struct(F.left(text, F.lit(QUERY_START)).alias("query_text"), F.lit(False).alias("is_multimodal"), F.lit("general").alias("source_view"), F.lit(None).cast("int").alias("related_bullet_indice"), F.lit(None).cast("string").alias("related_bullet_justification")))
    rows = F.when(F.size(kept) > 0, kept.cast(shape)).when(text.isNotNull(), lone.cast(shape))
    return df.select(*keep, F.posexplode(rows).alias("qpos", "q")).select(*keep, "qpos", "q.*")
