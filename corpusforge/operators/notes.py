"""Forum notes: kinds, order in a thread, threads as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.ranking import ranked

#: Names of review fields in older and newer forms.
REVIEW_FIELDS = {"summary": "review", "strengths": "pros", "weaknesses": "cons", "soundness": "quality", "presentation": "clarity", "contribution": "originality"}


def kind(invitation: Column, content_keys: Column | None = None) -> Column:
    """Kind of a note, from its invitation and the keys of its content; the first rule that fits holds."""
    i = F.lower(F.coalesce(invitation, F.lit("")))
    has = lambda *words: F.expr("false") if not words else _any([F.contains(i, F.lit(w)) for w in words])
    decided = has("decision") if content_keys is None else has("decision") | F.coalesce(F.exists(content_keys, lambda k: F.lower(k) == "decision"), F.lit(False))
    return (
        F.when(decided, "decision").when(has("meta_review", "metareview"), "meta_review").when(has("rebuttal", "author_response", "response"), "rebuttal")
        .when(has("official_review"), "review").when(has("review") & ~has("meta"), "review").when(has("comment"), "comment").otherwise("other")
    )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def renamed_fields(content: Column, names: dict[str, str] | None = None) -> Column:
    """A content map with older field names replaced and null values left out; of two fields of one name the later holds."""
    names = REVIEW_FIELDS if names is None else names
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    entries = F.map_entries(F.map_filter(content, lambda k, v: v.isNotNull()))
    renamed = F.transform(entries, lambda e: F.struct(F.coalesce(table[e["key"]], e["key"]).alias("key"), e["value"].alias("value")))
    return F.aggregate(renamed, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, v: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def unwrapped(value: Column) -> Column:
    """A variant {"value": x} as x; other variants as they are."""
    return F.coalesce(F.try_variant_get(value, "$.value", "variant"), value)


def ordered(notes: DataFrame, thread: str, created: str, note_id: str, number: str | None = None) -> DataFrame:
    """notes with k: place in the thread by creation (nulls last), number and id, both compared as text. A hot thread is spread over tasks."""
    keys = [F.col(created).asc_nulls_last(), *([F.coalesce(F.nullif(F.col(number).cast("string"), F.lit("0")), F.lit(""))] if number else []), F.col(note_id).cast("string")]
    return ranked(notes, [thread], keys)


def first_decision(notes: DataFrame, thread: str, pos: str) -> DataFrame:
    """(thread, ...): the first decision of every thread."""
    others = [c for c in notes.columns if c != thread]
    return notes.where("kind = 'decision'").groupBy(thread).agg(F.min_by(F.struct(*others), pos).alias("d")).select(thread, "d.*")


def rendered(notes: DataFrame, thread: str, kind_column: str, note_id: str, text: str, page: int = 100) -> DataFrame:
    """(thread, kind, page, text, n): '[kind/number] text' lines in pages of so many notes, by kind and number.

    A thread is many rows, so none grows with it; its whole text is the pages of all kinds in order.
    """
    rows = ranked(notes.where(F.col(text).isNotNull()), [thread, kind_column], [F.col(note_id)], "_k")
    line = F.concat(F.lit("["), F.col(kind_column), F.lit("/"), F.col("_k").cast("string"), F.lit("] "), F.col(text))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("_k").alias("k"), line.alias("line"))))
    paged = rows.withColumn("page", F.floor((F.col("_k") - 1) / page).cast("int")).groupBy(thread, F.col(kind_column).alias("kind"), "page")
    return paged.agg(F.array_join(F.transform(pieces, lambda x: x["line"]), "\n").alias("text"), F.count("*").alias("n"))


def document_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line): the lines of every text, counted from 0."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def parsed_ref(ref: Column) -> tuple[Column, Column, Column]:
    """Section, entry number and field of 'Section/Entry 3/field'; what is missing is null."""
    part = lambda i: F.get(F.split(ref, "/"), F.lit(i))
    return F.lower(F.nullif(F.trim(part(0)), F.lit(""))), F.regexp_extract(part(1), r"(\d+)", 1).try_cast("int"), F.nullif(F.trim(part(2)), F.lit(""))


def referenced(refs: DataFrame, notes: DataFrame, thread: str, section: str, entry: str, kind_column: str, number: str, wanted: str) -> DataFrame:
    """refs with `wanted` of the note that a reference names: by its number in the thread, else by its place among the notes of the section.

    Both looks are equi-joins on (thread, section, entry); a decision takes the first whatever entry is given.
    """
    placed = ranked(notes.where(F.col(thread).isNotNull()), [thread, kind_column], [F.col(number).asc_nulls_last(), F.col(wanted)], "_place")
    by_number = placed.where(F.col(number).isNotNull()).groupBy(thread, F.col(kind_column).alias(section), F.col(number).cast("int").alias(entry)).agg(F.min_by(wanted, "_place").alias("_a"))
    by_place = placed.select(thread, F.col(kind_column).alias(section), F.col("_place").cast("int").alias(entry), F.col(wanted).alias("_b"))
    first = placed.where((F.col("_place") == 1) & (F.col(kind_column) == "decision")).select(thread, F.col(kind_column).alias(section), F.col(wanted).alias("_c"))
    keys = [thread, section, entry]
    return refs.join(by_number, keys, "left").join(by_place, keys, "left").join(first, [thread, section], "left").withColumn(wanted, F.coalesce("_c", "_a", "_b")).drop("_a", "_b", "_c")


#: Older names of the field that gives a bullet's number, the newest first.
BULLET_NUMBER = (
    "related_bullet_indice", "related_bullet_indices", "related_bulletpoint_indices", "related_bullet_point_indices", "bullet_indice", "bullet_indices", "bullet_point_indices", "related_bullet_index", "bullet_index"
)


def bullet_number(fields: Column, names: tuple[str, ...] = BULLET_NUMBER) -> Column:
    """The first positive whole number under one of the names; a list counts by its first such element."""
    def of(name: str) -> Column:
        pieces = F.regexp_extract_all(fields[name], F.lit(r"(?:^|[\[,\s\"])(\d+)(?=$|[\],\s\".])"), F.lit(1))
        return F.get(F.filter(F.transform(pieces, lambda x: x.try_cast("int")), lambda n: n > 0), F.lit(0))

    return F.coalesce(*[of(n) for n in names])
