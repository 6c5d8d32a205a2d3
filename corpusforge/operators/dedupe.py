"""Keyed merging where the order of arrival carries meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_place_last_value(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """One row per key: all columns of its last row, and the place of its first as first_pos.

    Ties in pos: the row that is greater as a whole. The extreme row is found by a fixed-width
    aggregate and a join back, so wide rows are not carried through a sort. Null keys are left out.
    """
    rows = df.where(F.col(key).isNotNull()).withColumn("_h", F.xxhash64(*[F.to_json(F.struct(c)) if df.schema[c].dataType.typeName() in ("array", "map", "struct") else F.col(c) for c in df.columns]))
    ends = rows.groupBy(F.col(key).alias("_k")).agg(F.min(pos).alias("first_pos"), F.max(F.struct(F.col(pos).alias("p"), F.col("_h").alias("h"))).alias("_last"))
    kept = rows.join(ends, (F.col(key) == F.col("_k")) & F.col(pos).eqNullSafe(F.col("_last.p")) & (F.col("_h") == F.col("_last.h")))
    return kept.drop("_k", "_h", "_last").dropDuplicates([key])


def merged(stored: DataFrame, fetched: DataFrame, key: str, pos: str = "pos", shift: int = 10**12) -> DataFrame:
    """first_place_last_value of stored rows followed by fetched ones, whatever their own places (below `shift`)."""
    later = fetched.withColumn(pos, F.col(pos).cast("bigint") + shift)
    return first_place_last_value(stored.withColumn(pos, F.col(pos).cast("bigint")).unionByName(later, allowMissingColumns=True), key, pos)


def still_wanted(done: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of earlier results whose key is still among the targets (stale ones are dropped)."""
    return done.join(targets.select(*keys).distinct(), keys, "left_semi")


def in_first_order(results: DataFrame, spine: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Results with the place of their key in the input as `pos`, sorted by it; keys the input lacks go last, by key."""
    places = spine.groupBy(key).agg(F.min(pos).alias(pos))
    return results.drop(pos).join(places, key, "left").orderBy(F.col(pos).asc_nulls_last(), key)


def first_wins(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """(key, pos): the first place of every key; blank and null keys are left out."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.min(pos).alias(pos))


def id_spine(*sources: tuple[DataFrame, str, str]) -> DataFrame:
    """(id, source, pos) of the ids of several tables (table, id column, position column) in first-seen order of the tables."""
    parts = [df.select(F.col(i).cast("string").alias("id"), F.lit(n).alias("source"), F.col(p).cast("bigint").alias("pos")) for n, (df, i, p) in enumerate(sources)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("id is not null").groupBy("id").agg(F.min(F.struct("source", "pos")).alias("m")).select("id", "m.source", "m.pos")


def missing_from(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose key is not in done (resume)."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def complete_groups(expected: DataFrame, actual: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """(group): groups that expect something and have all of it."""
    want, have = expected.select(group, *keys).distinct(), actual.select(group, *keys).distinct()
    lacking = want.join(have, [group, *keys], "left_anti").select(group).distinct()
    return want.select(group).distinct().join(lacking, group, "left_anti")
