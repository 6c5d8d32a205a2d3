"""Places within groups, also where one group holds a large part of all rows.

A window sorts a group in one task. Where every group has at most `most` rows that is the plan; with a
larger one the rows are range-partitioned by group and order, so a group lies over many partitions, each row is
numbered within its partition, and what the group has in earlier partitions is added. Both give the same
places. Ties need a total order: give enough columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.session import materialize

MOST = 1_000_000


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "k", most: int = MOST) -> DataFrame:
    """df with the place of every row in its group, from 1. Null group keys are a group of their own."""
    large = df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    if not large.limit(1).count():
        return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("bigint"))
    spread = df.repartitionByRange(*[F.col(c) for c in by], *order).sortWithinPartitions(*[F.col(c) for c in by], *order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    kept = materialize(spread, "ranked")  # partition numbers must not change between the two readings
    counts = kept.groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    local = kept.withColumn("_k", F.row_number().over(W.partitionBy(*by, "_p").orderBy("_i")))
    same = [local[c].eqNullSafe(before[c]) for c in (*by, "_p")]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    joined = local.alias("l").join(before.alias("b"), condition)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._k") + F.col("b._before")).alias(name))
