"""Aggregates of query analytics: length statistics, bins, weighted merges, distribution distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def length_stats(df: DataFrame, value: Column, by: list[str], prefix: str = "") -> DataFrame:
    """Mean, population deviation, least, greatest, median and quartiles (interpolated) per group; nulls are ignored."""
    v = value.cast("double")
    return df.groupBy(*by).agg(
        F.count(v).alias(f"{prefix}n"), F.avg(v).alias(f"{prefix}mean"), F.stddev_pop(v).alias(f"{prefix}std"), F.min(v).alias(f"{prefix}min"),
        F.max(v).alias(f"{prefix}max"), F.percentile(v, 0.5).alias(f"{prefix}median"), F.percentile(v, 0.25).alias(f"{prefix}p25"), F.percentile(v, 0.75).alias(f"{prefix}p75"),
    )


def bins(df: DataFrame, value: Column, width: int, by: list[str]) -> DataFrame:
    """(by, bin, n, share): bins (k*width, (k+1)*width], the first with its lower end; share of the group."""
    b = F.greatest(F.ceil(value / width) - 1, F.lit(0)).cast("bigint")
    counts = df.where(value.isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_t"))
    joined = counts.join(totals, by) if by else counts.join(totals)
    return joined.withColumn("share", F.col("n") / F.col("_t")).drop("_t")


def unit_histogram(df: DataFrame, value: Column, by: str) -> DataFrame:
    """(by, value, n) with every whole number from the least to the greatest of all groups; 0 where a group has none."""
    rows = df.select(F.col(by), value.cast("int").alias("value")).where(F.col(by).isNotNull() & F.col("value").isNotNull())
    counts = rows.groupBy(by, "value").agg(F.count("*").alias("n"))
    span = rows.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo is not null")
    groups = rows.groupBy(by).agg(F.lit(1).alias("one"))
    spine = groups.join(span.withColumn("one", F.lit(1)), "one").select(by, F.explode(F.sequence("lo", "hi")).alias("value"))
    return spine.join(counts, [by, "value"], "left").select(by, "value", F.coalesce("n", F.lit(0)).alias("n"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean over rows with a value and a positive weight; null if there are none."""
    ok = value.isNotNull() & (weight > 0)
    total = F.sum(F.when(ok, weight))
    return F.when(total > 0, F.sum(F.when(ok, value * weight)) / total)


def wasserstein(df: DataFrame, value: str, side: str, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """(by, distance): first Wasserstein distance of the values of the rows with side a and side b.

    Rows are first summed per distinct value, so the window that adds up the two distribution
    functions sees distinct values only.
    """
    by = by or []
    rows = df.where(F.col(value).isNotNull() & F.col(side).isin(a, b))
    counts = rows.groupBy(*by, F.col(value).cast("double").alias("x")).agg(F.count_if(F.col(side) == a).alias("na"), F.count_if(F.col(side) == b).alias("nb"))
    up, whole = W.partitionBy(*by).orderBy("x"), W.partitionBy(*by)
    step = counts.select(
        *by, "x",
        (F.sum("na").over(up) / F.sum("na").over(whole)).alias("fa"), (F.sum("nb").over(up) / F.sum("nb").over(whole)).alias("fb"), (F.lead("x").over(up) - F.col("x")).alias("dx"),
    )
    return step.groupBy(*by).agg(F.coalesce(F.sum(F.abs(F.col("fa") - F.col("fb")) * F.col("dx")), F.lit(0.0)).alias("distance"))


def estimated_histogram(mean: float, total: int, low: int = 1, high: int = 5) -> dict[int, int]:
    """A histogram of `total` whole scores with about the given mean: all at the nearest score, then units moved by one.

    Sweeps start at the end that the units move away from; in a sweep every score in turn passes on
    one unit, until the mean is met to within one unit.
    """
    counts = dict.fromkeys(range(low, high + 1), 0)
    if total <= 0:
        return counts
    counts[min(high, max(low, round(mean)))] = total
    lacking = mean * total - sum(score * n for score, n in counts.items())
    step, sweep = (1, range(low, high)) if lacking > 0 else (-1, range(high, low, -1))
    while abs(lacking) >= 1 and any(counts[score] for score in sweep):
        for score in sweep:
            if counts[score] and abs(lacking) >= 1:
                counts[score], counts[score + step] = counts[score] - 1, counts[score + step] + 1
                lacking -= step
    return counts
