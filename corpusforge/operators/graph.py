"""Connected components of an undirected graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import discard, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): the component is named by its least node. Alternating large-star and small-star rounds.

    Each round moves links towards the least node of a neighbourhood; the number of rounds grows
    with the logarithm of the longest path. A hub only ever appears as a key of a minimum, so it
    is pre-aggregated. Nodes without a link do not appear; null ends are ignored; loops give a
    component of one node. Rounds are cut by tables in the shared folder.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"`{a}` is not null and `{b}` is not null").distinct()
    edges = materialize(edges, "links")
    loops = edges.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    now, old = edges.where("u <> v"), None
    digest = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    before = digest(now)
    for _ in range(most_rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.greatest("v", "m").alias("x"), F.col("m").alias("y")).where("x <> y")
        after = materialize(small.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "star")
        last, before = before, digest(after)
        if old is not None:
            discard(old)  # a round needs the one before only
        now = old = after
        if last == before:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    tops = roots.select(F.col("component").alias("node"), "component").distinct()
    return roots.unionByName(tops).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
