"""Search results for queries: a lookup table offline, a callable client otherwise."""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

FOUND = "search_query string, rank int, paper_title string, url string, year int"
RAW = "search_query string, rank int, record string"
SERVICE_MOST = 20  # fixed value: results a search service gives at most


def from_table(queries: DataFrame, index: DataFrame, query: str, limit: int) -> DataFrame:
    """The first results of every query in a table of kept results (search_query, rank, ...)."""
    k = F.row_number().over(W.partitionBy("search_query").orderBy("rank"))
    kept = index.withColumn("_k", k).where(F.col("_k") <= limit).drop("_k")
    return queries.join(kept, F.lower(F.trim(query)) == F.lower(F.trim("search_query")))


def from_client(queries: DataFrame, query: str, search: Callable[[str, int], list[dict]], limit: int, slots: int = 1) -> DataFrame:
    """FOUND of the distinct queries; limit is held within 1 and 20 and rows without a title are left out. slots: calls at a time."""
    n = max(1, min(20, limit))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(q, i, r["title"], r.get("url"), r.get("year")) for q in b["q"] for i, r in enumerate(x for x in search(q, n)[:n] if x.get("title"))]
            yield pd.DataFrame(rows, columns=["search_query", "rank", "paper_title", "url", "year"])

    return queries.select(F.col(query).alias("q")).where("q is not null and trim(q) <> ''").distinct().repartition(slots).mapInPandas(ask, FOUND)


def records_from_client(queries: DataFrame, query: str, search: Callable[[str, int], list[dict]], limit: int, most: int | None = SERVICE_MOST, slots: int = 1) -> DataFrame:
    """RAW: the records of the distinct queries as JSON, for operators.mining to read. limit is at least 1 and, for a service, at most `most` (None for an iterator without such a bound)."""
    n = max(1, limit if most is None else min(most, limit))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(q, i, json.dumps(r, ensure_ascii=False)) for q in b["q"] for i, r in enumerate(itertools.islice(search(q, n), n))]
            yield pd.DataFrame(rows, columns=["search_query", "rank", "record"])

    return queries.select(F.col(query).alias("q")).where("q is not null and trim(q) <> ''").distinct().repartition(slots).mapInPandas(ask, RAW)
