"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusforge.plans import artifact_queries, layout_queries, mining_queries, model_queries, nested_queries, record_queries, store_queries, text_queries

MODULES = (text_queries, store_queries, artifact_queries, model_queries, mining_queries, layout_queries, record_queries, nested_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return text_queries.rule_filter_funnel(spark, folder)
