"""Keyword and pattern predicates over text columns, with every list a parameter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import token_count


def contains_any(text: Column, words: list[str]) -> Column:
    """Some word occurs as a substring, case ignored; false for null and for an empty list."""
    if not words:
        return F.lit(False)
    low = F.lower(text)
    hits = [F.contains(low, F.lit(w.lower())) for w in words]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return F.coalesce(out, F.lit(False))


def occurrences(text: Column, literals: list[str]) -> Column:
    """How often the literals occur, case ignored, summed over the list."""
    low = F.lower(text)
    return sum((F.regexp_count(low, F.lit(re.escape(x.lower()))) for x in literals), F.lit(0))


def density(text: Column, literals: list[str]) -> Column:
    """Occurrences per white-space token; 0 without tokens."""
    n = token_count(text)
    return F.coalesce(F.when(n > 0, occurrences(text, literals) / n), F.lit(0.0))


def mentions(text: Column, words: list[str]) -> Column:
    """How often the words occur standing alone, case ignored; letters and digits of any script bound a word."""
    low = F.lower(text)
    return sum((F.coalesce(F.regexp_count(low, F.lit(rf"(?U)\b{re.escape(w.lower())}\b")), F.lit(0)) for w in words), F.lit(0))


def rule_flags(df: DataFrame, text: str, accept: list[str], literals: list[str], most_density: float, words: list[str], least_mentions: int) -> DataFrame:
    """df with has_accept, is_similar, has_mentions and passed; null text fails every rule."""
    t = F.col(text)
    out = df.withColumns({
        "has_accept": contains_any(t, accept),
        "is_similar": density(t, literals) >= most_density,
        "has_mentions": mentions(t, words) >= least_mentions,
    })
    return out.withColumn("passed", F.col("has_accept") & ~F.col("is_similar") & F.col("has_mentions"))


def first_passed(df: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """Passed rows in order, at most `limit`; 0 or None is all."""
    out = df.where("passed")
    return out.orderBy(*order).limit(limit) if limit else out
