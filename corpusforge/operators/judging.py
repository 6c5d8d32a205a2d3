"""Judging of queries in prompts of several, and what the judgements amount to.

The queries of a paper are asked for in pages of at most PAGE places, so no paper, however large,
becomes one prompt or one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import centered_fit, list_in_prose, non_negative, object_in_prose, score_1_to_5, strip
from corpusforge.operators.stats import wasserstein
from corpusforge.operators.textmodel import Model, answered, verdict

PAGE = 50


def paged_prompts(queries: DataFrame, size: int = PAGE, first: int = 1) -> DataFrame:
    """(paper_id, page, places, prompt) of queries (paper_id, qpos, query_text): lines numbered from `first` in order of qpos; places are their qpos."""
    rows = queries.where("paper_id is not null and qpos is not null").select("paper_id", F.floor(F.col("qpos") / size).cast("int").alias("page"), F.struct("qpos", "query_text").alias("q"))
    paged = rows.groupBy("paper_id", "page").agg(F.array_sort(F.collect_list("q")).alias("qs"))
    line = lambda q, i: F.concat((i + first).cast("string"), F.lit(". "), F.regexp_replace(F.coalesce(q["query_text"], F.lit("")), r"[\r\n]+", " "))
    return paged.select("paper_id", "page", F.transform("qs", lambda q: q["qpos"]).alias("places"), F.array_join(F.transform("qs", line), "\n").alias("prompt"))


def zipped_items(asked: DataFrame, items: Column) -> DataFrame:
    """(paper_id, qpos, item): the k-th item for the k-th place; null where there are fewer, the rest is left out."""
    each = asked.select("paper_id", F.posexplode("places").alias("k", "qpos"), items.alias("items"))
    return each.select("paper_id", "qpos", F.get("items", F.col("k")).alias("item"))


def retrieval_judged(queries: DataFrame, model: Model, **calls) -> DataFrame:
    """(paper_id, qpos, full_paper_reliance, reasoning): PASS or FAIL for every query; FAIL where the answer has none."""
    answers = answered(paged_prompts(queries), "prompt", model, **calls)
    whole = object_in_prose(F.col("answer"))
    items = F.coalesce(list_in_prose(F.col("answer")), F.when(whole.isNotNull(), F.array(whole)))
    out = zipped_items(answers, items)
    get = lambda p: F.try_variant_get("item", p, "string")
    return out.select("paper_id", "qpos", verdict(get("$.dimensions.full_paper_reliance")).alias("full_paper_reliance"), strip(F.coalesce(get("$.reasoning"), F.lit(""))).alias("reasoning"))


def style_judged(queries: DataFrame, model: Model, **calls) -> DataFrame:
    """(paper_id, qpos, specificity, naturalism, constraints, rationale): scores of 1 to 5 or null, a count of 0 or more."""
    answers = answered(paged_prompts(queries), "prompt", model, **calls)
    out = zipped_items(answers, F.try_variant_get(object_in_prose(F.col("answer")), "$.results", "array<variant>"))
    get = lambda p: F.try_variant_get("item", p, "string")
    return out.select(
        "paper_id", "qpos", score_1_to_5(get("$.metric_1_specificity_calibration.score")).alias("specificity"), score_1_to_5(get("$.metric_2_lexical_naturalism.score")).alias("naturalism"),
        non_negative(get("$.metric_3_semantic_constraint_count.count")).alias("constraints"), strip(F.coalesce(get("$.metric_1_specificity_calibration.rationale"), F.lit(""))).alias("rationale"),
    )


def analysis_totals(analysis: DataFrame) -> DataFrame:
    """One row over analysed queries (decision, full_paper_reliance, char_length, token_length, question_template, specificity, naturalism, constraints).

    Counts by decision and verdict, mean, least and greatest lengths, means of scores over those that
    have one, and templates with their counts as a sorted array; means are null without rows.
    """
    a = F.col
    templates = analysis.groupBy("question_template").agg(F.count("*").alias("n"))
    shown = templates.agg(F.array_sort(F.collect_list(F.struct("question_template", "n"))).alias("question_templates"))
    ends = lambda c: [F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    one = analysis.agg(
        F.count("*").alias("n_queries"), F.count_if(a("decision") == "Keep").alias("n_keep"), F.count_if(a("decision") == "Hard Reject").alias("n_hard_reject"),
        F.count_if(a("full_paper_reliance") == "PASS").alias("n_pass"), F.count_if(a("full_paper_reliance") == "FAIL").alias("n_fail"), *ends("char_length"), *ends("token_length"),
        *[F.avg(c).alias(f"{c}_mean") for c in ("specificity", "naturalism", "constraints")],
    )
    return one.join(shown)  # one row each


def summary_metrics(analysis: DataFrame, by: str) -> DataFrame:
    """One row per dataset `by`: query_count and the eight metrics that reports compare; means over an empty set are 0."""
    c = F.col
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    fit = lambda s: centered_fit(c(s).cast("double"))
    return analysis.groupBy(by).agg(
        F.count("*").alias("query_count"), zero(F.avg("char_length")).alias("avg_chars"), zero(F.avg("token_length")).alias("avg_tokens"), zero(F.avg("constraints")).alias("constraints_per_query"),
        zero(F.avg("specificity")).alias("specificity_score"), zero(F.avg(fit("specificity"))).alias("specificity_fit"), zero(F.avg("naturalism")).alias("lexical_score"), zero(F.avg(fit("naturalism"))).alias("lexical_fit"),
        (F.count_if(c("question_template") == "other") / F.count("*")).alias("unmatched_ratio"),
    )


METRICS = ("avg_chars", "avg_tokens", "constraints_per_query", "specificity_score", "specificity_fit", "lexical_score", "lexical_fit", "unmatched_ratio")


def merged_metrics(summaries: DataFrame) -> DataFrame:
    """One row of summary_metrics for several: means weighted by query_count. An error where there is no query at all."""
    n = F.sum("query_count")
    total = F.when(F.coalesce(n, F.lit(0)) > 0, n).otherwise(F.raise_error(F.lit("no queries to merge")).cast("bigint"))
    return summaries.agg(total.alias("query_count"), *[(F.sum(F.col(m) * F.col("query_count")) / n).alias(m) for m in METRICS])


def paired_scores(constraints: DataFrame, scores: DataFrame, on: list[str]) -> DataFrame:
    """(on, constraints, specificity, naturalism) of the queries that both judges gave a result for; both scores are there."""
    return constraints.select(*on, "constraints").where("constraints is not null").join(scores.select(*on, "specificity", "naturalism").where("specificity is not null and naturalism is not null"), on)


def human_closeness(rows: DataFrame, side: str, human: str, made: str) -> DataFrame:
    """One row: distances of constraints, specificity and naturalism between two sides, the closeness that follows from each, and their mean.

    Scores have a scale of 1 to 5; rows lacking one of the three are left out.
    """
    full = rows.where("constraints is not null and specificity is not null and naturalism is not null").select(side, "constraints", "specificity", "naturalism")
    long = full.select(side, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in ("constraints", "specificity", "naturalism")])))
    distances = wasserstein(long, "x", side, human, made, ["metric"])
    wide = distances.agg(*[F.max(F.when(F.col("metric") == m, F.col("distance"))).alias(f"w_{m}") for m in ("constraints", "specificity", "naturalism")])
    spread = full.where(F.col(side) == human).agg(F.stddev_pop("constraints").alias("sd"))
    scale = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.col(c) / 4.0))
    out = wide.join(spread).select("w_constraints", "w_specificity", "w_naturalism", F.exp(-F.col("w_constraints") / (F.col("sd") + 1e-8)).alias("hc_constraints"), scale("w_specificity").alias("hc_specificity"), scale("w_naturalism").alias("hc_naturalism"))
    return out.withColumn("hc_overall", (F.col("hc_constraints") + F.col("hc_specificity") + F.col("hc_naturalism")) / 3)
