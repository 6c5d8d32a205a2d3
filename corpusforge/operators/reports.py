"""Small reports: labels of choices, side-by-side examples, and Markdown made from a few aggregated rows.

The functions that return text take rows that are already aggregated (one per dataset); they never see the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

NOT_KNOWN = "N/A"
METRIC_NAMES = {
    "query_count": "Query count", "avg_chars": "Avg chars", "avg_tokens": "Avg tokens", "constraints_per_query": "Constraints/query", "specificity_score": "Specificity", "specificity_fit": "Specificity fit",
    "lexical_score": "Naturalness", "lexical_fit": "Naturalness fit", "unmatched_ratio": "Unmatched templates",
}
CLOSENESS = ("w_constraints", "hc_constraints", "w_specificity", "hc_specificity", "w_naturalism", "hc_naturalism", "hc_overall")


def number(value, digits: int = 3) -> str:
    """A number with so many digits; N/A for null, text and what is not finite."""
    return f"{value:.{digits}f}" if isinstance(value, (int, float)) and not isinstance(value, bool) and isfinite(value) else NOT_KNOWN


def whole(value) -> str:
    return f"{int(value):,}" if isinstance(value, (int, float)) and isfinite(value) else NOT_KNOWN


def percent(value) -> str:
    text = number(value * 100, 1) if isinstance(value, (int, float)) else NOT_KNOWN
    return text if text == NOT_KNOWN else text + "%"


def cell(text) -> str:
    """A text as a table cell: one line, bars escaped."""
    return ("" if text is None else str(text)).replace("\n", " ").replace("|", "\\|")


def _table(head: Sequence[str], rows: Sequence[Sequence[str]], align: str = "---:") -> list[str]:
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return [line(head), line(["---", *[align] * (len(head) - 1)]), *map(line, rows)]


def metric_table(summaries: Mapping[str, Mapping]) -> list[str]:
    """A table of the compared metrics, one column per dataset."""
    show = lambda m, v: str(v) if m == "query_count" else percent(v) if m == "unmatched_ratio" else number(v, 1 if m.startswith("avg_") else 3)
    return _table(["Metric", *summaries], [[name, *[show(m, s.get(m)) for s in summaries.values()]] for m, name in METRIC_NAMES.items()])


def comparison(title: str, summaries: Mapping[str, Mapping], human: str, closeness: Mapping[str, Mapping], examples: Sequence[Mapping]) -> str:
    """A comparison of datasets with a human one as Markdown. closeness: dataset -> CLOSENESS. examples: rows with a text per dataset."""
    if human not in summaries:
        raise ValueError(f"no summary of {human!r}")
    near = [[m, *["-" if d == human else number(closeness.get(d, {}).get(m)) for d in summaries]] for m in CLOSENESS]
    shown = [[str(i), *[cell(e.get(d)) for d in summaries]] for i, e in enumerate(examples, 1)]
    parts = [f"# {title}", "", "## Summary Metrics", "", *metric_table(summaries), "", "## Human-Closeness", "", *_table(["Metric", *summaries], near), "", "## Query Examples", "", *_table(["Example", *summaries], shown, "---"), ""]
    return "\n".join(parts)


def style_report(dataset: str, metrics: Mapping, examples: Sequence[tuple[str, str]]) -> str:
    """One dataset's style as Markdown: its metrics, and up to ten examples (template, query)."""
    lines = ["# Query Style Analysis", "", f"- Dataset: `{dataset}`", f"- Total queries: {metrics['query_count']}", f"- Avg characters: {number(metrics.get('avg_chars'), 1)}", f"- Avg tokens: {number(metrics.get('avg_tokens'), 1)}", f"- Unmatched template share: {percent(metrics.get('unmatched_ratio'))}"]
    lines += [f"- {METRIC_NAMES[m]}: {number(metrics[m])}" for m in ("constraints_per_query", "specificity_score", "lexical_score") if metrics.get(m) is not None]
    return "\n".join([*lines, "", "## Representative Examples", "", *[f"- [{t}] {q}" for t, q in examples[:10]]]) + "\n"


def analysis_report(totals: Mapping, papers: Sequence[Mapping]) -> str:
    """Totals of an analysis and one line per paper (paper_id, title, n_queries, n_keep) as Markdown."""
    kept = [f"- {k.replace('_', ' ')}: {number(v) if isinstance(v, float) else NOT_KNOWN if v is None else v}" for k, v in totals.items()]
    rows = [[cell(p["paper_id"]), cell(p.get("title")), str(p["n_queries"]), str(p["n_keep"])] for p in papers]
    return "\n".join(["# Query Analysis", "", *kept, "", *_table(["Paper", "Title", "Queries", "Keep"], rows), ""])


def side_by_side(rows: DataFrame, side: str, text: str, order: list[str], sides: Sequence[str], most: int) -> DataFrame:
    """(place, one column per side): the k-th text of every side beside each other, on one line, bars escaped; null where a side has fewer.

    Only the first `most` of each side are looked at (a limit per group, applied before the shuffle).
    """
    k = F.row_number().over(W.partitionBy(side).orderBy(*order))
    first = rows.where(F.col(side).isin(*sides)).withColumn("place", k).where(F.col("place") <= most)
    shown = F.replace(F.regexp_replace(text, "\n", " "), F.lit("|"), F.lit("\\|"))
    return first.groupBy("place").agg(*[F.max(F.when(F.col(side) == s, shown)).alias(f"side_{i + 1}") for i, s in enumerate(sides)])


def query_label(place: Column, view: Column, decision: Column, saved: Column) -> Column:
    """'Q3 | view | decision', with ' | [saved]' where there is feedback."""
    known = lambda c: F.coalesce(c, F.lit(NOT_KNOWN))
    return F.concat(F.lit("Q"), place.cast("string"), F.lit(" | "), known(view), F.lit(" | "), known(decision), F.when(saved, " | [saved]").otherwise(""))


def paper_label(place: Column, title: Column, paper: Column, n: Column) -> Column:
    """'[2] title | id | q=5'."""
    return F.concat(F.lit("["), place.cast("string"), F.lit("] "), F.coalesce(title, F.lit("Untitled")), F.lit(" | "), F.coalesce(paper, F.lit("unknown")), F.lit(" | q="), n.cast("string"))


def decisions(stored: DataFrame, counted: DataFrame, names: Sequence[str] = ("Keep", "Hard Reject")) -> DataFrame:
    """(decision, n) of the names: the stored counts if there are any, else those counted from the rows (decision)."""
    have = stored.where(F.col("decision").isin(*names)).groupBy("decision").agg(F.sum("n").cast("bigint").alias("stored"))
    own = counted.where(F.col("decision").isin(*names)).groupBy("decision").agg(F.count("*").alias("counted"))
    any_stored = have.agg((F.count("*") > 0).alias("any"))
    spine = stored.sparkSession.createDataFrame([(n,) for n in names], "decision string")
    joined = spine.join(have, "decision", "left").join(own, "decision", "left").join(F.broadcast(any_stored))  # one row
    return joined.select("decision", F.coalesce(F.when(F.col("any"), F.col("stored")).otherwise(F.col("counted")), F.lit(0)).alias("n"))
