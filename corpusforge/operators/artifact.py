"""The nested output artifact: papers with their queries, candidates and analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PAGE = 500


def assembled(papers: DataFrame, queries: DataFrame, candidates: DataFrame, most_negatives: int | None = None, page: int = PAGE) -> DataFrame:
    """Rows (paper_id, page, title, queries): every paper known to any side with its queries (in order), each with its hard negatives and positives.

    Queries stand in pages of `page` places, so a paper with a large part of all queries is several rows; most
    papers are one, of page 0. Sides are folded on their own key before they meet: candidates per query, queries per page. A
    query without candidates has empty lists; a paper without queries an empty list; of a paper
    crawled twice the last title holds. Candidates that arrived twice count once.
    """
    key = ["paper_id", "query_text", "source_view"]
    found = candidates.select(*key, "cand_id", "cand_pos", "label", "paper_title", "url", "reason").where("label in ('hard_negative', 'positive')").distinct()
    item = F.struct("cand_pos", "cand_id", "paper_title", "url", "reason")
    folded = found.groupBy(*key).agg(*[F.array_sort(F.collect_list(F.when(F.col("label") == label, item))).alias(f"{label}s") for label in ("hard_negative", "positive")])
    if most_negatives:
        folded = folded.withColumn("hard_negatives", F.slice("hard_negatives", 1, most_negatives))
    empty = lambda c: F.coalesce(F.col(c), F.array())
    asked = queries.join(folded, key, "left").select("paper_id", F.floor(F.coalesce("qpos", F.lit(0)) / page).cast("int").alias("page"), F.struct("qpos", "query_text", "source_view", "is_multimodal", empty("hard_negatives").alias("hard_negatives"), empty("positives").alias("positives")).alias("q"))
    paged = asked.groupBy("paper_id", "page").agg(F.array_sort(F.collect_list("q")).alias("queries"))
    last = papers.groupBy("paper_id").agg(F.max_by("title", "pos").alias("title"))
    return last.join(paged, "paper_id", "full").where("paper_id is not null").select("paper_id", F.coalesce("page", F.lit(0)).alias("page"), "title", empty("queries").alias("queries"))


def flattened(artifact: DataFrame) -> DataFrame:
    """(paper_id, qpos, label, k, cand_id): the candidates of an assembled artifact, k from 1."""
    q = artifact.select("paper_id", F.explode("queries").alias("q"))
    parts = [q.select("paper_id", "q.qpos", F.lit(label).alias("label"), F.posexplode(f"q.{label}s").alias("k", "c")).select("paper_id", "qpos", "label", (F.col("k") + 1).alias("k"), "c.cand_id") for label in ("hard_negative", "positive")]
    return parts[0].unionByName(parts[1])


def totals(artifact: DataFrame) -> DataFrame:
    """(n_papers, n_queries, n_hard_negatives, n_positives) of an artifact, from its nested sizes."""
    inner = lambda label: F.aggregate("queries", F.lit(0), lambda acc, q: acc + F.size(q[f"{label}s"]))
    sizes = artifact.groupBy("paper_id").agg(F.sum(F.size("queries")).alias("q"), F.sum(inner("hard_negative")).alias("h"), F.sum(inner("positive")).alias("p"))
    return sizes.agg(F.count("*").alias("n_papers"), F.sum("q").alias("n_queries"), F.sum("h").alias("n_hard_negatives"), F.sum("p").alias("n_positives"))


def titles(downloaded: DataFrame, generated: DataFrame, analysed: DataFrame) -> DataFrame:
    """(paper_id, title) of tables (paper_id, title, pos): of the first table that knows the paper, even if its title is empty; null titles count as empty; of several rows the last."""
    sides = [df.select("paper_id", "title", F.col("pos").cast("bigint").alias("pos"), F.lit(i).alias("side")) for i, df in enumerate((downloaded, generated, analysed))]
    rows = sides[0].unionByName(sides[1]).unionByName(sides[2]).where("paper_id is not null")
    return rows.groupBy("paper_id").agg(F.max_by(F.struct("title"), F.struct((-F.col("side")).alias("s"), "pos"))["title"].alias("title")).withColumn("title", F.coalesce("title", F.lit("")))


HEADER = ("abstract", "pdf_url", "venue", "year", "authors")
FORUM_URL = "https://openreview.net/forum?id="  # fixed value


def headers(ids: DataFrame, downloaded: DataFrame, analysed: DataFrame) -> DataFrame:
    """(paper_id, forum_url, HEADER, n_notes, origin) of every id: from the download if it knows the paper, else from the analysis, else nulls.

    downloaded and analysed: (paper_id, pos, HEADER); downloaded may have n_notes. origin is download, analysis or none.
    """
    def last(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in HEADER], (F.col("n_notes") if "n_notes" in df.columns else F.lit(0)).cast("bigint").alias("n_notes"))
        return df.groupBy("paper_id").agg(F.max_by(row, "pos").alias(name))

    both = ids.select("paper_id").where("paper_id is not null").distinct().join(last(downloaded, "d"), "paper_id", "left").join(last(analysed, "a"), "paper_id", "left")
    known, judged = F.col("d").isNotNull(), F.col("a").isNotNull()
    pick = lambda c: F.when(known, F.col(f"d.{c}")).otherwise(F.col(f"a.{c}"))
    return both.select(
        "paper_id", F.concat(F.lit(FORUM_URL), "paper_id").alias("forum_url"), *[pick(c).alias(c) if c != "authors" else F.coalesce(pick(c), F.array().cast("array<string>")).alias(c) for c in HEADER],
        F.when(known, F.coalesce("d.n_notes", F.lit(0))).otherwise(0).cast("bigint").alias("n_notes"), F.when(known, "download").when(judged, "analysis").otherwise("none").alias("origin"),
    )


def filter_status(ids: DataFrame, filtered: DataFrame) -> DataFrame:
    """(paper_id, passed, reason, score) of ids: as filtered (paper_id, passed, pos); unknown papers have nulls, a missing verdict counts as passed. Reason and score are never written and stay null."""
    last = filtered.groupBy("paper_id").agg(F.max_by(F.coalesce("passed", F.lit(True)), "pos").alias("passed"))
    return ids.select("paper_id").distinct().join(last, "paper_id", "left").select("paper_id", "passed", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("double").alias("score"))


def analysed_queries(queries: DataFrame, analysis: DataFrame, columns: list[str]) -> DataFrame:
    """queries with columns of their analysis, looked up by text and view within the paper; of several analyses of one key the one of highest pos."""
    key = ["paper_id", "query_text", "source_view"]
    last = analysis.groupBy(*key).agg(F.max_by(F.struct(*columns), "pos").alias("a"))
    return queries.join(last, key, "left").select(*queries.columns, *[F.col(f"a.{c}").alias(c) for c in columns])
