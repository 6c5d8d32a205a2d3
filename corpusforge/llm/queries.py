"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import consensus, leakage, linkage, lookalike, names, packing, truncation
from corpusforge.sources.tables import table


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents that read the same sign by sign and differ as strings."""
    return lookalike.lookalike_pairs(table(spark, folder, "documents"))


def p8_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the class of its consistent form."""
    return lookalike.form_classes(table(spark, folder, "documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the evaluation items they hold."""
    return leakage.leaked_pairs(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation items that leaked."""
    return leakage.leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates whose abstract breaks off."""
    return truncation.truncated(table(spark, folder, "candidates")).where("cut").select("cand_id").distinct()


def p5_share_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Share of cut abstracts of each source."""
    return truncation.cut_share(table(spark, folder, "candidates"))


def p6_assignment(spark: SparkSession, folder: str) -> DataFrame:
    """The sequence of every document for every capacity."""
    return packing.packed(table(spark, folder, "documents"), table(spark, folder, "pack_limits"))


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences, share of space used and spread of cost for every capacity."""
    return packing.packing_report(p6_assignment(spark, folder))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Found works that are known papers."""
    return linkage.linked(table(spark, folder, "candidates"), table(spark, folder, "papers")).select("cand_id", "paper_id")


def p1_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The links with their confidence."""
    return linkage.linked(table(spark, folder, "candidates"), table(spark, folder, "papers"))


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return names.entries((table(spark, folder, "candidates"), "authors"), (table(spark, folder, "papers"), "authors"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of spellings of one name."""
    return names.spelling_pairs(_names(spark, folder))


def p2_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling with the set it belongs to."""
    return names.spelling_sets(_names(spark, folder))


ITEM = ["query_id", "feedback_item_id"]


def _consensus(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return consensus.consensus(consensus.label_edges(table(spark, folder, "human_feedback"), ITEM), ITEM)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The label of every item."""
    return _consensus(spark, folder)[0].select(*ITEM, "judgement")


def p4_items(spark: SparkSession, folder: str) -> DataFrame:
    """Label, confidence and agreement of every item."""
    return _consensus(spark, folder)[0]


def p4_reviewers(spark: SparkSession, folder: str) -> DataFrame:
    """Reliability of every reviewer."""
    return _consensus(spark, folder)[1]


QUERIES = {f.__name__: f for f in (p1_found, p1_confidence, p2_found, p2_sets, p4_found, p4_items, p4_reviewers, p6_assignment, p6_report, p5_found, p5_share_by_source, p7_found, p7_leaked_items, p8_found, p8_forms)}
ORACLE: dict[str, str] = {}
