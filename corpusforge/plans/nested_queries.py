"""Queries on nested artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.operators import nested, notes
from corpusforge.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Children of the queries of all readable artifacts."""
    return nested.query_children(table(spark, folder, "pipeline_output"))


def _table(spark: SparkSession, folder: str, path: str, fields: list[str]) -> DataFrame:
    """The flat table of one path, from its own records only."""
    nodes = nested.dewey_nodes(table(spark, folder, "pipeline_output"), "artifact_id", "payload", only=[path])
    return nested.node_table(nodes, path, fields)


def p3_papers(spark: SparkSession, folder: str) -> DataFrame:
    """Flat papers."""
    return _table(spark, folder, "papers", ["paper_id", "paper_title"]).drop("value")


def p3_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Flat queries, linked to their paper."""
    return _table(spark, folder, "papers.queries", ["query_text", "source_view", "is_multimodal", "related_bullet_justification"]).drop("value")


FOUND = ["paper_title", "arxiv_id", "venue", "year", "authors", "abstract", "url", "pdf_url", "citations", "source_query"]


def p3_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Flat hard negatives, linked to their context."""
    return _table(spark, folder, nested.QUERY_CHILDREN["hard_negative"], [*FOUND, "hard_negative_reason"]).drop("value")


def p3_positives(spark: SparkSession, folder: str) -> DataFrame:
    """Flat positives, linked to their context."""
    return _table(spark, folder, nested.QUERY_CHILDREN["positive"], [*FOUND, "positive_reason"]).drop("value")


def p3_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Flat keywords, linked to their context."""
    return _table(spark, folder, nested.QUERY_CHILDREN["keyword"], []).withColumnRenamed("value", "keyword")


def p3_analyses(spark: SparkSession, folder: str) -> DataFrame:
    """Flat analyses, linked to their query: decision, verdict, lengths, template, scores and counts."""
    rows = _table(spark, folder, nested.QUERY_CHILDREN["analysis"], ["decision", "retrieval_evaluation", "style_evaluation"]).drop("value")
    inside = lambda column, path, kind: F.try_variant_get(F.try_parse_json(column), path, kind)
    rule, judged = "$.rule_based", "$.llm_based"
    return rows.select(
        "doc_key", "node", "parent_node", "position", "decision", inside("retrieval_evaluation", "$.full_paper_reliance", "string").alias("full_paper_reliance"),
        inside("style_evaluation", f"{rule}.token_length", "int").alias("token_length"), inside("style_evaluation", f"{rule}.question_template", "string").alias("question_template"), inside("style_evaluation", f"{rule}.matched_template", "boolean").alias("matched_template"),
        inside("style_evaluation", f"{judged}.specificity_calibration_score", "int").alias("specificity"), inside("style_evaluation", f"{judged}.lexical_naturalism_score", "int").alias("naturalism"), inside("style_evaluation", f"{judged}.semantic_constraint_count", "int").alias("constraint_count"),
    )


def p3_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records by schema path over the distinct artifacts."""
    nodes = nested.dewey_nodes(table(spark, folder, "pipeline_output"), "artifact_id", "payload", with_fields=False).select("doc_key", "path", "dewey").distinct()
    return nodes.groupBy("path").agg(F.count("*").alias("n_records"), F.countDistinct("doc_key").alias("n_artifacts"))


def legacy_alias_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Queries of all artifacts with the number of their bullet, under whichever name it stands."""
    queries = nested.dewey_nodes(table(spark, folder, "pipeline_output"), "artifact_id", "payload", only=["papers.queries"])
    return queries.select("doc_key", F.col("dewey").alias("node"), notes.bullet_number(F.col("fields")).alias("bullet")).distinct()


# The same in SQL, for values wrapped or encoded up to six times (the data hold fewer).


def _plain(sql: str, rounds: int = 6) -> str:
    """sql with the JSON column x without its wrappings."""
    text = "trim(ltrim(trim(x->>'$'), chr(65279)))"
    step = f"case when json_type(x) = 'OBJECT' and json_keys(x) = ['value'] then json_extract(x, '$.value') when json_type(x) = 'VARCHAR' and (regexp_matches({text}, '^[{{\\[\"]') or {text} = 'null') and json_valid({text}) then {text}::json else x end"
    for _ in range(rounds):
        sql = f"(select * replace ({step} as x) from {sql})"
    return sql


def _field(sql: str, name: str) -> str:
    """The field of the objects x, without wrappings."""
    return _plain(f"(select * replace (json_extract(x, '$.{name}') as x) from {sql} where json_type(x) = 'OBJECT')")


def _listed(sql: str, name: str, place: str) -> str:
    """The elements of a list field with their place; a single one has place 0."""
    lists = f"(select * exclude (x), case when json_type(x) = 'ARRAY' then from_json(x, '[\"json\"]') when x is not null then [x] else [] end as l from {_field(sql, name)})"
    return _plain(f"(select * exclude (l), unnest(l) as x, unnest(range(len(l)))::int as {place} from {lists})")


def _objects(sql: str) -> str:
    return f"(select * from {sql} where json_type(x) = 'OBJECT')"


def _text(name: str, sql: str) -> str:
    """sql with a scalar field of x as text."""
    inner = _plain(f"(select * exclude (x), x as whole, json_extract(x, '$.{name}') as x from {sql})")
    return f"(select * exclude (x, whole), whole as x, case json_type(x) when 'VARCHAR' then x->>'$' when 'NULL' then null when 'BOOLEAN' then x::varchar else x::varchar end as {name} from {inner})"


_START = "ltrim(payload, chr(65279) || ' ' || chr(9) || chr(10) || chr(13))"
_ROOT = _plain(f"(select distinct artifact_id as doc_key, case when json_valid({_START}) then {_START}::json end as x from pipeline_output where artifact_id is not null and payload is not null)")
_PAPERS = _objects(_listed(_ROOT, "papers", "p"))
_QUERIES = _objects(_listed(_PAPERS, "queries", "q"))
_CONTEXT = _objects(_field(_QUERIES, "hard_negative_context"))
_KEYWORDS = f"(select *, x->>'$' as keyword from {_listed(_CONTEXT, 'keywords_extracted', 'c')} where json_type(x) = 'VARCHAR' and trim(x->>'$') <> '')"
_PARTS = {"hard_negative": _objects(_listed(_CONTEXT, "hard_negatives", "c")), "positive": _objects(_listed(_CONTEXT, "positives", "c")), "keyword": _KEYWORDS}
_KEYS = "doc_key as artifact_id, p as paper_pos, q as query_pos"
_FOUND_SQL = " union all ".join([f"select distinct {_KEYS}, '{child}' as child, c as child_pos from {sql}" for child, sql in _PARTS.items()] + [f"select distinct {_KEYS}, 'analysis' as child, 0 as child_pos from {_objects(_field(_QUERIES, 'query_analysis'))}"])
ORACLE: dict[str, str] = {
    "p3_found": _FOUND_SQL,
    "p3_papers": f"select distinct doc_key, p::varchar as node, null::varchar as parent_node, p as position, paper_id, paper_title from {_text('paper_id', _text('paper_title', _PAPERS))}",
    "p3_queries": f"select distinct doc_key, p || '.' || q as node, p::varchar as parent_node, q as position, query_text, source_view, is_multimodal, related_bullet_justification from {_text('query_text', _text('source_view', _text('is_multimodal', _text('related_bullet_justification', _QUERIES))))}",
    "p3_keywords": f"select distinct doc_key, p || '.' || q || '.0.' || c as node, p || '.' || q || '.0' as parent_node, c as position, keyword from {_KEYWORDS}",
}

QUERIES = {f.__name__: f for f in (p3_found, p3_papers, p3_queries, p3_hard_negatives, p3_positives, p3_keywords, p3_analyses, p3_counts, legacy_alias_resolution)}
