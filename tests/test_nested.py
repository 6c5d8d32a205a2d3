import json

import pytest

from corpusforge.operators import nested

ROWS = "artifact_id bigint, payload string, path string"


def children(spark, *payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in payloads], ROWS)
    return sorted(tuple(r) for r in nested.query_children(df).collect())


def one(query):
    return json.dumps({"papers": [{"queries": [query]}]})


def test_plain_children(spark):
    got = children(spark, (1, one({"hard_negative_context": {"hard_negatives": [{"a": 1}, None, {}], "positives": {"b": 2}, "keywords_extracted": ["x", " ", None, "y"]}, "query_analysis": {"decision": "Keep"}})))
    assert got == [(1, 0, 0, "analysis", 0), (1, 0, 0, "hard_negative", 0), (1, 0, 0, "hard_negative", 2), (1, 0, 0, "keyword", 0), (1, 0, 0, "keyword", 3), (1, 0, 0, "positive", 0)]


@pytest.mark.parametrize("wrap", [lambda x: {"value": x}, json.dumps, lambda x: {"value": json.dumps({"value": x})}])
def test_wrappings_count_the_same(spark, wrap):
    q = {"hard_negative_context": wrap({"hard_negatives": wrap([wrap({"a": 1})]), "keywords_extracted": wrap(["k"])}), "query_analysis": wrap({"d": 1})}
    text = json.dumps({"papers": wrap([wrap({"queries": wrap([None, wrap(q)])})])})
    assert children(spark, (5, text)) == [(5, 0, 1, "analysis", 0), (5, 0, 1, "hard_negative", 0), (5, 0, 1, "keyword", 0)]


def test_one_element_where_a_list_belongs(spark):
    text = json.dumps({"papers": {"queries": {"hard_negative_context": {"keywords_extracted": "solo", "hard_negatives": {"a": 1}}}}})
    assert children(spark, (2, text)) == [(2, 0, 0, "hard_negative", 0), (2, 0, 0, "keyword", 0)]


def test_unreadable_null_empty_and_repeated(spark):
    good = one({"query_analysis": {"d": 1}})
    got = children(spark, (1, good[:-3]), (2, None), (3, ""), (4, "[]"), (5, "﻿" + good), (5, "﻿" + good), (None, good), (6, "{}"))
    assert got == [(5, 0, 0, "analysis", 0)]
    assert children(spark) == []


def test_deep_nesting_does_not_crash(spark):
    assert children(spark, (1, "[" * 100_000), (2, '{"papers":' + "[" * 5000 + "]" * 5000 + "}")) == []


def test_tables_link_to_their_parents(spark):
    text = json.dumps({"papers": [{"paper_id": "p", "queries": [{"query_text": "a"}, {"query_text": "b", "query_analysis": {"decision": "Keep"}}]}]})
    nodes = nested.dewey_nodes(spark.createDataFrame([(1, text, "")], ROWS), "artifact_id", "payload")
    queries = {r.node: r for r in nested.node_table(nodes, "papers.queries", ["query_text"]).collect()}
    papers = {r.node for r in nested.node_table(nodes, "papers", ["paper_id"]).collect()}
    analyses = nested.node_table(nodes, nested.QUERY_CHILDREN["analysis"], ["decision"]).collect()
    assert {r.parent_node for r in queries.values()} <= papers
    assert [queries[a.parent_node].query_text for a in analyses] == ["b"]


def test_wrappings_of_any_depth():
    value = {"a": 1}
    for _ in range(200):
        value = {"value": value}
    assert nested.plain(value) == {"a": 1}
    text = {"a": 1}
    for _ in range(8):
        text = {"value": json.dumps(text)}
    assert nested.plain(text) == {"a": 1}


def test_only_the_wanted_paths_give_rows(spark):
    text = json.dumps({"papers": [{"paper_id": "p", "summary_views": [{"view_name": "v", "bullet_points": [{"text": "a"}]}], "queries": [{"query_text": "q"}]}]})
    df = spark.createDataFrame([(1, text, "")], ROWS)
    paths = lambda **kw: sorted(r.path for r in nested.dewey_nodes(df, "artifact_id", "payload", **kw).collect())
    assert paths(only=["papers.queries"]) == ["papers.queries"]
    assert paths() == ["papers", "papers.queries", "papers.summary_views", "papers.summary_views.bullet_points"]
