"""Deeply nested JSON records to flat, linked tables by Dewey labels.

Every record of a document gets a label: the ordinals on the way from the root, joined by '.'.
An element of a list contributes its position in the list as it stands, a single object (or an
object field) contributes 0. The parent's label is the label without its last ordinal and the
parent's schema path is the path without its last name, so no join is needed to link the tables:
each row carries its parent's key by truncation. Nodes are grouped into tables by schema path.

Defined cases: a null document, a document that is no complete JSON (a byte-order mark in front
is ignored) and a top level that is no object give no rows. A value wrapped as the only field
`value` of an object, or encoded once more as JSON text, counts as the value itself, at any level
and in any combination. Nulls and blank strings in a list give no row but keep their position; one
element where a list belongs has position 0; an object where a scalar belongs is kept as JSON
text. Repeated rows give one result row. Unknown fields are kept in `fields`; extra columns of the
input are ignored. Of a field that occurs twice in one object the last holds.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Schema paths of an output artifact: path -> ('list' | 'object', 'record' | 'text').
ARTIFACT_PATHS = {
    "papers": ("list", "record"),
    "papers.queries": ("list", "record"),
    "papers.queries.hard_negative_context": ("object", "record"),
    "papers.queries.hard_negative_context.hard_negatives": ("list", "record"),
    "papers.queries.hard_negative_context.positives": ("list", "record"),
    "papers.queries.hard_negative_context.keywords_extracted": ("list", "text"),
    "papers.queries.query_analysis": ("object", "record"),
    "papers.openreview": ("object", "record"),
    "papers.openreview.reviews": ("list", "record"),
    "papers.openreview.rebuttals": ("list", "record"),
    "papers.openreview.comments": ("list", "record"),
    "papers.openreview.decision": ("object", "record"),
    "papers.filter_status": ("object", "record"),
    "papers.summary_views": ("list", "record"),
    "papers.summary_views.bullet_points": ("list", "record"),
}

NODE_SCHEMA = "doc_key bigint, path string, dewey string, value string, fields map<string,string>"


def plain(value):
    """The value without wrappings, however many: {"value": x} is x, JSON text of an object, list, string or null is that."""
    while True:
        if isinstance(value, dict) and len(value) == 1 and "value" in value:
            value = value["value"]
            continue
        if isinstance(value, str):
            text = value.strip().lstrip("﻿").strip()
            if text[:1] in ("{", "[", '"') or text == "null":
                try:
                    value = json.loads(text)
                    continue
                except (ValueError, RecursionError):
                    return value
        return value


def _scalar(value) -> str | None:
    value = plain(value)
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def _children(tree: dict, record: dict, path: str, dewey: tuple, with_fields: bool, wanted: frozenset) -> Iterator[tuple]:
    """Nodes of the wanted paths below a record; the way to them is walked, but yields nothing itself."""
    for name, (shape, kind, below) in tree.items():
        if name not in record:
            continue
        value = plain(record[name])
        items = value if shape == "list" and isinstance(value, list) else [value]
        where = f"{path}.{name}" if path else name
        for at, item in enumerate(items):
            item = plain(item)
            label = (*dewey, at)
            if kind == "text":
                if where in wanted and isinstance(item, str) and item.strip():
                    yield where, label, item, None
            elif isinstance(item, dict):
                if where in wanted:
                    yield where, label, None, {k: _scalar(v) for k, v in item.items() if k not in below} if with_fields else None
                yield from _children(below, item, where, label, with_fields, wanted)


def _tree(paths: dict, wanted: frozenset) -> dict:
    """The paths that lead to wanted ones as nested names."""
    root: dict = {}
    for path, (shape, kind) in paths.items():
        if not any(w == path or w.startswith(path + ".") for w in wanted):
            continue
        *above, name = path.split(".")
        at = root
        for part in above:
            at = at[part][2]
        at[name] = (shape, kind, {})
    return root


def dewey_nodes(df: DataFrame, key: str, payload: str, paths: dict | None = None, with_fields: bool = True, only: Iterable[str] | None = None) -> DataFrame:
    """Rows (doc_key, path, dewey, value, fields), one per record or text element of the wanted schema paths.

    A narrow operator: each document is read where it lies, nothing is shuffled but the distinct
    over the result. `paths` names the paths as in ARTIFACT_PATHS, parents first; `only` those to give
    rows of (all without it), so a table of one path is made without the rows of the others.
    """
    known = ARTIFACT_PATHS if paths is None else paths
    wanted = frozenset(known if only is None else only)
    tree = _tree(known, wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_key"], batch["payload"]):
                if not isinstance(text, str):
                    continue
                try:
                    root = plain(json.loads(text.lstrip("﻿ \t\r\n")))
                except (ValueError, RecursionError):
                    continue
                if isinstance(root, dict):
                    rows += [(doc, p, ".".join(map(str, d)), v, f) for p, d, v, f in _children(tree, root, "", (), with_fields, wanted)]
            yield pd.DataFrame(rows, columns=["doc_key", "path", "dewey", "value", "fields"])

    source = df.select(F.col(key).cast("bigint").alias("doc_key"), F.col(payload).alias("payload")).where("doc_key is not null and payload is not null")
    return source.mapInPandas(run, NODE_SCHEMA)


def parent_label(dewey: Column) -> Column:
    """The label without its last ordinal; null for a top record."""
    return F.when(F.instr(dewey, ".") > 0, F.regexp_replace(dewey, r"\.[0-9]+$", ""))


def ordinal(dewey: Column, level: int) -> Column:
    """The ordinal at a level (0: top) of a label."""
    return F.get(F.split(dewey, r"\."), F.lit(level)).cast("int")


def node_table(nodes: DataFrame, path: str, fields: list[str] | None = None) -> DataFrame:
    """The flat table of one schema path: keys of the row and of its parent, then the wanted fields as text."""
    rows = nodes.where(F.col("path") == path)
    wanted = [F.col("fields")[name].alias(name) for name in fields or []]
    return rows.select(
        "doc_key",
        F.col("dewey").alias("node"),
        parent_label(F.col("dewey")).alias("parent_node"),
        F.element_at(F.split("dewey", r"\."), -1).cast("int").alias("position"),
        "value",
        *wanted,
    ).distinct()


#: Child tables of a query: kind -> schema path.
QUERY_CHILDREN = {
    "hard_negative": "papers.queries.hard_negative_context.hard_negatives",
    "positive": "papers.queries.hard_negative_context.positives",
    "keyword": "papers.queries.hard_negative_context.keywords_extracted",
    "analysis": "papers.queries.query_analysis",
}


def query_children(df: DataFrame, key: str = "artifact_id", payload: str = "payload") -> DataFrame:
    """(artifact_id, paper_pos, query_pos, child, child_pos): one row per child of a query; parents by truncation."""
    nodes = dewey_nodes(df, key, payload, with_fields=False, only=QUERY_CHILDREN.values())
    label = F.col("dewey")
    kinds = F.create_map(*[F.lit(x) for kind, path in QUERY_CHILDREN.items() for x in (path, kind)])
    return (
        nodes.select(
            F.col("doc_key").alias("artifact_id"),
            ordinal(label, 0).alias("paper_pos"),
            ordinal(label, 1).alias("query_pos"),
            kinds[F.col("path")].alias("child"),
            F.when(F.col("path") == QUERY_CHILDREN["analysis"], F.lit(0)).otherwise(F.element_at(F.split(label, r"\."), -1).cast("int")).alias("child_pos"),
        )
        .distinct()
    )
