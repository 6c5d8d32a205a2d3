import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import dedupe, feedback, graph, layout, notes, rules, stats, textmodel
from corpusforge.plans import artifact_queries, layout_queries


def test_first_place_last_value(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("2", 2, "b"), ("1", 3, "c"), (None, 4, "x"), ("1", 3, "c")], "id string, pos int, v string")
    got = sorted((r.id, r.first_pos, r.v) for r in dedupe.first_place_last_value(df, "id").collect())
    assert got == [("1", 1, "c"), ("2", 2, "b")]
    assert dedupe.first_place_last_value(df.limit(0), "id").count() == 0


def test_complete_groups_need_something_expected(spark):
    want = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "g string, k string")
    have = spark.createDataFrame([("p", "a"), ("q", "a"), ("r", "z")], "g string, k string")
    assert [r.g for r in dedupe.complete_groups(want, have, "g", ["k"]).collect()] == ["q"]


def test_rules_on_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Figure 1 and figure 2 accepted")], "i int, t string")
    got = {r.i: r.passed for r in rules.rule_flags(df, "t", ["accept"], ["arxiv"], 0.05, ["figure"], 2).collect()}
    assert got == {1: False, 2: False, 3: True}


def test_wasserstein(spark):
    rows = [("h", x) for x in (1, 2, 2)] + [("s", x) for x in (2, 3, 3)] + [("h", None)]
    df = spark.createDataFrame(rows, "side string, x int")
    d = lambda a, b: stats.wasserstein(df, "x", "side", a, b).first().distance
    assert d("h", "s") == pytest.approx(1.0) and d("s", "h") == pytest.approx(1.0)


def test_length_stats_and_bins(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "x int")
    r = stats.length_stats(df, F.col("x"), []).first()
    assert (r["mean"], r["std"], r["median"], r["p25"], r["p75"]) == (2.5, pytest.approx(1.118033988749895), 2.5, 1.75, 3.25)
    bins = spark.createDataFrame([(x,) for x in (0, 1, 5, 6, 10, 11)], "x int")
    assert sorted((r.bin, r.n) for r in stats.bins(bins, F.col("x"), 5, []).collect()) == [(0, 3), (1, 2), (2, 1)]


def test_estimated_histogram():
    h = stats.estimated_histogram(2.7, 10)
    assert sum(h.values()) == 10 and sum(k * v for k, v in h.items()) == 27
    assert list(h.values()) == [1, 1, 8, 0, 0]
    assert sum(stats.estimated_histogram(3.0, 0).values()) == 0
    assert list(stats.estimated_histogram(5.0, 3).values()) == [0, 0, 0, 0, 3] and list(stats.estimated_histogram(9.0, 2).values()) == [0, 0, 0, 0, 2]


def test_feedback_round_trip(spark):
    rows = [(1, "p", "q", "query_relevance", "u", "Yes", 1), (2, "p", "q", "hard_negative:1", "u", "No", 2), (3, "p", "q", "hard_negative:1", "u", "Yes", 3)]
    df = spark.createDataFrame(rows, "id bigint, paper_forum_id string, query_id string, feedback_item_id string, reviewer_username string, judgement string, updated_at int")
    df = df.withColumn("created_at", F.col("updated_at"))
    by = ["paper_forum_id", "query_id", "reviewer_username"]
    back = feedback.unpivoted(feedback.pivoted(df, by, ["updated_at", "id"]), by)
    assert sorted((r.feedback_item_id, r.judgement) for r in back.collect()) == [("hard_negative:1", "Yes"), ("query_relevance", "Yes")]
    once = feedback.upserted(df, df.limit(0))
    assert sorted((r.id, r.judgement) for r in once.collect()) == [(1, "Yes"), (2, "Yes")]
    assert sorted((r.id, r.judgement) for r in feedback.upserted(once, df).collect()) == [(1, "Yes"), (2, "Yes")]
    assert feedback.deleted(df, df.where("id = 1"), by).count() == 0


def test_connected_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(20)] + [(7, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    want = {x: find(x) for x in list(parent)}
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_layout(spark):
    frags = [("d", 1, 0, "Hello", 10.0, 100.0, 10.0), ("d", 1, 1, "world", 60.0, 101.0, 10.0), ("d", 1, 2, "1 Intro", 10.0, 80.0, 10.0), ("d", 1, 3, "text", 10.0, 68.0, 10.0), ("d", 1, 4, "far", 10.0, 30.0, 10.0), ("d", 1, 5, "\x00 ", 5.0, 30.0, 10.0)]
    lines = layout.lines_of(spark.createDataFrame(frags, "doc string, page int, frag int, text string, x double, y double, font_size double"))
    texts = [r.text for r in lines.orderBy("line").collect()]
    assert texts == ["Hello world", "1 Intro", "text", "far"]
    blocks = {r.text: r.block for r in layout.blocks_of(lines).collect()}
    assert blocks["1 Intro"] == 1 and blocks["text"] == 2 and blocks["far"] == 3


def test_captions_and_runs(spark):
    rows = [("d", 1, 0, "Figure 1: A plot", 100.0), ("d", 1, 1, "that goes on.", 90.0), ("d", 1, 2, "Body.", 80.0)]
    cap = layout.captions(spark.createDataFrame(rows, "doc string, page int, line int, text string, y double")).collect()
    assert [(c.caption, c.n_lines) for c in cap] == [("Figure 1: A plot that goes on. Body.", 3)]  # a full stop counts after 50 characters
    long = [("d", 1, 0, "Table 2: Results of all methods on the sets", 9.0, 100.0), ("d", 1, 1, "named above, with errors.", 9.0, 90.0), ("d", 1, 2, "Body.", 9.0, 80.0), ("d", 1, 3, "Table 3: Short", 9.0, 60.0), ("d", 1, 4, "far right", 80.0, 50.0), ("d", 1, 5, "1 Intro", 9.0, 40.0)]
    cap = layout.captions(spark.createDataFrame(long, "doc string, page int, line int, text string, x_min double, y double")).collect()
    assert sorted((c.caption, c.n_lines) for c in cap) == [("Table 2: Results of all methods on the sets named above, with errors.", 2), ("Table 3: Short", 1)]
    df = spark.createDataFrame([(1, p, n) for p, n in enumerate([5, 5, 0, 5, 0, 0, 0, 5])], "g int, p int, n int")
    got = sorted((r.run_start, r.run_end) for r in layout.runs(df, ["g"], "p", F.col("n"), 1, 1).collect())
    assert got == [(0, 3), (7, 7)]


def test_notes(spark):
    kinds = ["V/-/Official_Review", "V/-/Response_to_Review", "V/-/Meta_Review", "V/-/Official_Comment", "V/-/Withdrawal", None]
    df = spark.createDataFrame([(k,) for k in kinds], "i string")
    assert [r[0] for r in df.select(notes.kind(F.col("i"))).collect()] == ["review", "rebuttal", "meta_review", "comment", "other", "other"]
    m = spark.sql("select map('summary', 'a', 'x', 'b', 'cons', null) m").select(notes.renamed_fields(F.col("m"))).first()[0]
    assert m == {"review": "a", "x": "b"}


def test_text_model_calls_each_prompt_once(spark):
    df = spark.createDataFrame([(1, "p"), (2, "p"), (3, None), (4, "q")], "i int, prompt string")
    out = textmodel.answered(df, "prompt", textmodel.mock_model)
    got = {r.i: r.score for r in out.select("i", textmodel.in_answer(F.col("answer"), "$.score", "int").alias("score")).collect()}
    assert got[1] == got[2] and got[3] is None and 1 <= got[4] <= 5
    known = out.where("i = 4").select("prompt_hash", F.lit("kept").alias("answer"))
    assert {r.i: r.answer for r in textmodel.answered(df, "prompt", lambda p: "new", known).collect()}[4] == "kept"


def test_style_judge_scores_every_query(spark, tmp_path):
    rows = [("a", 3, "first"), ("a", 7, "second"), ("a", 9, None), ("a", 12, "two\nlines\n2. more"), ("b", 5, "other")]
    spark.createDataFrame(rows, "paper_id string, qpos int, query_text string").write.parquet(f"{tmp_path}/queries.parquet")
    got = {(r.paper_id, r.qpos): r.score for r in artifact_queries.QUERIES["style_judge_mock"](spark, str(tmp_path)).collect()}
    alone = lambda t: hashlib.sha1(t.encode()).digest()[1] % 5 + 1
    assert got == {("a", 3): alone("0. first"), ("a", 7): alone("1. second"), ("a", 9): alone("2. "), ("a", 12): alone("3. two lines 2. more"), ("b", 5): alone("0. other")}
    short = spark.createDataFrame([("x", 'so: {"results": [{"score": 4}, null]}'), ("y", "no json"), ("z", None)], "i string, answer string")
    assert [(r.i, r.place) for r in textmodel.listed_in_answer(short, "answer", "$.results", "place", "r").collect()] == [("x", 0), ("x", 1)]


def test_key_ring():
    now, calls = [0.0], []

    def ask(key):
        calls.append(key)
        if len(calls) == 1:
            raise OSError("busy")
        return key

    ring = textmodel.KeyRing(["a", "b"], interval=2.0, backoff=1.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert ring.call(ask) == "b" and calls == ["a", "b"] and now[0] == 1.0
    with pytest.raises(OSError):
        textmodel.KeyRing(["a"], retries=2).call(lambda k: (_ for _ in ()).throw(OSError()))
    assert math.isfinite(now[0])


def test_sources(spark, tmp_path):
    from corpusforge.sources import files, search
    from corpusforge.sources.forum import ForumSource

    (tmp_path / "a.json").write_text('{"papers": [{"id": "x"}, {"id": "é"}], "n": 2}')
    assert [(r.pos, r.id) for r in files.records(spark, str(tmp_path / "a.json"), "struct<id:string>", "papers").orderBy("pos").collect()] == [(0, "x"), (1, "é")]
    assert files.records(spark, str(tmp_path / "none.json"), "struct<id:string>", "papers", optional=True).count() == 0
    assert files.settings(None, {"a": {"b": 1}}) == {"a": {"b": 1}}
    (tmp_path / "s.json").write_text('{"a": {"c": 2}}')
    assert files.settings(str(tmp_path / "s.json"), {"a": {"b": 1, "c": 0}}) == {"a": {"b": 1, "c": 2}}
    spark.dataSource.register(ForumSource)
    read = spark.read.format("forum").option("years", "2023,2024")
    assert [r.paper_id for r in read.option("limit", "3").load().orderBy("pos").collect()] == ["paper_2024_0", "paper_2024_1", "paper_2024_2"]
    assert [r.paper_id for r in read.option("ids", "paper_2023_4").load().collect()] == ["paper_2023_4"]
    q = spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "q string")
    found = search.from_client(q, "q", lambda text, n: [{"title": text + str(i)} for i in range(9)] + [{"title": ""}], 2)
    assert sorted(r.paper_title for r in found.collect()) == ["a0", "a1"]


def test_stream_resume_does_each_file_once(spark, tmp_path):
    from corpusforge.streaming.resume import resumed

    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    spark.range(3).write.parquet(src)
    step = lambda: resumed(spark, src, "id bigint", lambda df: df.selectExpr("id + 1 as id"), out, check)
    assert step() >= 1
    step()
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).write.mode("append").parquet(src)
    step()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5]


def test_artifact(spark):
    from corpusforge.operators import artifact

    papers = spark.createDataFrame([("p", "old", 1), ("p", "new", 2), ("z", "t", 3)], "paper_id string, title string, pos int")
    queries = spark.createDataFrame([("p", 0, "a", "v", False), ("p", 1, "b", "v", None)], "paper_id string, qpos int, query_text string, source_view string, is_multimodal boolean")
    rows = [(1, "p", "a", "v", 0, "hard_negative", "t", "u", "r")] * 2 + [(2, "p", "a", "v", 1, "ignored", "t", "u", "r")]
    cands = spark.createDataFrame(rows, "cand_id bigint, paper_id string, query_text string, source_view string, cand_pos int, label string, paper_title string, url string, reason string")
    out = artifact.assembled(papers, queries, cands)
    got = {r.paper_id: (r.title, len(r.queries)) for r in out.collect()}
    assert got == {"p": ("new", 2), "z": ("t", 0)}
    assert tuple(artifact.totals(out).first()) == (2, 2, 1, 0)
    assert [tuple(r) for r in artifact.flattened(out).collect()] == [("p", 0, "hard_negative", 1, 1)]


def test_stage_specs():
    from corpusforge.plans import stages

    assert len(stages.parse_spec("0-5")) == 6 and stages.parse_spec("generate-queries") == ["generate-queries"]
    assert stages.parse_spec("2,1") == ["filter", "summarize"]
    for bad in ("3-1", "0,2", "", "nope"):
        with pytest.raises(ValueError):
            stages.parse_spec(bad)
    assert stages.run("0-1", {"download": lambda x, p: [p], "filter": lambda x, p: x + [p]}, "/o") == ["/o/00_download", "/o/01_filter"]


def test_registry_without_the_optional_subpackage():
    from corpusforge.plans import registry

    names = registry.queries()
    assert "p3_found" in names and set(registry.oracle_sql()) <= set(names)


def test_references_and_bullet_numbers(spark):
    n = spark.createDataFrame([("t", "review", 7, "a"), ("t", "review", 9, "b"), ("t", "decision", None, "d"), (None, "review", 1, "x")], "t string, k string, n int, v string")
    r = spark.createDataFrame([(1, "Review/Entry 9/text", "t"), (2, "Review/Entry 1/text", "t"), (3, "Decision/Entry 5/x", "t"), (4, "Review", "t"), (5, None, "t")], "i int, ref string, t string")
    section, entry, _ = notes.parsed_ref(F.col("ref"))
    out = notes.referenced(r.select("i", "t", section.alias("s"), entry.alias("e")), n, "t", "s", "e", "k", "n", "v")
    assert {x.i: x.v for x in out.collect()} == {1: "b", 2: "a", 3: "d", 4: None, 5: None}
    f = spark.sql("select explode(array(map('bullet_indice', '[0, 3]'), map('related_bullet_indice', '[null]', 'bullet_index', '4'), map('related_bullet_indice', '2.0'), map('x', '1'), cast(null as map<string,string>))) f")
    assert [x[0] for x in f.select(notes.bullet_number(F.col("f"))).collect()] == [3, 4, 2, None, None]


def test_materialized_tables_can_be_released(spark):
    from corpusforge.session import is_small, materialize, release

    kept = materialize(spark.range(5))
    assert kept.count() == 5 and is_small(kept, 5) and not is_small(kept, 4)
    release(spark)
    with pytest.raises(Exception, match=r"(?i)not.exist|not found|file"):
        kept.collect()


LINE_ROWS = "doc string, page int, line int, text string, x_min double, x_max double, y double, font_size double"


def test_lines_keep_the_first_fragments_height_and_count_missing_fonts(spark):
    frags = [("d", 1, 0, "b", 80.0, 101.0, None), ("d", 1, 1, "a", 10.0, 99.0, 12.0), ("d", 1, 2, "c", 10.0, 98.4, 12.0), ("d", None, 3, "x", 1.0, 1.0, 1.0), ("d", 1, 4, None, 1.0, 1.0, 1.0)]
    lines = layout.lines_of(spark.createDataFrame(frags, "doc string, page int, frag int, text string, x double, y double, font_size double")).orderBy("line").collect()
    # the anchor is the row's first fragment from the top (101): 98.4 is beyond 2.5 of it though not of 99
    assert [(r.text, r.y, r.font_size) for r in lines] == [("a b", 99.0, 10.0), ("c", 98.4, 12.0)]
    assert layout.lines_of(spark.createDataFrame([], "doc string, page int, frag int, text string, x double, y double, font_size double")).count() == 0


def test_page_blocks_and_regions(spark):
    rows = [
        (0, "1 Intro", 10.0, 700.0), (1, "Plain text here", 10.0, 690.0), (2, "axis label", 30.0, 640.0), (3, "42", 30.0, 630.0), (4, "Figure 1: A plot", 10.0, 600.0),
        (5, "x = 3 + 4 = 7", 10.0, 560.0), (6, "y = 1 + 2 = 3", 10.0, 550.0), (7, "Table 1: Numbers", 10.0, 500.0), (8, "1 2 3", 10.0, 470.0), (9, "4 5 6", 10.0, 460.0), (10, "after the table", 10.0, 400.0),
    ]
    lines = spark.createDataFrame([("d", 1, i, t, x, x + 100.0, y, 10.0) for i, t, x, y in rows], LINE_ROWS)
    kinds = {(r.kind, r.head): (r.caption_lines, r.content_lines) for r in layout.page_structure(lines).collect()}
    assert kinds == {("figure", 4): ([4], [2]), ("table", 7): ([7], [8, 9]), ("equation", 5): ([], [5, 6])}
    blocks = layout.page_blocks(lines).orderBy("block").collect()
    assert [(b.block_type, b.text, b.caption) for b in blocks] == [
        ("heading", "1 Intro", None), ("text", "Plain text here", None), ("text", "axis label 42", None), ("figure", None, "Figure 1: A plot"),
        ("equation", "x = 3 + 4 = 7\ny = 1 + 2 = 3", None), ("table", "1 2 3\n4 5 6", "Table 1: Numbers"), ("text", "after the table", None),
    ]
    region = spark.createDataFrame([("d", 1, "figure", "F", 0.0, 620.0, 200.0, 660.0)], "doc string, page int, block_type string, caption string, x0 double, y0 double, x1 double, y1 double")
    left = layout.with_regions(layout.page_blocks(lines), region).collect()
    assert sorted((b.block_type, b.caption) for b in left if b.block_type in ("figure", "table")) == [("figure", "F")] and "axis label 42" not in [b.text for b in left]
    assert layout.page_blocks(lines.limit(0)).count() == 0
    assert set(layout.block_payload(layout.page_blocks(lines)).columns) == {"block_type", "text", "caption"}
    told = layout.page_blocks(lines.where("line = 1").withColumn("text", F.lit("Appendix Contents")))
    assert layout.without_contents_pages(spark.createDataFrame([("d", 1, "text", "Appendix Contents"), ("d", 1, "text", "a"), ("d", 2, "text", "b")], "doc string, page int, block_type string, text string")).count() == 1 and told.count() == 0


def test_page_blocks_run_python_once_and_join_nothing(spark):
    rows = [("d", p, i, t, 10.0, 90.0, 700.0 - 10 * i - 9 * (i > 3), 10.0) for p in (1, 2) for i, t in enumerate(["Figure 1: A", "Plain", "x = 3 + 4 = 7", "Table 2: B", "1 2 3"][: 5 - 3 * (p - 1)])]
    blocks = layout.page_blocks(spark.createDataFrame(rows, LINE_ROWS))
    plan = blocks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("ArrowEvalPython") == 1 and "FlatMapGroups" not in plan and "Join" not in plan
    assert [(b.page, b.block_type, b.text, b.caption) for b in blocks.orderBy("page", "block").collect()] == [
        (1, "figure", None, "Figure 1: A Plain x = 3 + 4 = 7"), (1, "table", "1 2 3", "Table 2: B"), (2, "figure", None, "Figure 1: A Plain"),
    ]


def test_markdown_of_fragments_shuffles_twice(spark):
    frags = [("d", p, k, t, 10.0 + 100 * (k % 2), 700.0 - 30 * (k // 2), 10.0) for p in (1, 2) for k, t in enumerate(["1", "Intro", "Body", "text", "42"])]
    fragments = spark.createDataFrame(frags, "doc string, page int, frag int, text string, x double, y double, font_size double")
    pages = layout.markdown(layout.page_blocks(layout.lines_of(fragments)), ["doc", "page"], ["block"])
    plan = pages._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("ArrowEvalPython") == 1
    assert {r.page: r.markdown for r in pages.collect()} == {p: "## 1 Intro\n\nBody text" for p in (1, 2)}


def _digests(pages):
    return sorted((r.doc, r.page, r.markdown) for r in pages.collect())


def test_markdown_of_sets_is_that_of_its_steps(spark):
    words = ["1", "A", "2.1", "Intro", "x", "=", "3", "+", "y_1", "^", "Figure", "fig.", "Table", "TABLE", "2:", "7", "where", "as\u212aing", "(12)", "f(x)", "≤", "∑", "-", "well-known", "a-b-c", "task:", "Query:", "<image", "<\u0130mage", "ſ",
        "ABSTRACT", "Appendix Contents", "bac\u212a to appendix table of contents", "positive docs", "word.", "\x00", " ", "a\x00b", " z", "p  q", "\u24b6-b-c", "\u0928\u093f-\u0915\u093e-x", "\u4e2d-\u6587-x", "", "\u3000k", "\x1cq", "²-³-½", "42"]
    r, nan, rows = random.Random(5), float("nan"), []
    for page in range(150):
        for k in range(r.choice([1, 3, 10, 40])):
            text = " ".join(r.choice(words) for _ in range(r.choice([1, 1, 2, 3, 6]))) if r.random() > 0.03 else None
            y = r.choice([700.0 - 12 * (k // 3) - r.choice([0, 0.8, 1.6]), 700.0 - r.randint(0, 60) * 10, 700.0 - 18 * k]) if r.random() > 0.01 else r.choice([None, nan, 0.0, -0.0, float("inf"), -float("inf")])
            x = r.choice([50.0, 50.0 + 60 * (k % 3), 2100.0]) if r.random() > 0.01 else r.choice([None, nan, -0.0])
            rows.append(("d", page if r.random() > 0.01 else None, r.choice([k, k, 0, None]), text, x, y, r.choice([10.0, 8.0, 0.0, None, 12.0])))
            rows += [rows[-1][:3] + (r.choice(words),) + rows[-1][4:]] * (r.random() < 0.05)
    fragments = spark.createDataFrame(rows, "doc string, page int, frag int, text string, x double, y double, font_size double")
    steps = _digests(layout.markdown(layout.page_blocks(layout.lines_of(fragments)), ["doc", "page"], ["block"]))
    assert len(steps) > 100 and _digests(layout.markdown_of_sets(layout.set_pages(fragments))) == steps
    assert _digests(layout.markdown_of_sets(layout.set_pages(fragments.limit(0)))) == []


def test_texts_of_a_batch_go_in_parts(monkeypatch):
    texts = pa.array([["ab", "c"], [], None, ["defg"], [None, "h"], []], pa.list_(pa.string()))
    monkeypatch.setattr(layout, "_SET_BYTES", 3)
    sizes = []
    out = layout.in_parts(lambda own: (sizes.append(len(own)), own)[1], texts.slice(0, 6), texts)
    assert out.equals(texts) and len(sizes) > 1 and layout.in_parts(lambda own: own, texts.slice(0, 0), texts.slice(0, 0)).equals(texts.slice(0, 0))


def test_page_markdown_shuffles_lines_once(spark, tmp_path):
    long = "\n".join(f"{k} Part\nline {k} of a text that goes on\n\n x\u00a0 =  {k} + 1 = 2" for k in range(30))
    texts = [(1, "1 Intro\n\nBody\x00text of this"), (1, "Other text of the same key\nTable 1: A b\n1 2 3 4"), (2, ""), (3, None), (None, "lost"), (4, long), (5, " \u2003\n\t"), (6, "Table 3: A\nq w e r t y")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = layout_queries.page_markdown(spark, str(tmp_path))
    plan = pages._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("ArrowEvalPython") == 1 and "Window" not in plan
    steps = layout.markdown(layout.page_blocks(layout_queries._lines(spark, str(tmp_path))), ["doc", "page"], ["block"]).select("doc", "page", F.md5("markdown").alias("digest"))
    assert sorted(map(tuple, pages.collect())) == sorted(map(tuple, steps.collect())) and steps.count() == 4


def test_document_metadata(spark):
    text = ["Published as a conference paper at X", "A STUDY OF", "LONG TITLES", "Jane Roe, John Doe", "University of Somewhere", "ABSTRACT", "We show", "some-", "thing.", "1 Introduction", "Body"]
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(text)] + [("e", 1, 0, "No title here"), ("f", 2, 0, "ONLY PAGE TWO")], "doc string, page int, line int, text string")
    got = {r.doc: (r.title, r.authors, r.institutions, r.abstract) for r in layout.document_metadata(lines).collect()}
    assert got == {"d": ("A STUDY OF LONG TITLES", ["Jane Roe, John Doe"], ["University of Somewhere"], "We show something."), "e": ("", [], [], "")}


def test_line_arrays_agree_with_windows(spark):
    rng = np.random.default_rng(5)
    rows = [(d, p, "x" * int(rng.integers(0, 12)) if rng.random() < 0.8 else rng.choice(["## A", "## B", "## References"])) for d in range(30) for p in range(int(rng.integers(0, 25)))]
    lines = spark.createDataFrame([(d, p, str(t)) for d, p, t in rows], "doc int, pos int, line string")
    docs = lines.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("a"))
    plain = {tuple(r) for r in layout.runs(lines, ["doc"], "pos", F.length("line"), 6, 1).collect()}
    assert {tuple(r) for r in docs.select("doc", F.inline(layout.line_runs(F.col("a"), 6, 1))).collect()} == plain
    head = F.when(F.startswith("line", F.lit("## ")), F.expr("substr(line, 4)"))
    window = layout.filled_sections(lines, "doc", ["pos"], head, F.col("line") == "## References").groupBy("doc", "section").agg(F.count("*").alias("n"))
    arrays = docs.select("doc", F.inline(layout.line_sections(F.col("a"), "## ", "## References"))).groupBy("doc", "heading").agg(F.sum("n_lines").alias("n"))
    assert {tuple(r) for r in arrays.collect()} == {tuple(r) for r in window.collect()}


def test_mining_records_and_states(spark):
    from corpusforge.operators import forum, mining

    raw = spark.sql("""select 1 as i, parse_json('{"title": " T ", "link": "https://arxiv.org/abs/2401.01234v2", "publication_info": "A B - NeurIPS, 2023 - x.org", "resources": [{"file": {"link": "https://a.b/c.pdf"}}]}') as item
        union all select 2, parse_json('{"title": ""}') union all select 3, parse_json('[1]') union all select 4, null""")
    got = mining.candidates_in(raw, "item", ["i"]).collect()
    assert [(r.i, r.paper_title, r.arxiv_id, r.year, r.venue, r.pdf_url, r.authors) for r in got] == [(1, "T", "2401.01234", 2023, "x.org", "https://a.b/c.pdf", [])]
    have = spark.createDataFrame([("a", "ICLR", 1), ("b", "TMLX", 1), ("c", "TMLX", 1), ("c", "NeurIPS.cc", 2)], "id string, venue string, pos int")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), (None,)], "id string")
    assert sorted((r.id, r.stale) for r in forum.to_fetch(wanted, have).collect()) == [("a", True), ("c", True), ("d", False)]
    ids = spark.createDataFrame([(" a, b ,,a",), ("",), (None,)], "s string").select(forum.requested_ids(F.col("s"))).collect()
    assert [r[0] for r in ids] == [["a", "b"], [], None]


def test_key_rings_are_sent_to_workers(spark):
    from corpusforge.operators.mocks import keyword_model

    rings = [textmodel.KeyRing([k], retries=1) for k in "ab"]
    out = textmodel.answered(spark.createDataFrame([(f"p{i}",) for i in range(12)], "prompt string"), "prompt", lambda prompt, key: key + prompt, rings=rings).collect()
    assert {r.answer[1:] for r in out} == {f"p{i}" for i in range(12)} and {r.answer[0] for r in out} == {"a", "b"}
    assert keyword_model("x") == keyword_model("x")


def test_forum_content_lines(spark):
    from corpusforge.operators import forum

    rows = spark.sql("""select 'f' as forum, '1' as id, 'review' as kind, map('a', 'x', 'b', 'y') as content, 1 as pos union all select 'f', '2', 'decision', map('decision', 'Accept'), 2 union all select 'f', '3', 'review', map('a', 'z'), 3 union all select 'f', '4', 'other', map('a', 'q'), 4""")
    got = {(r.section, r.page): r.text for r in forum.content_lines(rows, {"review": "Review", "decision": "Decision"}, page=1).collect()}
    assert got == {("Review", 0): "=== Review ===\n[Review/Entry 1/a] a: x\n[Review/Entry 1/b] b: y", ("Review", 1): "[Review/Entry 2/a] a: z", ("Decision", 0): "=== Decision ===\n[Decision/decision] decision: Accept"}


def test_resume_helpers(spark):
    done = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "k string, v int")
    targets = spark.createDataFrame([("a", 10), ("b", 5), ("a", 11)], "k string, pos int")
    assert [r.k for r in dedupe.in_first_order(dedupe.still_wanted(done, targets, ["k"]), targets, "k").collect()] == ["b", "a"]


def test_throttle_and_fallback_listing():
    from corpusforge.sources import forum

    now, tries = [0.0], []

    def ask(x):
        tries.append(now[0])
        if len(tries) == 2:
            raise forum.RateLimited(reset=100.0)
        if len(tries) == 3:
            raise forum.RateLimited()
        return x

    t = forum.Throttle(clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert [t.call(ask, 1), t.call(ask, 2)] == [1, 2] and tries == [0.0, 22.0, 100.0, 160.0]
    fails = forum.Throttle(tries=1, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    with pytest.raises(forum.RateLimited):
        fails.call(lambda: (_ for _ in ()).throw(forum.RateLimited()))
    assert forum.first_nonempty([("a", lambda: []), ("b", lambda: 1 / 0), ("c", lambda: [3]), ("d", lambda: [4])]) == ([3], "c")
    assert forum.first_nonempty([("a", lambda: [])]) == ([], "a") and forum.first_nonempty([]) == ([], "")


def test_forum_dispatch(spark):
    from corpusforge.sources import forum

    assert [r.paper_id for r in forum.fetched(spark, [2024], ids=["paper_2023_4", "nope", "paper_2023_4", "paper_2024_1"]).orderBy("pos").collect()] == ["paper_2023_4", "paper_2024_1"]
    kept = forum.fetched(spark, [2024], limit=3, client="corpusforge.sources.forum:StubClient", keep=lambda d: d.where("pos % 2 = 1"))
    assert [r.pos for r in kept.collect()] == [1, 3, 5]
    assert forum.fetched(spark, [2024], limit=4).count() == 4


def test_small_files(tmp_path, spark):
    from corpusforge.sources import files, search

    path = str(tmp_path / "x" / "a.json")
    assert files.json_object(path, optional=True) is None and files.judgements(path) == {"schema_version": 1, "judgments": {}}
    files.save_object(path, {"ä": 1})
    assert files.json_object(path) == {"ä": 1} and "ä" in (tmp_path / "x" / "a.json").read_text()
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError):
        files.json_object(str(tmp_path / "l.json"))
    q = spark.createDataFrame([("a",), ("",), (None,)], "q string")
    client = lambda text, n: ({"title": f"{text}{i}"} for i in range(99))
    assert search.records_from_client(q, "q", client, 50).count() == 20 and search.records_from_client(q, "q", client, 50, most=None).count() == 50
    spark.createDataFrame([(1, "a,b\nc")], "i int, t string").write.option("header", True).csv(str(tmp_path / "c"))
    assert files.delimited(spark, str(tmp_path / "c"), "i int, t string").first().t == "a,b\nc"
    files.write_artifact(spark.createDataFrame([(1, None)], "i int, t string"), str(tmp_path / "j"))
    assert files.json_lines(spark, str(tmp_path / "j"), "i int, t string").collect()[0].asDict() == {"i": 1, "t": None}
    kept = spark.createDataFrame([("A ", 2, "t2"), ("a", 1, "t1"), ("b", 1, "t3")], "search_query string, rank int, paper_title string")
    assert [r.paper_title for r in search.from_table(spark.createDataFrame([("a",)], "q string"), kept, "q", 5).orderBy("rank").collect()] == ["t1", "t2"]


def test_stages_run_and_resume(spark, tmp_path):
    from corpusforge.plans import stages

    papers = spark.createDataFrame([(f"p{i}", f"Paper {i} accepted", "figure one and table two", i) for i in range(6)], "paper_id string, title string, abstract string, pos int")
    index = spark.createDataFrame([("w", 0, 7, "T", None, None, None, 2020, ["A B"], None, "https://x/y.pdf")], "search_query string, rank int, cand_id bigint, paper_title string, arxiv_id string, abstract string, venue string, year int, authors array<string>, url string, pdf_url string")
    asked = []
    s = stages.Settings(limit=4)
    work = lambda p: stages.default_work(spark, p, index, s)
    out = stages.run("0-4", work(papers), str(tmp_path))
    rows = out.collect()
    assert {r.paper_id for r in rows} == {"p0", "p1", "p2", "p3"} and all(r.decision in ("Keep", "Hard Reject") for r in rows)
    assert [r.pos for r in rows] == sorted(r.pos for r in rows)
    # a second run with more papers does only these; papers that are gone are dropped
    s.limit, s.summary_model = None, lambda p: asked.append(p) or "none"
    more = papers.where("pos > 0").unionByName(spark.createDataFrame([("p9", "New accepted", "figure, table", 9)], papers.schema))
    again = stages.run("0-5", work(more), str(tmp_path))
    assert again.columns and {r.paper_id for r in spark.read.parquet(f"{tmp_path}/02_summarize/part=*").collect()} == {"p0", "p1", "p2", "p3", "p4", "p5", "p9"}
    assert len(list((tmp_path / "02_summarize").glob("part=*"))) == 2


def test_reports():
    from corpusforge.operators import reports

    assert [reports.number(x) for x in (1.0, None, float("nan"), "x")] == ["1.000", "N/A", "N/A", "N/A"] and reports.percent(0.125) == "12.5%" and reports.whole(1234) == "1,234" and reports.cell("a|b\nc") == "a\\|b c"
    m = {"query_count": 3, "avg_chars": 10.0, "avg_tokens": 2.0, "unmatched_ratio": 0.5}
    text = reports.comparison("T", {"human": m, "made": m | {"query_count": 5}}, "human", {"made": {"hc_overall": 0.5}}, [{"human": "q|1", "made": None}])
    assert "| Query count | 3 | 5 |" in text and "| hc_overall | - | 0.500 |" in text and "| 1 | q\\|1 |  |" in text and "| Unmatched templates | 50.0% | 50.0% |" in text
    with pytest.raises(ValueError):
        reports.comparison("T", {"made": m}, "human", {}, [])
    assert reports.style_report("d", m | {"specificity_score": 3.0}, [("other", "q")]).endswith("- [other] q\n") and "| p | t | 2 | 1 |" in reports.analysis_report({"n_keep": 1}, [{"paper_id": "p", "title": "t", "n_queries": 2, "n_keep": 1}])


def test_ranked_agrees_with_a_window_in_hot_groups(spark):
    from corpusforge.operators.ranking import ranked

    rng = np.random.default_rng(2)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), int(rng.integers(0, 40)), i) for i in range(600)]
    df = spark.createDataFrame([(None if g is None else str(g), v, i) for g, v, i in rows], "g string, v int, i int").repartition(7)
    order = [F.col("v").desc(), F.col("i")]
    one = lambda most: {(r.i, r.k) for r in ranked(df, ["g"], order, most=most).collect()}
    assert one(10_000) == one(50) and len(one(50)) == 600
    assert ranked(df.limit(0), ["g"], order).count() == 0


def test_a_large_paper_is_several_rows(spark):
    from corpusforge.operators import artifact

    papers = spark.createDataFrame([("p", "t", 1)], "paper_id string, title string, pos int")
    queries = spark.createDataFrame([("p", i, f"q{i}", "v", False) for i in range(25)], "paper_id string, qpos int, query_text string, source_view string, is_multimodal boolean")
    none = spark.createDataFrame([], "cand_id bigint, paper_id string, query_text string, source_view string, cand_pos int, label string, paper_title string, url string, reason string")
    out = artifact.assembled(papers, queries, none, page=10)
    assert sorted((r.page, len(r.queries)) for r in out.collect()) == [(0, 10), (1, 10), (2, 5)] and tuple(artifact.totals(out).first()) == (1, 25, 0, 0)


def test_region_files(spark, tmp_path):
    from corpusforge.sources import files

    (tmp_path / "paper1.pdffigures.json").write_text('{"figures": [{"page": 1, "figureType": "Table", "caption": " A  b", "regionBoundary": {"x1": 10, "y1": 100, "x2": 60, "y2": 20}}, {"page": 9}, 7]}')
    (tmp_path / "paper2.json").write_text('{"regions": [{"pageNumber": 2, "boundary": {"left": 1, "top": 2, "width": 3, "height": 4}}]}')
    (tmp_path / "broken.json").write_text("{")
    heights = spark.createDataFrame([("paper1", 1, 800.0), ("paper2", 2, 100.0)], "doc string, page int, height double")
    got = sorted(tuple(r) for r in layout.regions_in(files.region_records(spark, str(tmp_path)), "item", heights).collect())
    assert got == [("paper1", 1, "table", "A b", 10.0, 700.0, 60.0, 780.0), ("paper2", 2, "figure", "", 1.0, 94.0, 4.0, 98.0)]
    assert files.region_records(spark, str(tmp_path / "none")).count() == 0


def test_chat_model_through_a_ring():
    sent = []

    def send(url, headers, body):
        sent.append((url, headers["Authorization"], body))
        return '{"choices": [{"message": {"content": null}}]}' if len(sent) == 1 else '{"choices": [{"message": {"content": "hello"}}]}'

    model = textmodel.Keyed(textmodel.ChatModel("http://x/v1/", "m", seed=3, send=send), textmodel.KeyRing(["a", "b"]))
    assert model("p") == "hello" and [s[1] for s in sent] == ["Bearer a", "Bearer b"] and sent[0][0] == "http://x/v1/chat/completions" and '"seed": 3' in sent[0][2]
