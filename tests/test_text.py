from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import templates as tpl
from corpusforge.functions import text as tx


def values(spark, expr, *inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_known_answers(spark):
    assert values(spark, tx.token_count, "a b  c", "a b", "a　b", "a b", "") == [3, 2, 2, 2, 0]
    assert values(spark, tx.field_id, "abc", "", "Is there a paper?", None) == ["590", "0", "13788", None]
    assert values(spark, tx.short_hash, "A Title") == ["965bb3bbd17b"]
    assert values(spark, tx.venue_of_path, "ICLR.cc/2025/Conference", "aclweb.org/ACL/2024/Conference", "X.org/EMNLP/2023/Conf", "a/b/c/2023/d", None) == ["ICLR.cc", "aclweb.org/ACL/2024", "X.org/EMNLP/2023", "a/b/c/2023", None]
    assert values(spark, tx.venue_of_summary, "A Smith - NeurIPS, 2023 - proceedings.neurips.cc", "only") == ["proceedings.neurips.cc", None]
    assert values(spark, lambda c: tx.archive_id(c, r"arxiv\.org"), "https://arxiv.org/abs/2401.01234v2", "x 2401.01234v1 y", "none") == ["2401.01234", "2401.01234", None]
    assert values(spark, tx.score_1_to_5, "3", "3.7", "0", "6", "x", None) == [3, 3, None, None, None, None]
    assert values(spark, lambda c: tx.centered_fit(c.cast("double")), "1", "2", "3", "4", "5") == [0, 0.5, 1, 0.5, 0]
    assert values(spark, tx.venue_id, " nips ", "ICML", "My Venue") == ["NeurIPS.cc", "ICML.cc", "My_Venue"]
    assert values(spark, tx.heading_name, "3 test-time scaling", "A  RESULTS :", "7 ") == ["Test-Time Scaling", "Results", "7"]


def test_templates(spark):
    got = values(spark, lambda c: tpl.template_name(tpl.template_rank(c)), "Can I use X", "Papers using RL", "Attention Is All You Need", None, "")
    assert got == ["Can [we/X]...", "Give me papers [that/on/about]...", "other", "other", "other"]


def test_json_in_prose(spark):
    got = values(spark, lambda c: F.try_variant_get(tx.json_in_prose(c), "$.a", "int"), 'so: {"a": 3} ok', "nothing", '{"a": ', None)
    assert got == [3, None, None, None]


def test_lines_and_variants(spark):
    df = spark.createDataFrame([(["a-", "b", "  ", "c d"], "graph nets", ["Graph", "Nets"])], "l array<string>, q string, k array<string>")
    r = df.select(tx.joined_lines(F.col("l")), tx.search_variants(F.col("q"), F.col("k"))).first()
    assert (r[0], r[1]) == ("ab c d", ["graph nets"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n 　\x1c'-", max_size=12), min_size=1, max_size=20))
def test_python_string_semantics(spark, texts):
    assert values(spark, tx.token_count, *texts) == [len(t.split()) for t in texts]
    assert values(spark, tx.strip, *texts) == [t.strip() for t in texts]
    assert values(spark, tx.python_title, *texts) == [t.title() for t in texts]
