import random
from collections import Counter

from pyspark.sql import functions as F

from corpusforge.llm import consensus as C

ITEM = ["query_id", "feedback_item_id"]
ROWS = "id bigint, query_id string, feedback_item_id string, reviewer_username string, judgement string, updated_at bigint, label string, annotator string"


def edges(spark, rows):
    return C.label_edges(spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS), ITEM)


def labels(spark, rows):
    items, annotators = C.consensus(edges(spark, rows), ITEM)
    return {(r.query_id, r.feedback_item_id): r for r in items.collect()}, {r.annotator: r for r in annotators.collect()}


def test_spellings(spark):
    raw = ["Yes", " y ", "YES!", "no.", "N", "Nope", "?", "Not sure", "UNSURE", "", None, "  ", "whatever", "No way", "notsure"]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in raw], "j string").select(C.judgement_class(F.col("j"))).collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2, 2, None, None, None, 2, 1, 2]


def test_latest_row_holds_and_names_fold(spark):
    rows = [(1, "q", "a", "Ann", "Yes", 1), (2, "q", "a", " ann ", "No", 2), (3, "q", "a", "ANN", "Unsure", 2), (4, "q", None, "ann", "Yes", 1), (5, "q", "b", None, "Yes", 1), (6, "q", "b", "bob", None, 1)]
    assert [(r.annotator, r.label) for r in edges(spark, rows).collect()] == [("ann", 2)]


def test_reliable_minority_and_contrary_annotators(spark):
    rng, rows, truth = random.Random(2), [], {}
    skill = {f"good{i}": 0.93 for i in range(4)} | {f"spam{i}": 0.0 for i in range(5)} | {"contrary": 0.05}
    for i in range(220):
        t = rng.choice(["Yes", "Yes", "No", "No", "Unsure"])
        truth[(f"q{i}", "x")] = t
        for name, p in skill.items():
            if rng.random() < 0.8:
                vote = "Yes" if name.startswith("spam") and rng.random() < 0.9 else t if rng.random() < p else rng.choice([x for x in C.CLASSES if x != t])
                rows.append((len(rows), f"q{i}", "x", name, vote, i))
    got, annotators = labels(spark, rows)
    right = sum(got[k].judgement == t for k, t in truth.items()) / len(truth)
    majority = Counter()
    for r in rows:
        majority[(r[1], r[2], r[4])] += 1
    by_vote = sum(max(C.CLASSES, key=lambda c: majority[(*k, c)]) == t for k, t in truth.items()) / len(truth)
    assert right > 0.95 > by_vote
    assert min(a.reliability for n, a in annotators.items() if n.startswith("good")) > annotators["contrary"].reliability
    assert annotators["contrary"].weight < 0


def test_single_judgement_ties_repeats_and_empty(spark):
    got, _ = labels(spark, [(1, "q", "a", "ann", "No", 1), (1, "q", "a", "ann", "No", 1), (2, "r", "a", "bob", "Yes", 1), (3, "r", "a", "cid", "Yes", 1)])
    assert got[("q", "a")].judgement == "No" and got[("r", "a")].judgement == "Yes" and got[("r", "a")].agreement == 1.0
    assert labels(spark, []) == ({}, {})


def test_shuffled_and_broadcast_sums_agree(spark):
    rng = random.Random(4)
    rows = [(i, f"q{i % 30}", "x", f"u{rng.randrange(9)}", rng.choice(C.CLASSES), i) for i in range(200)]
    e = edges(spark, rows)
    a = {tuple(r[:3]) for r in C.consensus(e, ITEM)[0].collect()}
    b = {tuple(r[:3]) for r in C.consensus(e, ITEM, broadcast_rows=0)[0].collect()}
    assert a == b
