import random

import numpy as np

from corpusforge.llm import labelmodel, linkage

FOUND = "cand_id bigint, paper_title string, authors array<string>, year int, abstract string, title string"
PAPERS = "paper_id string, title string, authors array<string>, year int, abstract string, pos bigint"
SUR = [a + b + c for a in ("Br", "Kl", "Sk", "Tr", "Fl", "Gr") for b in ("ando", "evin", "oska", "umbe", "ilte") for c in ("rg", "nt", "ll", "ssen")]
TOPIC = "graph matching,speech synthesis,crowd counting,offline control,pose tracking,entity linking,music search,scene flow".split(",")


def work(rng):
    title = f"{rng.choice(['Robust', 'Latent', 'Sparse', 'Causal'])} {rng.choice(['Encoders', 'Planners', 'Kernels'])} for {rng.choice(TOPIC).title()} via {rng.choice(['Gated', 'Modular', 'Streaming'])} {rng.choice(['Critics', 'Decoders', 'Priors'])} {rng.randrange(10, 99)}"
    authors = [f"{rng.choice(['Anna', 'Boris', 'Chloe', 'Dmitri'])} {s}" for s in rng.sample(SUR, rng.randrange(2, 5))]
    abstract = " ".join(f"We study {rng.choice(TOPIC)} with {rng.randrange(1000)} samples and {rng.randrange(1000)} labels in setting {rng.randrange(10000)}." for _ in range(5))
    return title, authors, rng.randrange(2015, 2025), abstract


def test_links_against_known_truth(spark):
    rng, papers, found, truth = random.Random(8), [], [], {}
    for i in range(120):
        t, a, y, s = work(rng)
        papers.append((f"p{i}", t, a, y, s, i))
        for k in range(4):
            c = len(found)
            title = [t, t.upper(), t[: len(t) * 2 // 3] + "…", "[PDF] " + t][k]
            names = [x.split()[0][0] + ". " + x.split()[1] for x in a] if k % 2 else a[: max(1, len(a) - 1)]
            found.append((c, title, names, y + (k == 1), [s, s[:280], None, s][k], "clash"))
            truth[c] = f"p{i}"
        found.append((len(found), t + ", Part II", a, y + 1, work(rng)[3], "clash"))
        other = work(rng)
        found.append((len(found), t, other[1], other[2], other[3], "clash"))
        found.append((len(found), *work(rng), "clash"))
    got = {r.cand_id: r for r in linkage.linked(spark.createDataFrame(found, FOUND), spark.createDataFrame(papers, PAPERS)).collect()}
    right = sum(truth.get(c) == r.paper_id for c, r in got.items())
    assert right / len(got) > 0.97 and right / len(truth) > 0.97
    assert all(0.5 <= r.confidence <= 1.0 for r in got.values())


def test_hot_keys_are_refined_not_dropped(spark):
    rng = random.Random(2)
    papers = [(f"p{i}", *work(rng), i) for i in range(30)]
    shared = "This is one sentence that stands in the abstract of every single paper here."
    papers = [(p, t, a, y, shared + " " + s, n) for p, t, a, y, s, n in papers]
    found = [(i, t, a, y, s, "") for i, (_, t, a, y, s, _) in enumerate(papers)]
    f, p = spark.createDataFrame(found, FOUND), spark.createDataFrame(papers, PAPERS)
    d, e = linkage.described(f, "cand_id", "paper_title", False), linkage.described(p, "paper_id", "title", True)
    met = {(r.id, r.paper) for r in linkage.candidate_pairs(d, e, linkage._lent(d), hot=5).collect()}
    assert {(i, f"p{i}") for i in range(30)} <= met


def test_hot_keys_give_the_same_pairs_as_others(spark):
    rng = random.Random(4)
    shared = ["This is one sentence that stands in the abstract of every single paper here.", "Another such sentence stands in nearly all of the abstracts of this table."]
    papers = [(f"p{i}", t, a, y, " ".join(shared[: 1 + (i % 3 > 0)]) + " " + s, i) for i, (t, a, y, s) in ((i, work(rng)) for i in range(30))]
    cut = lambda s, n: ". ".join(s.split(". ")[:n]) + "."
    found = [(4 * i + k, t if k else None, [None, a, ["Nobody Else"], None][k], y, [cut(s, 3), s, cut(s, 2), None][k], "") for i, (_, t, a, y, s, _) in enumerate(papers) for k in range(4)]
    d = linkage.described(spark.createDataFrame(found, FOUND), "cand_id", "paper_title", False)
    e = linkage.described(spark.createDataFrame(papers, PAPERS), "paper_id", "title", True)
    cold, hot = ({tuple(r) for r in linkage.candidate_pairs(d, e, linkage._lent(d), hot=n).select("id", "paper", "n_shared", "n").collect()} for n in (10_000, 5))
    assert hot == cold and {(4 * i, f"p{i}") for i in range(30)} <= {r[:2] for r in hot}


def test_nulls_repeats_and_empty_tables(spark):
    p = [("p", "A Title of Some Length", ["Anna Brandorg"], 2020, "We study it. " * 9, 1), (None, "x", None, None, None, 2), ("q", None, None, None, None, 3)]
    f = [(1, "A Title of Some Length", ["A. Brandorg"], None, None, ""), (1, "A Title of Some Length", ["A. Brandorg"], None, None, ""), (None, "x", None, None, None, ""), (2, None, None, None, None, ""), (3, "", [], None, "N/A", ""), (4, "…", [None, "et al."], 1999, "x" * 100_000, "")]
    run = lambda a, b: [tuple(r)[:2] for r in linkage.linked(spark.createDataFrame(a, FOUND), spark.createDataFrame(b, PAPERS)).collect()]
    assert set(run(f, p)) <= {(1, "p")}
    assert run([], p) == [] and run(f, []) == [] and run([], []) == []


def test_label_model_learns_accuracies_and_correlation():
    rng = np.random.default_rng(1)
    n = 20000
    y = rng.random(n) < 0.3
    vote = lambda acc: np.where(rng.random(n) < acc, np.where(y, 1, -1), np.where(y, -1, 1))
    a, b, c = vote(0.9), vote(0.85), vote(0.8)
    noisy = vote(0.6)
    copy = np.where(rng.random(n) < 0.95, noisy, vote(0.6))
    v = np.stack([a, b, c, noisy, copy, np.where(rng.random(n) < 0.95, noisy, copy)], 1)
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    start = 1 / (1 + np.exp(-patterns @ np.array([1, 1, 1, 0.3, 0.3, 0.3])))[:, None]
    q, learned = labelmodel.fit(patterns, counts.astype(float), np.hstack([1 - start, start]))
    accuracy = ((q[:, 1] > 0.5)[at.ravel()] == y).mean()
    assert accuracy > 0.93 and accuracy > ((v.sum(1) > 0) == y).mean() + 0.03
    assert sum(p >= 3 for p in learned["parents"][3:]) >= 2
    assert len(labelmodel.fit(np.zeros((0, 3), int), np.zeros(0), np.zeros((0, 2)))[0]) == 0


def test_sentences_are_keyed_as_a_whole():
    start = "We study " + "a very long beginning of a sentence " * 12
    a, b = linkage.sentences(start + "that ends in one way. And more words follow in another sentence here."), linkage.sentences(start + "that ends in quite another way. And more words follow in another sentence here.")
    assert len(a[0][0]) > 300 and a[0][0] != b[0][0] and a[0][1] == b[0][1] and a[1][0] == b[1][0]
    assert linkage.sentences("Odd \0 sign in this sentence, which is long enough to be kept as a key for all that follows it.")[0]
