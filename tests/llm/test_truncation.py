import random

import numpy as np
import pytest

from corpusforge.llm import truncation as T

ROWS = "cand_id bigint, abstract string, source string, length int, marked boolean"
NOUNS = "model method network encoder policy search kernel planner sampler decoder".split()


def sentence(rng):
    a, b, c = rng.sample(NOUNS, 3)
    return rng.choice([f"We show that the {a} improves the {b} under the {c}.", f"The {a} remains stable when the {b} meets the {c}.", f"Results on the {a} indicate that a {b} replaces the {c}.", f"We prove that the {a} converges with the {b}."])


def judge(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, True) for r in rows], ROWS)
    return {r.cand_id: r for r in T.truncated(df, **kw).collect()}


def test_held_out_cuts(spark):
    rng, rows, cut = random.Random(4), [], set()
    for i in range(1500):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(2, 9)))
        if i % 3 == 0 and len(text) > 200:
            body = text[:200].rstrip()
            if body[-1] != ".":
                cut.add(i)
            text = body + rng.choice(["", "…", " [...]"]) if i in cut else body
        elif i % 7 == 0:
            text = text[:-1]  # lacks its full stop only
        rows.append((i, text, "a" if i % 3 == 0 else "b"))
    got = {i for i, r in judge(spark, rows).items() if r.cut}
    assert len(got & cut) / len(got) > 0.97 and len(got & cut) / len(cut) > 0.97


def test_defined_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "N/A", "a"), (4, "Abstract not available.", "a"), (5, "We show that the model improves the network.", None), (6, "Too short", "a"), (7, "We show that the model raises it by 3.", "a"), (7, "We show that the model raises it by 3.", "a")]
    got = judge(spark, rows)
    assert set(got) == {5, 7} and not got[5].cut and got[7].cut
    assert judge(spark, []) == {}


@pytest.mark.parametrize(("text", "open_"), [("It ends.", False), ("It ends…", True), ("It ends. …", False), ('He said "yes."', False), ("Demo: https://a.example/x", False), ("by 34.", True), ("(see below)", False), ("and so on [...]", True)])
def test_endings(text, open_):
    assert T.ending(text)[2] is open_


def test_censored_fit_recovers_the_parameters():
    rng = np.random.default_rng(0)
    full = np.exp(rng.normal(6.0, 0.5, 20000)).astype(int)
    seen, limit = np.minimum(full, 500), 500
    length, at = np.unique(seen, return_inverse=True)
    whole, open_ = np.bincount(at, full <= limit, len(length)), np.bincount(at, full > limit, len(length))
    mu, sigma = T.fit_censored(length, whole, open_, steps=200)
    assert abs(mu - 6.0) < 0.03 and abs(sigma - 0.5) < 0.03


def test_the_censoring_posterior_decides_where_endings_do_not(spark):
    """Two texts end in the same words, which as often end a text as not; only the length of one is a limit of its source."""
    rng, rows = random.Random(9), []
    for i in range(1200):
        rows.append((i, " ".join(sentence(rng) for _ in range(rng.randrange(3, 9))), "a"))
    for i in range(1200, 1500):  # cut at 180 characters
        text = " ".join(sentence(rng) for _ in range(9))[:180].rstrip()
        rows.append((i, text, "a"))
    even = "We report the sampler as a final note"
    for i in range(1500, 1560):  # the words end a sentence here and go on there
        rows.append((i, f"{even}. {sentence(rng)}" if i % 2 else f"{even} on the decoder. {sentence(rng)}", "b"))
    pad = lambda n: ("The planner meets the kernel. " * 40)[: n - len(even) - 1].rsplit(" ", 1)[0]
    at_limit, elsewhere = f"{pad(182)} {even}", f"{pad(330)} {even}"
    assert abs(len(at_limit) - 180) <= 8
    rows += [(9001, at_limit, "a"), (9002, elsewhere, "a")]
    got = judge(spark, rows)
    assert got[9001].end_probability == pytest.approx(got[9002].end_probability)
    assert got[9001].limit_posterior > 0.9 > 0.5 > got[9002].limit_posterior
    assert got[9001].cut and not got[9002].cut
