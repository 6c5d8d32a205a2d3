import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusforge.llm import packing as P

DOCS, LIMITS = "doc_id bigint, text string, piece int", "limit_id int, capacity_tokens int, limit_name string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.just(100))
def test_pack_never_overfills_and_wastes_little(sizes, capacity):
    sizes = np.array(sorted(sizes, reverse=True), np.int64)
    place = P.pack(sizes, capacity, 1.0, 0.001)
    used = np.bincount(place, sizes, minlength=1) if len(sizes) else np.zeros(1)
    assert used.max() <= capacity
    n = len(np.unique(place))
    assert n >= P.least_sequences(sizes, capacity) if len(sizes) else n == 0
    first_fit = []
    for s in sizes:
        for i, r in enumerate(first_fit):
            if r >= s:
                first_fit[i] -= s
                break
        else:
            first_fit.append(capacity - s)
    assert n <= max(len(first_fit) + 1, int(1.15 * len(first_fit)))


def test_every_document_once_and_only_long_ones_split(spark):
    docs = [(1, "hello world " * 40), (2, "a"), (3, None), (None, "x"), (4, ""), (5, "hello world " * 700), (2, "a"), (6, "b c d")]
    df = spark.createDataFrame([(i, t, 9) for i, t in docs], DOCS)
    limits = spark.createDataFrame([(1, 64, "s"), (2, 512, "m"), (3, None, "n"), (4, 0, "z")], LIMITS)
    placed = P.packed(df, limits).toPandas()
    lengths = {r.doc_id: r.n_tokens for r in P.token_lengths(df).collect()}
    assert set(lengths) == {1, 2, 5, 6} and set(placed["limit_id"]) == {1, 2}
    for (limit, doc), g in placed.groupby(["limit_id", "doc_id"]):
        capacity = g["capacity_tokens"].iloc[0]
        assert g["n_tokens"].sum() == lengths[doc]
        assert len(g) == 1 or lengths[doc] > capacity
        g = g.sort_values("piece")
        assert list(g["piece"]) == list(range(len(g))) and (g["n_tokens"].iloc[:-1] == capacity).all()
    assert (placed.groupby(["limit_id", "container_id"])["n_tokens"].sum() <= placed.groupby(["limit_id", "container_id"])["capacity_tokens"].first()).all()


def test_shards_hold_all_documents(spark):
    df = spark.createDataFrame([(i, "word " * (i % 50 + 1), 0) for i in range(300)], DOCS)
    limits = spark.createDataFrame([(1, 128, "s")], LIMITS)
    placed = P.packed(df, limits, shard_tokens=1000)
    assert placed.select("doc_id").distinct().count() == 300
    assert P.packing_report(placed).first().share_used > 0.8


def test_empty_tables(spark):
    docs, limits = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 64, "s")], LIMITS)
    assert P.packed(docs, limits).count() == 0
    assert P.packed(docs, spark.createDataFrame([], LIMITS)).count() == 0


def test_bound_looks_at_all_sizes():
    def plain(sizes, capacity):
        best = max(-(-int(sizes.sum()) // capacity), int((2 * sizes > capacity).sum()))
        for k in np.unique(sizes[2 * sizes <= capacity]):
            pair = sizes[(2 * sizes > capacity) & (sizes <= capacity - k)]
            rest = int(sizes[(sizes >= k) & (2 * sizes <= capacity)].sum()) - int(len(pair) * capacity - pair.sum())
            best = max(best, int((sizes > capacity - k).sum()) + len(pair) + max(0, -(-rest // capacity)))
        return best

    rng = np.random.default_rng(0)
    for _ in range(300):
        capacity = int(rng.integers(1, 60))
        sizes = rng.integers(1, capacity + 1, rng.integers(0, 30))
        assert P.least_sequences(sizes, capacity) == plain(sizes, capacity)
    many = rng.permutation(np.concatenate([np.arange(1, 901), np.full(700, 1100)]))  # over 200 different sizes that fit twice
    assert P.least_sequences(many, 2000) == plain(many, 2000)
