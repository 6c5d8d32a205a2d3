"""Filling sequences of fixed token capacity with whole documents, balanced by attention cost.

A document of n tokens costs linear * n + quadratic * n * n. Documents are dealt to shards by a hash
of their id, so that a shard holds about `shard_tokens` tokens whatever the size of the corpus; a
shard is packed on its own, and all shards in parallel. Within a shard the pieces are taken in
descending order and each goes to the open sequence of the lowest cost that still has room. The
number of sequences opened at first is the least that the sizes allow; where a piece fits nowhere
a sequence is added. Several starting numbers are tried and the one that ends with the fewest
sequences is kept (then the most even cost). The unused space a shard adds beyond that of one big
packing is at most part of its last sequences, and falls with shard_tokens.

Only a text longer than the capacity is split: full pieces fill sequences alone, the rest is packed
as any document.

Defined cases: null ids, null texts and texts without tokens get no place; repeated rows of one id
are packed once per distinct text; capacities that are null or below 1 are ignored; ties go by id.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
SHARD_TOKENS = 1_500_000
#: The capacities of one call are a parameter list, not data; more than this is an error.
MOST_LIMITS = 100
PLACED = "limit_id int, capacity_tokens int, container_id string, doc_id bigint, piece int, first_token int, n_tokens int, cost double"


@lru_cache(maxsize=2)
def _tokenizer(model: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(model)
    made.encode_special_tokens = True
    return made


def token_lengths(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text_hash, n_tokens) of the distinct (key, text) rows; a narrow pass, whole texts. The vocabulary is read on the driver and sent along."""
    shipped = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))  # a file of fixed size
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = _tokenizer(shipped.value)
        for b in batches:
            counts = []
            texts = list(b["text"])
            for i in range(0, len(texts), 256):
                counts += [len(x.ids) for x in made.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
            yield pd.DataFrame({"key": b["key"], "text_hash": b["text_hash"], "n_tokens": counts})

    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).where("key is not null and text is not null")
    return rows.mapInPandas(run, f"key {kind}, text_hash bigint, n_tokens int").where("n_tokens > 0").distinct().withColumnRenamed("key", key)


def least_sequences(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound of the sequences needed: by volume, and by sizes that exclude each other."""
    up = np.sort(sizes)
    total = np.concatenate([[0], np.cumsum(up)])
    half = int(np.searchsorted(up, capacity // 2, "right"))  # the pieces before it fit twice
    best = max(-(-int(total[-1]) // capacity), len(up) - half)
    k = np.unique(up[:half])
    if len(k):
        # Beside a piece above capacity - k no piece of k or more fits; what the larger halves leave is lost to the rest.
        lone = np.searchsorted(up, capacity - k, "right")
        small = np.searchsorted(up, k, "left")
        rest = total[half] - total[small] - ((lone - half) * capacity - (total[lone] - total[half]))
        best = max(best, int((len(up) - half + np.maximum(0, -(-rest // capacity))).max()))
    return best


def _assign(sizes: np.ndarray, cost: np.ndarray, capacity: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence of each piece, cost of each sequence): descending pieces to the cheapest sequence with room."""
    room = np.full(start + len(sizes), capacity, np.int64)
    load = np.full(start + len(sizes), np.inf)
    load[:start] = 0.0
    used, place = start, np.zeros(len(sizes), np.int64)
    for i, (size, price) in enumerate(zip(sizes.tolist(), cost.tolist())):
        j = int(np.where(room[:used] >= size, load[:used], np.inf).argmin()) if used else 0
        if not used or room[j] < size:
            j, used = used, used + 1
            load[j] = 0.0
        room[j] -= size
        load[j] += price
        place[i] = j
    return place, load[:used]


def pack(sizes: np.ndarray, capacity: int, linear: float, quadratic: float) -> np.ndarray:
    """The sequence of each piece; sizes in descending order, none above the capacity."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    cost = linear * sizes + quadratic * sizes.astype(float) ** 2
    least = least_sequences(sizes, capacity)
    best = None
    for share in (0.0, 0.004, 0.01, 0.02, 0.04, 0.08):
        start = least + int(share * least)
        place, load = _assign(sizes, cost, capacity, start)
        rank = (len(np.unique(place)), float(load.std()))
        if best is None or rank < best[0]:
            best = (rank, place)
        if rank[0] <= start:
            break
    return best[1]


def packed(
    docs: DataFrame,
    limits: DataFrame,
    vocabulary: str = VOCABULARY,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """PLACED: one row per piece and capacity; `cost` is the piece's share of its sequence's cost."""
    sizes = materialize(token_lengths(docs, vocabulary=vocabulary), "tokens")
    n_shards = max(1, -(-int(sizes.agg(F.sum("n_tokens")).first()[0] or 0) // shard_tokens))
    wanted = limits.select(F.col("limit_id").cast("int"), F.col("capacity_tokens").cast("int")).where("limit_id is not null and capacity_tokens >= 1").distinct()
    tried = [(r.limit_id, r.capacity_tokens) for r in wanted.orderBy("limit_id", "capacity_tokens").limit(MOST_LIMITS + 1).collect()]
    if len(tried) > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} capacities")
    if not tried:
        return docs.sparkSession.createDataFrame([], PLACED)
    capacities = F.array(*[F.struct(F.lit(i).alias("limit_id"), F.lit(c).alias("capacity_tokens")) for i, c in tried])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        limit, capacity, shard = int(group["limit_id"].iloc[0]), int(group["capacity_tokens"].iloc[0]), int(group["shard"].iloc[0])
        ids, n = group["doc_id"].to_numpy(np.int64), group["n_tokens"].to_numpy(np.int64)
        full, rest = n // capacity, n % capacity
        owner = np.repeat(np.arange(len(n)), full)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
        has = rest > 0
        order = np.lexsort((group["text_hash"].to_numpy(np.int64)[has], ids[has], -rest[has]))
        at = np.flatnonzero(has)[order]
        place = pack(rest[at], capacity, linear, quadratic)
        who = np.concatenate([owner, at])
        no = np.concatenate([piece, full[at]])
        size = np.concatenate([np.full(len(owner), capacity), rest[at]])
        seq = np.concatenate([np.arange(len(owner)), len(owner) + place])
        return pd.DataFrame({
            "limit_id": limit, "capacity_tokens": capacity, "container_id": [f"{limit}-{shard}-{s}" for s in seq], "doc_id": ids[who],
            "piece": no, "first_token": no * capacity, "n_tokens": size, "cost": linear * size + quadratic * size.astype(float) ** 2,
        })

    rows = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(n_shards)).cast("int")).select("*", F.inline(capacities))
    return rows.groupBy("limit_id", "capacity_tokens", "shard").applyInPandas(run, PLACED)


def packing_report(placed: DataFrame) -> DataFrame:
    """(limit_id, n_containers, n_pieces, share_used, cost_spread) of an assignment."""
    boxes = placed.groupBy("limit_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("used"), F.sum("cost").alias("cost"), F.count("*").alias("n"))
    return boxes.groupBy("limit_id", "capacity_tokens").agg(
        F.count("*").alias("n_containers"), F.sum("n").alias("n_pieces"),
        (F.sum("used") / (F.count("*") * F.first("capacity_tokens"))).alias("share_used"),
        (F.stddev_pop("cost") / F.avg("cost")).alias("cost_spread"),
    )
