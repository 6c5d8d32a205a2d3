"""Held-out evaluation passages inside a training corpus, by spaced-seed hashing.

Words are compared in a folded form (case, accents, width, invisible and look-alike characters,
punctuation and layout do not count). A mask of a spaced seed names the word positions of a window
that must agree; the others are ignored, so a replaced word does not break the seed. The two masks
of weight six in MASKS together hit every passage of 14 words in which any two words were replaced
(tests check all patterns). Seeds of the corpus are joined with the seeds of the items; around
every hit the diagonal (document position minus item position) is verified word by word.

The items are the small side. They are taken in blocks of at most `block_words` words, each block
is broadcast once and streamed over by all documents, so memory is bounded whatever the number of
items, and no seed of the corpus is ever shuffled.

Sentences that stand in many unrelated documents are found from the hits themselves: for every run
that stays within a sentence of its item and comes without the rest of it, the distinct surroundings
(three words before and after the run) are counted over the whole corpus; copies of one document
share their surroundings and count once. A run whose count exceeds `stock_share` of all documents
(and `stock_least`), whose ends are sentence bounds and that is only a part of some item, is stock and
no evidence. A whole item or several of its sentences never are, however often they leaked.

Defined cases: null or empty texts and items hold nothing; repeated rows count once; items shorter
than `least_words` words are held only as a whole; a document may hold many items.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.lookalike import LOOKALIKE, ODD, visual_form
from corpusforge.session import materialize

MASKS = ("111010011", "1111011")
_ACCENT = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+")
_MULT = np.uint64(0x9E3779B97F4A7C15)

#: Common English function words; one in the place of another word is a replacement, not another question.
FUNCTION_WORDS = frozenset(
    "a an the this that these those some such any each every one two many more most much other another its their his her our your my "
    "of in on at by for from with into over under about as to and or but so if then than while when where which who what how "
    "is are was were be been has have had do does did can could may might will would should must not no also only just very quite rather "
    "roughly nearly almost about often here there now again".split()
)

RUN_SCHEMA = "doc_id bigint, item_id bigint, diagonal int, runs array<struct<lo:int,hi:int,context:bigint,said:bigint,bounded:boolean,part:boolean>>, swaps array<struct<at:int,kind:int>>"


def fold_words(text: str) -> list[str]:
    """The words of a text as they are compared."""
    if not text.isascii():
        text = _ACCENT.sub("", unicodedata.normalize("NFKD", visual_form(text)))
        text = ODD.sub(lambda m: LOOKALIKE.get(m[0], m[0]), text)
    return _WORD.findall(text.lower())


def _seeds(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under the mask; 0 where a needed word is unknown (id 0)."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for at, bit in enumerate(mask):
        if bit == "1":
            part = ids[at : at + n]
            known &= part != 0
            value = (value ^ part) * _MULT
            value ^= value >> np.uint64(29)
    value[~known] = 0
    return value


def sentence_bounds(text: str, n_words: int) -> list[int]:
    """The word numbers at which sentences start, and the number of words."""
    bounds = np.cumsum([0, *(len(fold_words(p)) for p in _SENTENCE_END.split(text))]).tolist()
    return sorted(set(bounds)) if bounds[-1] == n_words else [0, n_words]


class Items:
    """The items of one block: words, word numbers, seed table."""

    def __init__(self, rows: list[tuple]):
        read = [(i, t, fold_words(t)) for i, t in rows]
        self.words = [(i, w) for i, _, w in read if w]
        fills: dict[tuple[str, str], set[str]] = {}
        for _, ws in self.words:
            for before, w, after in zip(ws, ws[1:], ws[2:]):
                fills.setdefault((before, after), set()).add(w)
        self.slots = {frame for frame, words in fills.items() if len(words) > 1}  # neighbours between which the items vary
        self.bounds = [sentence_bounds(t, len(w)) for _, t, w in read if w]
        self.number: dict[str, int] = {}
        for _, ws in self.words:
            for w in ws:
                self.number.setdefault(w, len(self.number) + 1)
        seeds, owner, place = [], [], []
        self.ids = [np.array([self.number[w] for w in ws], np.uint64) for _, ws in self.words]
        for k, ids in enumerate(self.ids):
            for m, mask in enumerate(MASKS):
                s = _seeds(ids, mask)
                seeds.append(s + np.uint64(m))
                owner.append(np.full(len(s), k, np.int32))
                place.append(np.arange(len(s), dtype=np.int32))
        self.lengths = np.array([len(x) for x in self.ids], np.int64)
        self.flat = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint64)  # all items one after the other
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.short = [k for k, ids in enumerate(self.ids) if len(ids) < max(map(len, MASKS))]
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int32)

    def diagonals(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of all seed hits of a document given as word numbers."""
        found: set[tuple[int, int]] = set()
        for m, mask in enumerate(MASKS):
            s = _seeds(ids, mask)
            at = np.flatnonzero(s)
            if not len(at) or not len(self.seeds):
                continue
            s = s[at] + np.uint64(m)
            lo = np.searchsorted(self.seeds, s, "left")
            n = np.searchsorted(self.seeds, s, "right") - lo
            hit = np.flatnonzero(n)
            if len(hit):
                n, lo, at = n[hit], lo[hit], at[hit]
                each = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                found.update(zip(self.owner[each].tolist(), (np.repeat(at, n) - self.place[each]).tolist()))
        for k in self.short:  # items too short for a seed: whole, in running order
            own = self.ids[k]
            for p in np.flatnonzero(ids == own[0]):
                if p + len(own) <= len(ids) and (ids[p : p + len(own)] == own).all():
                    found.add((k, int(p)))
        return found


def _swap_kind(a: str, b: str) -> int:
    """How item word a became document word b: 1 like a slip or a filler, 2 another number, 0 another word (3 where the items do not vary there)."""
    if a.isdigit() and b.isdigit():
        return 2
    if b in FUNCTION_WORDS:
        return 1
    n = len(a)
    if n >= 3 and abs(len(b) - n) <= 2:
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(n, len(b)))
        tail = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(n, len(b)))
        if same + tail >= max(n, len(b)) - 2 and same + tail >= 2:
            return 1
    return 0


def _context(words: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(words).encode(), digest_size=8).digest(), "little", signed=True)


def _promising(ids: np.ndarray, items: Items, at_once: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """(item, diagonal) of the hits that agree in enough words: a passage of 14 words with two replaced agrees in 12.

    Each diagonal is compared on its own length, many at a time; `at_once` bounds the words in memory.
    """
    hits = sorted(items.diagonals(ids))
    if not hits:
        return
    ks, ds = (np.array(x, np.int64) for x in zip(*hits))
    lo = np.maximum(0, -ds)
    n = np.minimum(items.lengths[ks], len(ids) - ds) - lo
    part = np.cumsum(n) // at_once
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        step = np.arange(n[own].sum()) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        equal = ids[np.repeat(lo[own] + ds[own], n[own]) + step] == items.flat[np.repeat(items.begin[ks[own]] + lo[own], n[own]) + step]
        count = np.add.reduceat(equal.astype(np.int64), np.cumsum(n[own]) - n[own])
        for i in own[count >= np.minimum(12, items.lengths[ks[own]])]:
            yield int(ks[i]), int(ds[i])


def _verify(words: list[str], ids: np.ndarray, items: Items, least_run: int) -> Iterator[tuple]:
    for k, d in _promising(ids, items):
        own = items.ids[k]
        lo, hi = max(0, -d), min(len(own), len(ids) - d)
        same = np.zeros(len(own) + 2, np.int8)
        same[1 + lo : 1 + hi] = ids[lo + d : hi + d] == own[lo:hi]
        edge = np.diff(same)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        keep = [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a + 1 >= least_run or len(own) < 14]
        if sum(b - a + 1 for a, b in keep) < min(6, len(own)):
            continue
        theirs, bounds = items.words[k][1], items.bounds[k]
        matched, runs = sum(b - a + 1 for a, b in keep), []
        for a, b in keep:
            # Words beyond the run on its diagonal show that more of the item is there.
            alone = matched - (b - a + 1) < 6 and not any(a < x <= b for x in bounds)
            context = _context(words[max(0, a + d - 3) : a + d] + ["|"] + words[b + d + 1 : b + d + 4])
            runs.append((a, b, context, _context(theirs[a : b + 1]) if alone else None, a in bounds and b + 1 in bounds, b - a + 1 < len(own)))
        kind = lambda q: _swap_kind(theirs[q], words[q + d]) or (0 if (theirs[q - 1], theirs[q + 1]) in items.slots else 3)
        swaps = [(q, kind(q)) for q in (b + 1 for (_, b), (a, _) in zip(keep, keep[1:]) if a == b + 2)]
        yield items.words[k][0], d, runs, swaps


def _accept(runs: list[tuple[int, int]], swaps: dict[int, int], stock: set[int], n_words: int, least_words: int) -> bool:
    """True if some stretch of the diagonal is a passage: long enough, lone replacements of at most one word in seven (fewer with slots), no number replaced, none of it stock."""
    whole = min(least_words, n_words)
    clean: list[tuple[int, int]] = []
    for a, b in runs:
        at = a
        for q in range(a, b + 2):
            if q > b or q in stock:
                if q > at:
                    clean.append((at, q - 1))
                at = q + 1
    for i, (a, b) in enumerate(clean):
        number = other = slips = slots = 0
        for j in range(i, len(clean)):
            if j > i:
                q = clean[j - 1][1] + 1
                if clean[j][0] != q + 1 or q not in swaps:
                    break
                slips += swaps[q] == 1
                other += swaps[q] in (0, 3)
                slots += swaps[q] == 0
                number += swaps[q] == 2
            length = clean[j][1] - a + 1
            if length >= whole and not number and (length >= (9.2 if slots else 7) * (other + slips) or (other <= 1 and slips == 0)):
                return True
    return False


def _pieces(batches: Iterator[pd.DataFrame], most: int, overlap: int) -> Iterator[pd.DataFrame]:
    """Items in parts of at most `most` words that overlap: the words from `first` on, and how many the whole item has."""
    for b in batches:
        rows = []
        for item, text in zip(b["item_id"], b["text"]):
            n = len(fold_words(text))
            if n <= most:
                rows.append((item, 0, 0, text, n, n))
                continue
            words = fold_words(text)
            for i, first in enumerate(range(0, n - overlap, most - overlap)):
                own = words[first : first + most]
                rows.append((item, i, first, " ".join(own), len(own), n))
        yield pd.DataFrame(rows, columns=["item_id", "piece", "first", "text", "n_words", "whole_words"])


def _placed(found: Iterator[tuple]) -> Iterator[tuple]:
    """Finds of parts as finds of their items: places count from the item's start."""
    for (item, first), diagonal, runs, swaps in found:
        yield item, diagonal - first, [(a + first, b + first, *rest) for a, b, *rest in runs], [(q + first, kind) for q, kind in swaps]


def leaked_pairs(
    docs: DataFrame,
    items: DataFrame,
    least_words: int = 14,
    least_run: int = 2,
    stock_share: float = 0.004,
    stock_least: int = 4,
    block_words: int = 200_000,
) -> DataFrame:
    """(doc_id, item_id): the document holds the item or a passage of it of at least least_words words."""
    spark = docs.sparkSession
    source = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    wanted = items.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    # Blocks of about `block_words` words by hash; an item longer than a block is taken in overlapping parts, so no block outgrows a worker.
    overlap = 4 * least_words
    pieces = materialize(wanted.mapInPandas(lambda batches: _pieces(batches, max(block_words, 4 * overlap), overlap), "item_id bigint, piece int, first int, text string, n_words int, whole_words int"), "pieces")
    n_blocks = max(1, -(-int(pieces.agg(F.sum("n_words")).first()[0] or 0) // block_words))
    parts = []
    for block in range(n_blocks):
        rows = pieces.where(F.pmod(F.xxhash64("item_id", "piece"), F.lit(n_blocks)) == block)
        table = spark.sparkContext.broadcast(Items([((r.item_id, r["first"]), r.text) for r in rows.toLocalIterator()]))

        def scan(batches: Iterator[pd.DataFrame], table=table) -> Iterator[pd.DataFrame]:
            known = table.value
            for batch in batches:
                out = []
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    words = fold_words(text)
                    ids = np.fromiter((known.number.get(w, 0) for w in words), np.uint64, len(words))
                    out += [(doc, *x) for x in _placed(_verify(words, ids, known, least_run))]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "diagonal", "runs", "swaps"])

        parts.append(source.mapInPandas(scan, RUN_SCHEMA))
    runs = parts[0]
    for part in parts[1:]:
        runs = runs.unionByName(part)
    runs = materialize(runs, "runs")
    n_docs = source.select("doc_id").distinct().count()
    most = max(stock_least, stock_share * n_docs)
    seen = runs.select("item_id", F.explode("runs").alias("r")).where("r.hi - r.lo >= 5 and r.said is not null").select("item_id", "r.*")
    common = (
        seen.groupBy("said").agg(F.count_distinct("context").alias("n"), F.max("bounded").alias("bounded"), F.max("part").alias("part"))
        .where((F.col("n") > most) & F.col("bounded") & F.col("part")).select("said")
    )
    stock = seen.join(common, "said", "left_semi").select("item_id", F.explode(F.sequence("lo", "hi")).alias("at")).groupBy("item_id").agg(F.collect_set("at").alias("stock"))
    lengths = pieces.groupBy("item_id").agg(F.max("whole_words").alias("n_words"))
    per_item = lengths.join(stock, "item_id", "left")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [
                _accept([(r["lo"], r["hi"]) for r in rs], {s["at"]: s["kind"] for s in sw}, set(st) if st is not None else set(), n, least_words)
                for rs, sw, st, n in zip(b["runs"], b["swaps"], b["stock"], b["n_words"])
            ]
            yield b.loc[np.array(ok, bool), ["doc_id", "item_id"]]

    return runs.join(per_item, "item_id").mapInPandas(judge, "doc_id bigint, item_id bigint").distinct()


def leaked_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(item_id, n_docs): the items that leaked and in how many documents."""
    return leaked_pairs(docs, items, **options).groupBy("item_id").agg(F.count("*").alias("n_docs"))
