"""Text values cut off by field limits or in transfer.

Three parts. (1) Per source a right-censored log-normal length distribution is fitted by maximum
likelihood, texts that end properly being observed and open ends censored at their length; the
lengths at which open ends exceed what the fit leaves there are candidate limits, and every length
gets the posterior that an open end there was censored. (2) Ending evidence: over all sentences of
all distinct texts, contexts (the last one to five words; the sentence's first two words with its
last one or two) are counted as going on or ending; an open end's last words are looked up, longer
contexts over shorter ones. A last word or pair of words
that no other text has counts as cut, unless the whole closing line is one that many texts end with. (3) Both log odds
are added; a text whose end is open and whose odds favour a cut is reported.

Counting needs only contexts that some open end has: their hashes are folded into a bit table of
fixed size (BUCKETS bits), which is all that is broadcast, and batches are summed before the
shuffle. Texts are deduplicated first, so late copies do not count twice.

Defined cases: null, empty and placeholder texts, and texts of under `least_words` words, are no
cases; a null source is a source of its own; a text that ends with a full stop, question or
exclamation mark, closing quote or bracket ends properly unless that dot belongs to a number.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import materialize

BUCKETS = 1 << 22
#: Posterior of censoring at lengths where open ends do not pile up.
NO_LIMIT = 0.4
#: Kinds of context, from the shortest to the longest.
LEVELS = 8

#: Texts that stand for a missing one (compared in lower case, outer punctuation removed).
PLACEHOLDERS = frozenset(["n/a", "na", "none", "null", "nan", "tbd", "tba", "abstract not available", "no abstract", "no abstract available", "not available", "abstract unavailable", "unknown", "missing", ""])

_MARK = re.compile(r"(?:\s*(?:\[\s*(?:\.\.\.|…)\s*\]|\(\s*(?:\.\.\.|…)\s*\)|\.{3,}|…))+\s*$")
_CLOSED = re.compile(r"[.!?。！？][\"'”’»)\]]*$|[)\]\"”’»]$")
_URL = re.compile(r"https?://[\w.-]+\.\w+/\S+$")
_DANGLING = re.compile(r"[,;:(\[{\-–—&/]$")
_NUMBER_DOT = re.compile(r"(?:^|\s)[^\w\s]*\d+[.,]$")
_STRIP = "()[]{}.,;:!?\"'“”‘’«»"
_U = np.uint64


def _mix(*parts: np.ndarray) -> np.ndarray:
    value = np.full(len(parts[0]), 0x51ED270B7A9F1D35, _U)
    for p in parts:
        value = (value ^ p) * _U(0x9E3779B97F4A7C15)
        value ^= value >> _U(31)
    return value


def ending(text: str) -> tuple[str, bool, bool]:
    """(text without a cut mark and outer blanks, had a mark, is open)."""
    body = text.strip()
    bare = _MARK.sub("", body).rstrip()
    marked = bare != body
    closed = bool(_CLOSED.search(bare) or _URL.search(bare)) and not _NUMBER_DOT.search(bare)
    return bare, marked, not closed


def is_placeholder(text: str, least_words: int) -> bool:
    return text.strip().strip(_STRIP + " -").lower() in PLACEHOLDERS or len(text.split()) < least_words


def _contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(LEVELS x n context hashes, state, text number, place in its sentence) of all words: state 0 goes on, 1 ends a sentence, 2 last word of an open text."""
    words = [t.split() for t in texts]
    lens = np.array([len(w) for w in words], np.int64)
    flat = np.array(list(itertools.chain.from_iterable(words)), object)
    if not len(flat):
        return np.zeros((LEVELS, 0), _U), np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, names = pd.factorize(flat)
    names = [str(x) for x in names]
    norm, stop, upper = [], [], []
    for x in names:
        bare = x.strip(_STRIP)
        norm.append("<url>" if "://" in x else "<num>" if bare and bare.replace(".", "").replace(",", "").isdigit() else bare.lower())
        stop.append(bool(_CLOSED.search(x)) and x[-1] not in ")]" and bool(re.search(r"[.!?]", x[-3:])))
        lead = x.lstrip(_STRIP)[:1]
        upper.append(not lead.islower())
    h = pd.util.hash_array(np.array(norm, object))[codes].astype(_U)
    stop_at, upper_at = np.array(stop)[codes], np.array(upper)[codes]
    owner = np.repeat(np.arange(len(words)), lens)
    last = np.zeros(len(flat), bool)
    last[np.cumsum(lens)[lens > 0] - 1] = True
    number_at = np.array([x == "<num>" for x in norm])[codes]
    ends = stop_at & (np.append(upper_at[1:], True) | last) & ~(number_at & last)  # a number's dot at the very end proves nothing
    start = np.append(True, ends[:-1] | last[:-1])
    begin = np.maximum.accumulate(np.where(start, np.arange(len(flat)), 0))
    at = np.arange(len(flat)) - begin

    def back(k: int) -> np.ndarray:
        out = np.zeros(len(flat), _U)
        out[k:] = h[: len(flat) - k]
        out[at < k] = 0
        return out

    second = np.minimum(begin + 1, len(flat) - 1)
    first2 = _mix(h[begin], np.where(at >= 1, h[second], _U(0)))
    h1, h2, h3, h4 = (back(k) for k in (1, 2, 3, 4))
    kind = [np.full(len(flat), k, _U) for k in range(LEVELS)]
    table = np.stack([_mix(kind[0], h), _mix(kind[1], h1, h), _mix(kind[2], first2, h), _mix(kind[3], h2, h1, h), _mix(kind[4], first2, h1, h), _mix(kind[5], h3, h2, h1, h), _mix(kind[6], h4, h3, h2, h1, h), _mix(kind[7], first2, at.astype(_U))])
    state = np.where(ends, 1, np.where(last, 2, 0)).astype(np.int8)
    return table, state, owner, at


def _bucket(context: np.ndarray) -> np.ndarray:
    return (context >> _U(20)) % _U(BUCKETS)


def _read(df: DataFrame, key: str, text: str, source: str, least_words: int) -> DataFrame:
    """Distinct texts of each source with their endings; ids stay in a narrow table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = [not is_placeholder(t, least_words) for t in b["text"]]
            b = b[np.array(keep, bool)]
            ends = [ending(t) for t in b["text"]]
            open_ = np.array([o for *_, o in ends], bool)
            bare = [x for x, *_ in ends]
            final = np.zeros((len(b), LEVELS + 1), np.int64)
            place = np.zeros(len(b), np.int64)
            if open_.any():
                which = np.flatnonzero(open_)
                table, _, owner, at = _contexts([bare[i] for i in which])
                last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
                place[which] = at[last]
                final[which, :LEVELS] = table[:, last].T.view(np.int64)
                final[which, LEVELS] = table[4, np.maximum(last - 1, 0)].view(np.int64)  # the same kind of context one word earlier
            yield pd.DataFrame({
                "key": b["key"], "source": b["source"], "bare": pd.Series(bare, index=b.index, dtype=object), "length": [len(t.strip()) for t in b["text"]], "marked": [m for _, m, _ in ends],
                "is_open": open_, "dangling": [bool(_DANGLING.search(x)) for x in bare], "place": place, "contexts": pd.Series([list(x) if o else None for x, o in zip(final, open_)], index=b.index, dtype=object),
            })

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text")).where("key is not null and text is not null")
    return rows.mapInPandas(run, f"key {kind}, source string, bare string, length int, marked boolean, is_open boolean, dangling boolean, place int, contexts array<bigint>")


def fit_censored(length: np.ndarray, n_whole: np.ndarray, n_open: np.ndarray, steps: int = 40) -> tuple[float, float]:
    """(mu, sigma) of the log-normal that maximises the right-censored likelihood, by expectation-maximisation."""
    y = np.log(length + 1.0)
    w, c = n_whole.astype(float), n_open.astype(float)
    total = (w + c).sum()
    mu = float((y * (w + c)).sum() / total)
    sigma = max(0.05, math.sqrt(float(((y - mu) ** 2 * (w + c)).sum() / total)))
    erfc = np.vectorize(math.erfc, otypes=[float])
    for _ in range(steps):
        z = (y - mu) / sigma
        tail = np.maximum(0.5 * erfc(z / math.sqrt(2)), 1e-12)
        hazard = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) / tail
        e1 = mu + sigma * hazard
        e2 = mu * mu + sigma * sigma + sigma * (y + mu) * hazard
        m1 = float((w * y + c * e1).sum() / total)
        m2 = float((w * y * y + c * e2).sum() / total)
        mu, sigma = m1, max(0.05, math.sqrt(max(m2 - m1 * m1, 1e-4)))
    return mu, sigma


def _limits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Posterior of censoring at each length of one source, for open ends."""
    pdf = pdf.sort_values("length")
    x, w, c = (pdf[k].to_numpy() for k in ("length", "n_whole", "n_open"))
    mu, sigma = fit_censored(x, w, c)
    y = np.log(x + 1.0)
    density = np.exp(-0.5 * ((y - mu) / sigma) ** 2) / (sigma * math.sqrt(2 * math.pi) * (x + 1.0))
    n_open = c.sum()
    # A limit leaves open ends within some characters below it (a cut at a word, a mark); compare a window with the smooth share.
    grid = np.zeros(int(x.max()) + 40)
    np.add.at(grid, x, c)
    sums = np.concatenate([[0], np.cumsum(grid)])
    near = sums[np.minimum(x + 9, len(grid))] - sums[np.maximum(x - 8, 0)]
    expected = n_open * np.maximum(density * 17, 1e-9) + 1.0
    # Where no limit shows, lengths say next to nothing about an open end.
    posterior = np.clip((near - expected) / np.maximum(near, 1), NO_LIMIT, 0.98)
    return pd.DataFrame({"source": pdf["source"], "length": x, "limit_posterior": posterior, "mu": mu, "sigma": sigma})


def truncated(df: DataFrame, key: str = "cand_id", text: str = "abstract", source: str = "source", least_words: int = 5) -> DataFrame:
    """(key, source, length, marked, end_probability, limit_posterior, cut): every judged text; `cut` says that it breaks off."""
    spark = df.sparkSession
    rows = materialize(_read(df, key, text, source, least_words), "endings")
    open_rows = rows.where("is_open").select("key", "source", "length", "marked", "dangling", "place", "contexts").distinct()
    # The bits are set where the rows lie and come to the driver as words of 64: BUCKETS / 64 rows at most, whatever the input.
    bucket = F.expr(f"shiftrightunsigned(c, 20) % {BUCKETS}")
    words = open_rows.select(F.explode("contexts").alias("c")).select(bucket.alias("b")).groupBy(F.expr("b div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("bits")).toPandas()
    wanted = np.zeros(BUCKETS // 64, np.int64)
    wanted[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    table = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(table.value.view(np.uint8), bitorder="little").view(bool)
        for b in batches:
            ctx, state, *_ = _contexts(list(b["bare"]))
            keep = bits[_bucket(ctx)]
            flat, st = ctx[keep], np.broadcast_to(state, ctx.shape)[keep]
            names, at = np.unique(flat, return_inverse=True)
            yield pd.DataFrame({"c": names.view(np.int64), "n_on": np.bincount(at, st == 0, len(names)), "n_end": np.bincount(at, st == 1, len(names)), "n_last": np.bincount(at, st == 2, len(names))})

    counts = rows.select("bare").distinct().mapInPandas(count, "c bigint, n_on double, n_end double, n_last double").groupBy("c").agg(*[F.sum(k).alias(k) for k in ("n_on", "n_end", "n_last")])
    final = open_rows.select("key", "source", "length", "marked", "dangling", "place", F.posexplode("contexts").alias("level", "c"))
    found = final.join(counts, "c", "left").groupBy("key", "source", "length", "marked", "dangling", "place").agg(F.array_sort(F.collect_list(F.struct("level", "n_on", "n_end", "n_last"))).alias("levels"))
    hist = rows.groupBy("source", "length").agg(F.count_if(~F.col("is_open")).alias("n_whole"), F.count_if("is_open").alias("n_open"))
    limits = hist.groupBy("source").applyInPandas(_limits, "source string, length int, limit_posterior double, mu double, sigma double").select(F.col("source").alias("s"), F.col("length").alias("l"), "limit_posterior")
    # P(end), longer contexts smoothed by shorter ones; an open last word counts half as an end where other texts know the word.
    known = F.expr("levels[0].n_on + levels[0].n_end > 0") & ~F.col("dangling")
    pair = F.expr("levels[1].n_on + levels[1].n_end > 0")  # a pair of words that no other text has is likely half a word
    p = F.expr("aggregate(slice(levels, 1, 7), 0.3D, (p, x) -> (coalesce(x.n_end, 0D) + 0.5D * greatest(coalesce(x.n_last, 0D) - 1D, 0D) + 1.5D * p) / (coalesce(x.n_on, 0D) + coalesce(x.n_end, 0D) + 0.5D * greatest(coalesce(x.n_last, 0D) - 1D, 0D) + 1.5D))")
    # A closing line that stands so at the end of many texts ("17 pages, 6 figures"): its last word always follows there, or nothing ever does.
    stock = F.expr("place >= 2 and not marked and not dangling and levels[1].n_on <= 2D * (levels[1].n_last + levels[1].n_end) and (levels[4].n_last >= 5 and levels[4].n_last >= 0.5D * levels[8].n_on or levels[7].n_last >= 5 and levels[7].n_on + levels[7].n_end <= 0.02D * levels[7].n_last)")
    judged = (
        found.withColumn("end_probability", F.when(F.coalesce(stock, F.lit(False)), 0.985).when(~F.coalesce(known, F.lit(False)), 0.03).when(F.coalesce(pair, F.lit(False)), p).otherwise(F.least(p, F.lit(0.15))))
        .join(limits, F.col("source").eqNullSafe(F.col("s")) & (F.col("length") == F.col("l")), "left").drop("s", "l", "levels")
    )
    logit = lambda c: F.log(c / (1 - c))
    clip = lambda c: F.greatest(F.lit(0.005), F.least(F.lit(0.995), c))
    odds = -logit(clip(F.col("end_probability"))) + logit(clip(F.col("limit_posterior"))) + F.when(F.col("marked"), 2.0).otherwise(0.0)
    opened = judged.withColumn("cut", odds > 0)
    whole = rows.where(~F.col("is_open")).select("key", "source", "length", "marked", F.lit(1.0).alias("end_probability"), F.lit(None).cast("double").alias("limit_posterior"), F.lit(False).alias("cut")).distinct()
    return opened.select(whole.columns).unionByName(whole).withColumnRenamed("key", key)


def cut_share(df: DataFrame, key: str = "cand_id", text: str = "abstract", source: str = "source") -> DataFrame:
    """(source, n_texts, n_cut, share_cut) over the judged texts."""
    return truncated(df, key, text, source).groupBy("source").agg(
        F.count("*").alias("n_texts"), F.count_if("cut").alias("n_cut"), F.avg(F.col("cut").cast("double")).alias("share_cut")
    )
