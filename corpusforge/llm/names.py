"""Spellings that name the same person or group.

Every distinct entry is folded (case, accents, blanks, titles, affiliations, marks) and read as
surname, given name and initials; entries whose order is open ("Rafael Griarskit" or the reverse)
are decided by how their words are used in entries whose order is certain. Each distinct reading
becomes a vector of character n-grams weighted by term and inverse document frequency: the outer
product of the n-grams of its surname with those of its given part, which is its first letter with
mass 1 and, where a given name is known, the name's n-grams with mass GIVEN. The cosine of two outer
products is the product of the cosines of their parts, so it is computed from these. It falls with
every letter that differs: another given name of the same letter leaves at most 1 / (1 + GIVEN) and what n-grams
they share, a given name against a mere initial 1 / sqrt(1 + GIVEN), a slip the share of n-grams it leaves.

A sparse cosine join finds the pairs above the threshold: posting lists are kept for surname n-grams
with one gap, taken with a first letter, so any two surnames within one edit meet. A list of more
than `hot` readings is split: two given names must share one of their n-grams to pass the threshold
(which lies above 1 / (1 + GIVEN)), readings without a given name meet all others in salted parts. No
neighbour is dropped: the top-n is all partners above the threshold. An exact check follows: initials after the
first must not exclude each other, and surnames a slip apart need the evidence of their use.
Links form components, and each is cut by average linkage on the square roots of the cosines.

Defined cases: null, empty and blank entries, marks of omission ("et al.", "others") and entries
without letters are no names and never in a result; a repeated entry counts once; entries of one
word are compared in their folded form only.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.graph import connected_components
from corpusforge.session import discard, materialize

GIVEN = 10.0  # mass of a given name against that of its first letter
THRESHOLD = 0.15  # of the cosine join; above 1 / (1 + GIVEN), what another given name of the same letter leaves
CUT = 0.3  # of average linkage over square roots of cosines; above half of what a given name and its initial have
RARE_SURNAME, RARE_GIVEN = 0.02, 0.003  # shares of all readings added to that of an n-gram before it is weighted
SEEN = 0.0003  # n-grams of a smaller share of the readings weigh as unseen ones
SALTS = 8  # parts of a posting list that many readings share

# Fixed values. Letters without a decomposition.
PLAIN = str.maketrans({"ł": "l", "đ": "d", "ð": "d", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th", "ħ": "h"})
PARTICLES = frozenset("van von der den de del della di da dos du la le al el bin ibn ter ten zu zur".split())
TITLES = frozenset("dr prof professor mr mrs ms phd md sir".split())
SUFFIXES = frozenset(["Jr", "Sr", "II", "III", "IV"])
NO_NAMES = frozenset("others other etal et al and anonymous unknown none null na n/a various authors author".split())
GROUP_WORDS = frozenset("team consortium collaboration group lab laboratory initiative project committee network working society alliance".split())
#: Topics of groups, by which one is known when its kind is cut to a letter ("Vision C.").
GROUP_TOPICS = frozenset("vision language safety climate speech robotics health data systems science research learning".split())


def _pet_forms(text: str) -> dict[str, tuple[str, ...]]:
    forms: dict[str, tuple[str, ...]] = {}
    for pair in text.split():
        form, name = pair.split(":")
        forms[form] = (*forms.get(form, ()), name)
    return forms


#: Short and pet forms of given names (in general use), as form:name.
PET_FORMS = _pet_forms(
    (
        "abby:abigail alex:alexander sasha:alexander lex:alexander nastya:anastasia stacy:anastasia andy:andrew drew:andrew ben:benjamin benny:benjamin "
        "chris:christopher kit:christopher dan:daniel danny:daniel dima:dmitri mitya:dmitri ed:edward eddie:edward ned:edward ted:edward ted:theodore "
        "katya:ekaterina katja:ekaterina yekaterina:ekaterina kate:ekaterina liz:elizabeth beth:elizabeth betty:elizabeth lisa:elizabeth eliza:elizabeth "
        "paco:francisco pancho:francisco fred:frederick freddie:frederick fritz:frederick rick:frederick gabe:gabriel beppe:giuseppe peppe:giuseppe jen:jennifer jenny:jennifer "
        "hanna:johanna hannah:johanna joey:joseph joe:joseph pepe:jose kat:katarina kat:ekaterina kasia:katarina katja:katarina katya:katarina kate:katarina larry:lawrence lars:lawrence ludo:ludovic "
        "gosia:malgorzata maggie:margaret meg:margaret peggy:margaret greta:margaret matt:matthew mike:michael mick:michael misha:mikhail "
        "nate:nathaniel nat:nathaniel pat:patricia trish:patricia tricia:patricia patty:patricia rafa:rafael becky:rebecca bec:rebecca "
        "dick:richard rick:richard rich:richard ricky:richard bob:robert rob:robert bobby:robert robbie:robert sam:samantha steph:stephanie steffi:stephanie "
        "theo:theodore teddy:theodore tom:thomas tommy:thomas vicky:victoria tori:victoria vova:vladimir volodya:vladimir bill:william will:william "
        "dave:david steve:steven steve:stephen tim:timothy jeff:jeffrey geoff:geoffrey greg:gregory ken:kenneth pete:peter phil:philip ron:ronald don:donald doug:douglas "
        "sue:susan deb:deborah debbie:deborah barb:barbara cathy:catherine kathy:katherine kate:katherine kate:catherine mandy:amanda val:valerie terry:terence marge:margaret "
        "billy:william liam:william zach:zachary zack:zachary zuzka:zuzana jim:james jimmy:james jack:john johnny:john tony:anthony nick:nicholas"
    )
)

_PAREN = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_WORD = re.compile(r"[^\W\d_]+(?:['’`][^\W\d_]+)*")
_HYPHENS = str.maketrans({c: "-" for c in "‐‑‒–—−"})
READING = "name string, kind string, certain boolean, surname string, given string, initials string, surname2 string, given2 string, initials2 string"


@lru_cache(maxsize=200_000)
def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return text.lower().translate(PLAIN)


def _is_initials(raw: str, dotted: bool) -> bool:
    letters = raw.replace("-", "")
    return len(letters) == 1 or (len(letters) <= 3 and (dotted or letters.isupper()))


def _given(parts: list[tuple[str, bool]]) -> tuple[str, str]:
    """(given name in one word or '', initials) of given parts (raw word, is initials)."""
    words, initials = [], ""
    for raw, short in parts:
        pieces = [p for p in fold(raw).split("-") if p]
        if short:
            initials += "".join(pieces)
        else:
            words += pieces
            initials += "".join(p[0] for p in pieces)
    joined = "".join(words)
    return joined, initials


@lru_cache(maxsize=100_000)
def full_names(given: str) -> frozenset[str]:
    """The given names that a given name may stand for, itself included."""
    return frozenset((given, *PET_FORMS.get(given, ())))


def first_letters(given: str, initials: str) -> set[str]:
    return {n[0] for n in full_names(given)} if given else {initials[:1]}


@lru_cache(maxsize=100_000)
def own_part(surname: str) -> str:
    """The surname without a particle written into it."""
    for particle in ("vonder", "vander", "van", "von", "der", "de", "al"):
        if surname.startswith(particle) and len(surname) - len(particle) >= 5:
            return surname[len(particle) :]
    return surname


def _surname(words: list[str]) -> str:
    pieces = [p for w in words for p in fold(w).split("-") if p]
    return "".join([p for p in pieces if p not in PARTICLES] or pieces)


# Most entries are plain: capitalised words and initials parted by single blanks, or these behind a surname and a comma.
_PLAIN_PART = r"(?:[A-Z][a-z]{2,}|[A-Z]\.|[A-Z]{1,2})"
_PLAIN_NAME = re.compile(rf"(?:([A-Z][a-z]{{2,}}), )?({_PLAIN_PART}(?: {_PLAIN_PART})*)").fullmatch
_NOT_PLAIN = PARTICLES | TITLES | NO_NAMES | GROUP_WORDS | GROUP_TOPICS


def _base_letters() -> dict[int, str]:
    """Accented Latin letters and their base letters, from the Unicode data."""
    pairs = [(c, unicodedata.normalize("NFD", chr(c))[0]) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    return {c: b for c, b in pairs if chr(c) != b} | {ord(a): b for a, b in zip("łŁđĐøØı", "lLdDoOi")}


BASE_LETTERS = _base_letters()


def _read_plain(entry: str) -> tuple | None:
    """What read_name gives for a plain entry, in fewer steps; None where the entry is not plain."""
    text = entry.strip(" *.;")
    match = _PLAIN_NAME(text if text.isascii() else text.translate(BASE_LETTERS))
    if match is None:
        return None
    surname, parts = match[1], match[2].split(" ")
    words = [i for i, p in enumerate(parts) if p[-1].islower()]
    short = [p[-1] == "." or p.isupper() for p in parts]
    parts = [p.lower() for p in parts]
    letters = "".join(parts).replace(".", "")
    if letters in NO_NAMES or not _NOT_PLAIN.isdisjoint([parts[i] for i in words]):
        return None

    def given(start: int, stop: int) -> tuple[str, str]:
        own = range(start, stop)
        return "".join([parts[i] for i in own if not short[i]]), "".join([parts[i].strip(".") if short[i] else parts[i][0] for i in own])

    if surname is not None:
        surname = surname.lower()
        return None if surname in _NOT_PLAIN or surname + letters in NO_NAMES else ("person", True, "", "", "", surname, *given(0, len(parts)))
    if len(parts) < 2 or not words:
        return None
    first, last = words[0], words[-1]
    if len(words) == 1:
        return "person", True, "", "", "", parts[first], *(given(0, first) if first else given(1, len(parts)))
    if last - first + 1 > len(words):  # initials in between
        return "person", True, "", "", "", parts[last], *given(0, last)
    return "person", False, parts[first], *given(first + 1, len(parts)), parts[last], *given(0, last)


def read_name(entry: str) -> tuple | None:
    """READING without the name itself, or None for entries that are no names."""
    return _read_plain(entry) or _read_any(entry)


def _read_any(entry: str) -> tuple | None:
    text = entry
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_HYPHENS)
        text = "".join(" " if unicodedata.category(c)[0] == "Z" else c for c in text if unicodedata.category(c) != "Cf")
    if "(" in text or "[" in text:
        text = _PAREN.sub(" ", text)
    text = text.strip(" *†‡§.·;")
    folded = fold(text)
    letters = re.sub(r"[^a-z]", "", folded)
    if not any(c.isalpha() for c in text) or letters in NO_NAMES or folded.strip(" .") in NO_NAMES or "@" in text or re.search(r"\d", text):
        return None
    plain = re.findall(r"[^\W\d_]+", folded)
    if any(w in GROUP_WORDS for w in plain):
        topic = [w for w in plain if w not in GROUP_WORDS and w not in ("the", "of", "for", "on", "and")]
        if not topic:
            return None
        own = topic[0]  # a topic after it may be shortened to three letters
        return "group", True, "", "", "", own, ",".join(sorted(w[:3] for w in topic if w != own)), "".join(sorted(w[0] for w in plain if w in GROUP_WORDS))
    if len(plain) == 3 and plain[1] in GROUP_TOPICS and len(plain[2]) <= 2:
        return "group", True, "", "", "", plain[0], plain[1][:3], "".join(sorted(plain[2]))
    comma = text.split(",", 1)
    shout = text.isupper()
    # Two capitals in an entry that is not written in capitals are initials, whatever word they resemble.
    no_word = lambda w: not shout and len(w.strip(".")) <= 3 and w.strip(".").isupper()
    is_particle = lambda w: fold(w) in PARTICLES and not no_word(w)
    is_extra = lambda w: (fold(w.replace(".", "")) in TITLES or w.strip(".") in SUFFIXES) and not no_word(w)
    cut = lambda s: [(m.group(), s[m.end() : m.end() + 1] == ".") for m in re.finditer(r"[^\W\d_]+(?:[-'’`.]-?[^\W\d_]+)*", s)]
    if len(comma) == 2 and comma[1].strip():
        left = [w for w, _ in cut(comma[0])]
        right = [(w.replace(".", ""), _is_initials(w.replace(".", ""), d or "." in w)) for w, d in cut(comma[1]) if not is_extra(w)]
        if left and right:
            return "person", True, "", "", "", _surname(left), *_given(right)
    parts = [(w, d) for w, d in cut(text) if not is_extra(w)]
    marks = [(w.replace(".", ""), _is_initials(w.replace(".", ""), d or "." in w)) for w, d in parts]
    if len(marks) < 2:
        return "word", True, "", "", "", folded.replace(" ", ""), "", ""
    # In an entry written in capitals throughout, only single letters and dotted ones are initials for sure.
    if shout:
        marks = [(w, len(w) == 1 or (s and (d or "." in p) or (s and not re.search("[aeiouy]", fold(w))))) for (w, s), (p, d) in zip(marks, parts)]
    words = [i for i, (w, s) in enumerate(marks) if not s and not is_particle(w)]
    if not words:
        return "word", True, "", "", "", folded.replace(" ", ""), "", ""

    def natural() -> tuple[str, str, str]:
        return _surname([marks[words[-1]][0]]), *_given([m for i, m in enumerate(marks) if i < words[-1] and not is_particle(m[0])])

    def reversed_() -> tuple[str, str, str]:
        return _surname([marks[words[0]][0]]), *_given([m for i, m in enumerate(marks) if i > words[0] and not is_particle(m[0])])

    if len(words) == 1:  # all others are initials
        return "person", True, "", "", "", *(natural() if any(s for _, s in marks[: words[0]]) else reversed_())
    bound = [i for i in words if fold(marks[i][0]).split("-")[0] in PARTICLES and "-" in marks[i][0]]
    if len(bound) == 1 and bound[0] in (words[0], words[-1]):  # a particle joined by a hyphen belongs to a surname
        return "person", True, "", "", "", *(natural() if bound[0] == words[-1] else reversed_())
    upper = [i for i in words if marks[i][0].isupper()]
    if not shout and len(upper) == 1 and upper[0] in (words[0], words[-1]):
        return "person", True, "", "", "", *(natural() if upper[0] == words[-1] else reversed_())
    between = [i for i in range(words[0] + 1, words[-1]) if marks[i][1]]
    if between or parts[0][0] != text.split()[0].strip(".,") or any(is_particle(m[0]) for m in marks[words[0] + 1 :]):
        return "person", True, "", "", "", *natural()
    return "person", False, *reversed_(), *natural()


def _readings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for name in b["name"]:
            r = read_name(name)
            if r is not None and r[5]:
                kind, certain, s2, g2, i2, s1, g1, i1 = r
                rows.append((name, kind, certain, s1, g1, i1, s2, g2, i2))
        yield pd.DataFrame(rows, columns=["name", "kind", "certain", "surname", "given", "initials", "surname2", "given2", "initials2"])


def entries(*sources: tuple[DataFrame, str]) -> DataFrame:
    """(name): the distinct entries of array columns."""
    parts = [df.select(F.explode(F.col(column)).alias("name")) for df, column in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("name is not null").distinct()


def resolved_readings(names: DataFrame) -> DataFrame:
    """(name, kind, surname, given, initials): one reading per entry."""
    read = materialize(names.mapInPandas(_readings, READING), "readings")
    sure = read.where("certain and kind = 'person'").select("surname", "given").distinct()
    use = (
        sure.select(F.col("surname").alias("word"), F.lit(0).alias("g"), F.lit(1).alias("s"))
        .unionByName(sure.where("given <> ''").select(F.col("given").alias("word"), F.lit(1).alias("g"), F.lit(0).alias("s")))
        .groupBy("word").agg(F.sum("g").alias("g"), F.sum("s").alias("s"))
    )
    lean = use.select("word", (F.log(F.col("g") + 0.5) - F.log(F.col("s") + 0.5)).alias("lean"))  # above 0: used as a given name
    open_ = read.where("not certain")
    first = lean.select(F.col("word").alias("surname2"), F.col("lean").alias("lean_first"))
    last = lean.select(F.col("word").alias("surname"), F.col("lean").alias("lean_last"))
    judged = open_.join(first, "surname2", "left").join(last, "surname", "left")
    turn = F.coalesce("lean_last", F.lit(0.0)) - F.coalesce("lean_first", F.lit(0.0)) > 1.0  # the usual order needs no proof
    pick = lambda x: F.when(turn, F.col(f"{x}2")).otherwise(F.col(x)).alias(x)
    fixed = judged.select("name", "kind", pick("surname"), pick("given"), pick("initials"))
    return read.where("certain").select("name", "kind", "surname", "given", "initials").unionByName(fixed)


def one_edit(a: str, b: str) -> bool:
    """At most one letter replaced, left out, added, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i:]


def _initials_agree(rest1: str, rest2: str) -> bool:
    """The letters after the first: one is the start of the other, or all of it but the second part of a double given name."""
    short, long = sorted((rest1, rest2), key=len)
    return long.startswith(short) or (len(long) == 2 and short == long[1:])


def same_surname(kind: str, s1: str, s2: str) -> bool:
    return s1 == s2 or (kind == "person" and own_part(s1) == own_part(s2))


def agrees(kind: str, s1: str, g1: str, i1: str, s2: str, g2: str, i2: str) -> bool:
    """The exact check of a pair that the cosine found: False where surnames are no slip of each other or initials exclude each other. Slips need the evidence of slipped_surnames as well."""
    same = same_surname(kind, s1, s2)
    if kind == "word":
        return same
    if not same and (not one_edit(s1, s2) or min(len(s1), len(s2)) < 4):
        return False
    if kind == "group":
        return g1 == g2 and i1 == i2
    return bool(i1 and i2) and _initials_agree(i1[1:], i2[1:])


def _grams(word: str, sizes: tuple[int, ...]) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for n in sizes for i in range(len(padded) - n + 1)]


def given_grams(given: str) -> list[str]:
    """Trigrams of a given name, the name, and the name with one letter left out or open."""
    return [*_grams(given, (3,)), given, *[given[:i] + given[i + 1 :] for i in range(len(given))], *[f"{given[:i]}_{given[i + 1 :]}" for i in range(len(given))]]


def name_grams(kind: str, surname: str, given: str, initials: str) -> list[tuple[str, float]]:
    """(dimension, term weight) of a reading; the first character names the part: s surname, i first letter, g given name. Pet forms share the mass of the names they may stand for."""
    out = [("s" + g, 1.0) for g in _grams(own_part(surname) if kind == "person" else surname, (2, 3))]
    out += [("i" + c, 1.0) for c in first_letters(given, initials) if c]
    names = full_names(given) if given else ()
    return out + [("g" + g, 1.0 / len(names)) for n in names for g in given_grams(n)]


def name_vector(kind: str, surname: str, given: str, initials: str, share: dict[str, float]) -> tuple[dict[str, float], dict[str, float], dict[str, float]]:
    """Surname, first letter and given name as vectors of length 1 (empty ones stay empty). share: n-gram -> share of the readings that have it."""
    parts: dict[str, dict[str, float]] = {"s": {}, "i": {}, "g": {}}
    for gram, weight in name_grams(kind, surname, given, initials):
        part = parts[gram[0]]
        # The rarest n-grams are those of slips: their weight is smoothed, so that a slip does not outweigh the rest of a name. Shares hold for any size.
        part[gram] = part.get(gram, 0.0) + weight * math.log(1.0 + 1.0 / (share.get(gram, 0.0) + (RARE_SURNAME if gram[0] == "s" else RARE_GIVEN)))
    out = []
    for v in parts.values():
        norm = math.sqrt(sum([w * w for w in v.values()]))
        out.append({g: w / norm for g, w in v.items()} if norm else {})
    return out[0], out[1], out[2]


def _dot(x: dict[str, float], y: dict[str, float]) -> float:
    if len(y) < len(x):
        x, y = y, x
    return sum([w * y[g] for g, w in x.items() if g in y])


def name_cosine(x: tuple, y: tuple) -> float:
    """The cosine of two outer products, from their parts."""
    (s1, i1, g1), (s2, i2, g2) = x, y
    mass = ((1 + GIVEN * bool(g1)) * (1 + GIVEN * bool(g2))) ** 0.5
    return _dot(s1, s2) * (_dot(i1, i2) + GIVEN * _dot(g1, g2)) / mass


def _gapped(surname: str) -> set[str]:
    return {surname} | {surname[:i] + surname[i + 1 :] for i in range(len(surname))}


def _use_keys(given: str, initials: str) -> set[str]:
    """What a reading may have in common with a reading under another surname."""
    if given:
        return {"g" + n for n in full_names(given)} | {"i" + c for c in first_letters(given, initials)}
    return {"i" + initials[:1]}


def slipped_surnames(cores: DataFrame, near: DataFrame) -> DataFrame:
    """(surname_a, surname_b, by_given, by_initials): for person surnames one edit apart, whether the use of the rarer shows a slip of the other.

    All measures are shares, so they hold for any size of input. Given names: at least half of those
    of the rarer surname stand under the other too. Initials: that holds, or all its readings but
    one (or a fifth) meet a first letter there. A surname with over a quarter of all given names
    (half of all first letters) has such company by chance: then the rarer must be 20 times rarer.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, core, g, k) for s, core, g, i in zip(b["surname"], b["core"], b["given"], b["initials"]) for k in _use_keys(g, i)]
            yield pd.DataFrame(rows, columns=["surname", "core", "given", "k"])

    persons = cores.where("kind = 'person'")
    used = materialize(persons.select("surname", "core", "given", "initials").mapInPandas(spread, "surname string, core bigint, given string, k string"), "uses")
    all_given, all_letters = used.agg(F.approx_count_distinct(F.when(F.col("given") != "", F.col("given")), 0.02), F.approx_count_distinct(F.when(F.left("k", F.lit(1)) == "i", F.col("k")))).first()
    keys = used.select("surname", "k").distinct()
    totals = used.groupBy("surname").agg(
        F.count_distinct("core").alias("n"), F.count_distinct(F.when(F.col("given") != "", F.col("given"))).alias("n_given"), F.count_distinct(F.when(F.left("k", F.lit(1)) == "i", F.col("k"))).alias("n_letters")
    )
    named = lambda c: [F.col(x).alias(f"{x}_{c}") for x in ("n", "n_given", "n_letters")]
    sized = near.join(totals.select(F.col("surname").alias("surname_a"), *named("a")), "surname_a").join(totals.select(F.col("surname").alias("surname_b"), *named("b")), "surname_b")
    way = lambda x, y: sized.where(F.col(f"n_{x}") <= F.col(f"n_{y}")).select(
        "surname_a", "surname_b", F.col(f"surname_{x}").alias("rare"), F.col(f"surname_{y}").alias("usual"), F.col(f"n_{x}").alias("n"), F.col(f"n_{y}").alias("n_usual"),
        F.col(f"n_given_{x}").alias("n_given"), F.col(f"n_given_{y}").alias("given_usual"), F.col(f"n_letters_{y}").alias("letters_usual"),
    )
    ways = materialize(way("a", "b").unionByName(way("b", "a")), "ways")
    met = (
        ways.select("rare", "usual").distinct().join(used.withColumnRenamed("surname", "rare"), "rare").join(keys.withColumnRenamed("surname", "usual"), ["usual", "k"])
        .groupBy("rare", "usual").agg(
            F.count_distinct(F.when(F.left("k", F.lit(1)) == "g", F.col("given"))).alias("met_given"),
            F.count_distinct(F.when((F.left("k", F.lit(1)) == "g") | (F.col("given") == ""), F.col("core"))).alias("met"),
        )
    )
    rare = F.col("n") * 20 <= F.col("n_usual")
    known = (F.col("met_given") > 0) & (F.col("met_given") * 2 >= F.col("n_given")) & ((F.col("given_usual") * 4 <= all_given + 20) | rare)
    letters = (F.col("n") - F.col("met") <= F.greatest(F.lit(1.0), F.col("n") / 5)) & ((F.col("letters_usual") * 2 <= all_letters + 6) | rare)
    judged = ways.join(met, ["rare", "usual"]).select("surname_a", "surname_b", known.alias("by_given"), (known | letters).alias("by_initials"))
    return judged.groupBy("surname_a", "surname_b").agg(F.max("by_given").alias("by_given"), F.max("by_initials").alias("by_initials"))


def posting_pairs(cores: DataFrame, hot: int = 512) -> DataFrame:
    """(a, b), a < b: distinct readings that share a posting list, and in lists of over `hot` readings a given n-gram as well where both have a given name."""

    def postings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for core, kind, s, g, i in zip(b["core"], b["kind"], b["surname"], b["given"], b["initials"]):
                letters = {*first_letters(g, i), *(g[1:2] if len(g) > 2 else "")} if kind == "person" else {g if kind == "group" else ""}
                keys = _gapped(s) | {own_part(s)} if kind != "word" and len(s) >= 4 else {s}
                rows += [(f"{kind[0]}{letter}|{k}", core, bool(g) and kind == "person") for k in keys for letter in letters]
            yield pd.DataFrame(rows, columns=["dimension", "core", "named"])

    posted = materialize(cores.mapInPandas(postings, "dimension string, core bigint, named boolean").select(F.xxhash64("dimension").alias("d"), "core", "named"), "postings")
    # Dimensions with one core join nothing: leave them out before the join.
    sizes = materialize(posted.groupBy("d").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    usual = posted.join(sizes.where(F.col("n") <= hot).select("d"), "d", "left_semi")
    meet = lambda x, y, on: x.alias("x").join(y.alias("y"), on).where("x.core <> y.core").select(F.least("x.core", "y.core").alias("a"), F.greatest("x.core", "y.core").alias("b"))
    pairs = usual.alias("x").join(usual.alias("y"), "d").where("x.core < y.core").select(F.col("x.core").alias("a"), F.col("y.core").alias("b"))
    large = sizes.where(F.col("n") > hot)
    if large.limit(1).count():
        heavy = materialize(posted.join(large.select("d"), "d", "left_semi"), "heavy")

        def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(core, g) for core, given in zip(b["core"], b["given"]) for g in {x for n in full_names(given) for x in given_grams(n)}]
                yield pd.DataFrame(rows, columns=["core", "gram"])

        grams = cores.where("kind = 'person' and given <> ''").select("core", "given").mapInPandas(spread, "core bigint, gram string").select("core", F.xxhash64("gram").alias("gram"))
        named = heavy.where("named").select("d", "core").join(grams, "core")
        salt = lambda d: d.withColumn("salt", F.pmod(F.xxhash64("core"), F.lit(SALTS)).cast("int"))
        bare = heavy.where("not named").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = pairs.unionByName(meet(named, named, ["d", "gram"])).unionByName(meet(bare, salt(heavy), ["d", "salt"]))
    return pairs.distinct()


def spelling_links(cores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, cosine) of distinct readings (core bigint, kind, surname, given, initials): all pairs of at least the threshold that pass the exact check."""
    n_cores = max(1, cores.count())
    pairs = posting_pairs(cores)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = Counter(g for k, s, gv, i in zip(b["kind"], b["surname"], b["given"], b["initials"]) for g in {x for x, _ in name_grams(k, s, gv, i)})
            yield pd.DataFrame({"gram": list(counts.keys()), "n": list(counts.values())})

    # N-grams in at least SEEN of all readings: at most (n-grams a reading) / SEEN, whatever the input. Rarer ones weigh as unseen ones, which the smoothing makes nearly equal.
    shares = cores.mapInPandas(spread, "gram string, n bigint").groupBy("gram").agg((F.sum("n") / n_cores).alias("share")).where(F.col("share") >= SEEN)
    seen = cores.sparkSession.sparkContext.broadcast({r["gram"]: r["share"] for r in shares.toLocalIterator()})
    side = lambda k: cores.select(*[F.col(c).alias(f"{c}_{k}") for c in ("core", "kind", "surname", "given", "initials")])
    met = pairs.join(side("a"), F.col("a") == F.col("core_a")).join(side("b"), F.col("b") == F.col("core_b"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share = seen.value
        for p in batches:
            rows, known = [], {}
            for a, b, k, s1, g1, i1, s2, g2, i2 in zip(*[p[c] for c in ("a", "b", "kind_a", "surname_a", "given_a", "initials_a", "surname_b", "given_b", "initials_b")]):
                for core, reading in ((a, (k, s1, g1, i1)), (b, (k, s2, g2, i2))):
                    if core not in known:
                        known[core] = name_vector(*reading, share)
                cosine = name_cosine(known[a], known[b])
                if cosine >= threshold and agrees(k, s1, g1, i1, s2, g2, i2):
                    slipped = k == "person" and not same_surname(k, s1, s2)
                    # A slip is told by a given name on both sides; by initials only in a surname long enough.
                    named = bool(g1 and g2) or min(len(s1), len(s2)) < (5 if min(len(i1), len(i2)) >= 2 else 6)
                    rows.append((a, b, cosine, min(s1, s2) if slipped else None, max(s1, s2) if slipped else None, named))
            yield pd.DataFrame(rows, columns=["a", "b", "cosine", "surname_a", "surname_b", "named"])

    measured = materialize(met.mapInPandas(measure, "a bigint, b bigint, cosine double, surname_a string, surname_b string, named boolean"), "measured")
    evidence = slipped_surnames(cores, measured.where("surname_a is not null").select("surname_a", "surname_b").distinct())
    slips = measured.where("surname_a is not null").join(evidence, ["surname_a", "surname_b"]).where(F.when(F.col("named"), F.col("by_given")).otherwise(F.col("by_initials")))
    return measured.where("surname_a is null").select("a", "b", "cosine").unionByName(slips.select("a", "b", "cosine"))


def average_linkage(links: list[tuple[int, int, float]], least: float) -> dict[int, int]:
    """Node -> cluster (its least node). Pairs without a link have similarity 0; merging stops below `least`. Ties: lower nodes first."""
    size: dict[int, int] = {}
    total: dict[int, dict[int, float]] = defaultdict(dict)
    for a, b, s in links:
        size[a] = size[b] = 1
        total[a][b] = total[b][a] = s
    heap = [(-s, min(a, b), max(a, b), 1, 1) for a, b, s in links]
    heapq.heapify(heap)
    into = {x: x for x in size}
    while heap:
        s, a, b, na, nb = heapq.heappop(heap)
        if -s < least:
            break
        if size.get(a) != na or size.get(b) != nb or into[a] != a or into[b] != b:
            continue
        into[b] = a
        size[a] += size.pop(b)
        for c, w in total.pop(b).items():
            if c != a:
                total[c].pop(b, None)
                total[a][c] = total[c][a] = total[a].get(c, 0.0) + w
        total[a].pop(b, None)
        for c, w in total[a].items():
            heapq.heappush(heap, (-w / (size[a] * size[c]), min(a, c), max(a, c), size[min(a, c)], size[max(a, c)]))

    def top(x: int) -> int:
        while into[x] != x:
            x = into[x]
        return x

    return {x: top(x) for x in into}


def merged_in_rounds(links: DataFrame, least: float) -> DataFrame:
    """(core, set_id): average_linkage over links that need not fit a task.

    A round merges all pairs that are each other's best partner. Average linkage is reducible: a merged
    set is no nearer to a third one than the nearer of its parts, so merging these pairs at once ends
    in the sets of merging one pair at a time. Every round adds up the links between sets.
    """
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("cosine").alias("total")), "edges")
    sets = materialize(edges.select(F.explode(F.array("a", "b")).alias("core")).distinct().withColumn("set_id", F.col("core")), "members")
    size = sets.select(F.col("set_id").alias("node"), F.lit(1).cast("bigint").alias("size"))
    while True:
        sized = lambda c: size.select(F.col("node").alias(c), F.col("size").alias(f"n_{c}"))
        near = edges.join(sized("a"), "a").join(sized("b"), "b").withColumn("average", F.col("total") / (F.col("n_a") * F.col("n_b"))).where(F.col("average") >= least)
        pair = F.struct(F.col("average"), (-F.col("a")).alias("x"), (-F.col("b")).alias("y")).alias("pair")  # ties: lower nodes first
        best = near.select(F.explode(F.array("a", "b")).alias("node"), pair).groupBy("node").agg(F.max("pair").alias("pair"))
        merged = materialize(best.groupBy("pair").agg(F.count("*").alias("n")).where("n = 2").select((-F.col("pair.x")).alias("into"), (-F.col("pair.y")).alias("node")), "merged")
        if not merged.limit(1).count():
            return sets
        moved = lambda df, c: df.join(merged.select(F.col("node").alias(c), "into"), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")
        joined = moved(moved(edges, "a"), "b").where("a <> b")
        old = [edges, sets, merged]
        edges = materialize(joined.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total")), "edges")
        sets = materialize(moved(sets, "set_id"), "members")
        discard(*old)
        size = sets.groupBy(F.col("set_id").alias("node")).agg(F.count("*").alias("size"))


def spelling_sets(names: DataFrame, threshold: float = THRESHOLD, cut: float = CUT, most_links: int = 200_000) -> DataFrame:
    """(name, set_id): every name of `names` (one column) with its set; the set is named by a hash."""
    readings = materialize(resolved_readings(names), "resolved").withColumn("core", F.xxhash64("kind", "surname", "given", "initials"))
    cores = materialize(readings.select("core", "kind", "surname", "given", "initials").distinct(), "cores")
    # Square roots: what a reading leaves out (its factor is a root already) counts less than what contradicts.
    links = materialize(spelling_links(cores, threshold).withColumn("cosine", F.sqrt("cosine")), "spellings")
    parts = connected_components(links)
    tagged = links.join(parts, F.col("a") == F.col("node")).drop("node")
    sizes = materialize(tagged.groupBy("component").agg(F.count("*").alias("n")), "components")
    fits = tagged.join(sizes.where(F.col("n") <= most_links), "component", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Components one after the other, as they lie sorted in a partition."""
        rest = None
        for b in itertools.chain(batches, (None,)):
            if b is not None:
                rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            if rest is None or not len(rest):
                continue
            at = rest["component"].to_numpy()
            bounds = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            whole = bounds if b is None else bounds[:-1]  # the last component may go on in the next batch
            a, z, c = rest["a"].tolist(), rest["b"].tolist(), rest["cosine"].tolist()
            got: dict[int, int] = {}
            for lo, hi in zip(whole, whole[1:]):
                got.update(average_linkage(list(zip(a[lo:hi], z[lo:hi], c[lo:hi])), cut))
            rest = rest.iloc[whole[-1] :]
            yield pd.DataFrame({"core": list(got.keys()), "set_id": list(got.values())}, dtype="int64")

    parted = fits.select("component", "a", "b", "cosine").repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "component").sortWithinPartitions("component")
    clusters = materialize(parted.mapInPandas(run, "core bigint, set_id bigint"), "sets")
    large = sizes.where(F.col("n") > most_links)
    if large.limit(1).count():
        clusters = clusters.unionByName(merged_in_rounds(tagged.join(large, "component", "left_semi").select("a", "b", "cosine"), cut))
    return readings.select("name", "core").join(clusters, "core", "left").select("name", F.coalesce("set_id", "core").alias("set_id"))


def spelling_pairs(names: DataFrame, **options) -> DataFrame:
    """(name_a, name_b), name_a < name_b by code point: the pairs of every set."""
    sets = materialize(spelling_sets(names, **options), "named")
    a, b = (sets.select("set_id", F.col("name").alias(f"name_{k}")) for k in "ab")
    return a.join(b, "set_id").where("name_a < name_b").select("name_a", "name_b").distinct()
