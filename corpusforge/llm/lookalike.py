"""One consistent form of texts that look alike but differ in their characters.

Two steps. `visual_form` removes what a reader cannot see and holds for every text alone: width,
joined letters, kinds of blank and hyphen, invisible characters, composed or separate accents.
`repaired` then replaces letters borrowed from other scripts. The letters of each token are counted
by script; in a token of mixed script those of the others are substituted by look-alikes of the
dominant script (the one with most letters; the next one where the dominant has no look-alike of
some letter, or where its result is no word), in whichever direction that goes, when the result exists in
the vocabulary of the corpus. A token of Latin look-alikes only that stands between Latin words is
treated as mixed (small Greek letters alone or with one other are taken for maths). The vocabulary is the set of all tokens of one script over all
documents, together with results that two or more different spellings lead to. Which letters look
alike is read from the Unicode confusables that come with Spark's ICU library.

Kept as visible: case, digits, accents, raised and lowered signs, fractions, dashes, the number of
blanks, line ends, real words of Greek and letters of maths.

Defined cases: null texts and rows without id give no row; the empty text is its own form; ids may repeat (each row
counts); texts equal as strings share a form and are no pair.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.session import materialize

# Letters of other scripts that have the shape of a Latin letter (for folding words; repair reads the Unicode data).
CYRILLIC = "АВЕЅІЈКМНОРСТУХԚԜаеѕіјорсухһԛԝԁӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXQWaesijopcyxhqwdl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον"
GREEK_AS = "ABEZHIKMNOPTYXov"
ARMENIAN = "օսհ"
ARMENIAN_AS = "ouh"

LOOKALIKE = dict(zip(CYRILLIC + GREEK + ARMENIAN, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS))
#: Scripts whose letters are compared. Phonetic letters count as a script of their own.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Coptic", "Cherokee", "Georgian", "Lisu")
PHONETIC = range(0x250, 0x2B0)


def _visible_table() -> dict[int, str | None]:
    """Character -> visible form, by rule from the Unicode data."""
    table: dict[int, str | None] = {}
    for code in chain(range(0xD800), range(0xE000, 0x20000), range(0xE0000, 0xE0200)):  # no such signs elsewhere
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Zs":
            table[code] = " "
        elif kind == "Cf" or (kind == "Cc" and char not in "\t\n\r\x0b\x0c\x85"):
            table[code] = None
        elif 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or code == 0x034F:
            table[code] = None  # variation selectors, grapheme joiner
        else:
            tag, _, parts = unicodedata.decomposition(char).partition("> ")
            if tag in ("<wide", "<narrow", "<noBreak"):
                table[code] = "".join(chr(int(x, 16)) for x in parts.split())
            elif tag == "<compat" and re.search("LIGATURE|LETTER (DZ|LJ|NJ|[DLN] WITH SMALL)", unicodedata.name(char, "")) and kind[0] == "L" and code < 0xFB18:
                table[code] = unicodedata.normalize("NFKD", char)
    table |= {0x2010: "-", 0x2011: "-", 0xFE63: "-", 0x09: " ", 0x85: "\n", 0x2028: "\n", 0x2029: "\n", 0x0B: "\n", 0x0C: "\n"}
    del table[0x20]
    return table


_TABLE = _visible_table()
_LINE = re.compile("\r\n?")
#: Signs that may have another visible form; the rest of a text is left as it is.
ODD = re.compile("[^\n -~]")
_TOKEN = regex.compile(r"[\p{L}\p{M}]+")
_LATIN = regex.compile(r"\p{Latin}")
_SCRIPT = regex.compile("|".join(rf"(\p{{{name}}})" for name in SCRIPTS))


def script_of(char: str) -> str | None:
    """The script of a letter among SCRIPTS; None for other signs and scripts."""
    if ord(char) in PHONETIC:
        return "Phonetic"
    found = _SCRIPT.match(char)
    return SCRIPTS[found.lastindex - 1] if found else None


def _visible(match: re.Match) -> str:
    char = match[0]
    return _TABLE.get(ord(char), char) or ""


def visual_form(text: str) -> str:
    """The text without differences that no reader can see; look-alike letters are left."""
    if text.isascii() and text.isprintable():
        return text
    return unicodedata.normalize("NFC", ODD.sub(_visible, _LINE.sub("\n", text)))


def _in_token(char: str) -> bool:
    return char.isalpha() or unicodedata.category(char)[0] == "M"


def _token_start(text: str, at: int) -> int:
    while at > 0 and _in_token(text[at - 1]):
        at -= 1
    return at


def _token_end(text: str, at: int) -> int:
    while at < len(text) and _in_token(text[at]):
        at += 1
    return at


def _token_before(text: str, at: int) -> str:
    while at > 0 and not _in_token(text[at - 1]):
        at -= 1
    return text[_token_start(text, at) : at]


def _token_after(text: str, at: int) -> str:
    while at < len(text) and not _in_token(text[at]):
        at += 1
    return text[at : _token_end(text, at)]


class Confusables:
    """Which letter of a script stands for a letter of another: `into[script][letter]`.

    Made from (letter, skeleton) pairs: letters of one case with one skeleton look alike; of several
    letters of a script the first of its alphabet is taken. Fixed values go before.
    """

    def __init__(self, skeletons: dict[str, str]):
        alike: dict[tuple[str, bool], dict[str, str]] = {}
        for char in sorted(skeletons):
            script = script_of(char)
            if script and not unicodedata.decomposition(char):
                alike.setdefault((skeletons[char], char.isupper()), {}).setdefault(script, char)
        self.script = {}
        self.into: dict[str, dict[str, str]] = {name: {} for name in SCRIPTS}
        for char, skeleton in skeletons.items():
            script = script_of(char)
            if script is None:
                continue
            self.script[char] = script
            for other, letter in alike.get((skeleton, char.isupper()), {}).items():
                if other != script and other != "Phonetic":
                    self.into[other][char] = letter
        for char, letter in LOOKALIKE.items():
            self.into["Latin"][char] = letter
            self.into[self.script.setdefault(char, script_of(char))].setdefault(letter, char)
        self.foreign = re.compile("[" + "".join(sorted(c for c in self.script if self.script[c] != "Latin")) + "]")

    def results(self, token: str) -> list[str]:
        """The token in one script, for each script that can write it, that with most of its letters first; empty for a token of one script that is not Latin's look-alike."""
        letters = unicodedata.normalize("NFD", token)
        counts: dict[str, int] = {}
        if len(token) < 3 and any(self.script.get(c) == "Greek" and c not in LOOKALIKE for c in letters):
            return []  # a sign of maths with an index
        for char in letters:
            script = self.script.get(char)
            if script is None and char.isalpha():
                return []
            if script:
                counts[script] = counts.get(script, 0) + 1
        if "Latin" not in counts and len(counts) == 1:
            script = next(iter(counts))
            counts["Latin"] = 0
        if len(counts) < 2:
            return []
        out = []
        for script in sorted((c for c in counts if c in self.into), key=lambda c: (-counts[c], SCRIPTS.index(c))):
            table = self.into[script]
            if counts[script] == sum(counts.values()):
                continue
            if all(self.script.get(c) in (None, script) or c in table for c in letters):
                out.append(unicodedata.normalize("NFC", "".join(c if self.script.get(c) in (None, script) else table[c] for c in letters)))
        return out

    def suspects(self, text: str) -> list[tuple[int, int, str, list[str]]]:
        """(start, end, token, results) of the tokens of a visual form that look-alikes could hide in.

        Tokens of mixed script are such; one of a single other script only if it can be written in
        Latin and its nearest neighbours hold Latin letters.
        """
        if text.isascii():
            return []
        out, done = [], 0
        for hit in self.foreign.finditer(text):
            if hit.start() < done:
                continue
            a, b = _token_start(text, hit.start()), _token_end(text, hit.end())
            token, done = text[a:b], b
            if not _LATIN.search(token):
                near = [x for x in (_token_before(text, a), _token_after(text, b)) if x]
                if not near or not all(_LATIN.search(x) for x in near):
                    continue
            results = self.results(token)
            if results:
                out.append((a, b, token, results))
        return out

    def repaired(self, text: str, known: set[str], vouched: set[str] = frozenset()) -> str:
        """The visual form with the suspects replaced by their first result that is in the vocabulary, else by the first that several spellings lead to."""
        out, at = [], 0
        for a, b, _, results in self.suspects(text):
            result = next((r for r in results if r in known), None) or next((r for r in results if r in vouched), None)
            if result is not None:
                out += [text[at:a], result]
                at = b
        return unicodedata.normalize("NFC", "".join(out) + text[at:])


def unicode_confusables(spark: SparkSession) -> Confusables:
    """The letters that look alike by the confusables of Spark's ICU library (one call on the driver; the table is of fixed size)."""
    chars = [c for c in map(chr, chain(range(0x41, 0x5B), range(0x61, 0x7B), range(0xC0, 0x2E00), range(0xA4D0, 0xA700), range(0xAB30, 0xABC0))) if c.isalpha() and script_of(c)]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    skeletons = checker.getSkeleton("\n".join(chars)).split("\n")
    if len(skeletons) != len(chars):
        raise RuntimeError("unexpected skeletons of letters")
    return Confusables(dict(zip(chars, skeletons)))


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def canonical_forms(df: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """(key, raw_hash, form_hash[, form]): the consistent form of every text, as 128-bit digests or whole.

    Texts without suspects (nearly all) are done in one narrow pass. Suspect tokens are confirmed
    by a join of the distinct results with the distinct clean tokens, pre-aggregated per batch;
    only documents that hold suspects are joined with what is confirmed.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    alike = unicode_confusables(df.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, clean, dirty = [], set(), set()
            for k, t in zip(batch["key"], batch["text"]):
                form = visual_form(t)
                found = alike.suspects(form)
                rows.append((k, _digest(t), None if found else _digest(form), form if found or with_text else None, list({r for *_, rs in found for r in rs})))
                dirty.update((token, result) for _, _, token, results in found for result in results)
                if found:  # a suspect is no evidence for itself
                    odd = {token for _, _, token, _ in found}
                    clean.update(w for piece in set(form.split()) for w in _TOKEN.findall(piece) if w not in odd)
                else:
                    clean.update(form.split())
            words = {w for piece in clean for w in (_TOKEN.findall(piece) if not piece.isalpha() else [piece])}
            rows += [(None, None, None, w, None) for w in words]
            rows += [(None, None, None, token, [result]) for token, result in dirty]
            yield pd.DataFrame(rows, columns=["key", "raw_hash", "form_hash", "form", "results"])

    kind = df.schema[key].dataType.simpleString()
    scanned = materialize(source.mapInPandas(scan, f"key {kind}, raw_hash binary, form_hash binary, form string, results array<string>"), "visual")
    docs = scanned.where("raw_hash is not null")
    vocabulary = scanned.where("raw_hash is null and results is null").select(F.col("form").alias("result")).distinct()
    spellings = scanned.where("raw_hash is null and results is not null").select("form", F.col("results")[0].alias("result")).distinct()
    often = spellings.groupBy("result").agg(F.count("*").alias("n")).where("n > 1").select("result")
    proof = vocabulary.withColumn("known", F.lit(True)).unionByName(often.withColumn("known", F.lit(False))).groupBy("result").agg(F.max("known").alias("known"))
    confirmed = spellings.select("result").distinct().join(proof, "result")
    open_docs = docs.where("form_hash is null").select("key", "raw_hash", "form", "results")
    # A document's suspects are looked up by result and come back as one list; text travels once.
    looked = (
        open_docs.select("key", "raw_hash", F.explode("results").alias("result")).distinct()
        .join(confirmed, "result")
        .groupBy("key", "raw_hash").agg(F.collect_set(F.when(F.col("known"), F.col("result"))).alias("known"), F.collect_set(F.when(~F.col("known"), F.col("result"))).alias("vouched"))
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = lambda x: set(x) if x is not None else set()
            forms = [alike.repaired(t, words(k), words(v)) for t, k, v in zip(batch["form"], batch["known"], batch["vouched"])]
            yield pd.DataFrame({"key": batch["key"], "raw_hash": batch["raw_hash"], "form_hash": [_digest(x) for x in forms], "form": forms if with_text else None})

    shape = f"key {kind}, raw_hash binary, form_hash binary, form string"
    done = open_docs.drop("results").join(looked, ["key", "raw_hash"], "left").mapInPandas(finish, shape)
    out = docs.where("form_hash is not null").select("key", "raw_hash", "form_hash", "form").unionByName(done)
    return out.withColumnRenamed("key", key) if with_text else out.drop("form").withColumnRenamed("key", key)


def lookalike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_a, key_b), key_a < key_b: texts of one form that differ as strings.

    Only forms with two or more raw strings take part, so a group of exact copies costs nothing
    by itself; what remains is the size of the result.
    """
    forms = materialize(canonical_forms(df, key, text).distinct(), "forms")
    open_forms = forms.groupBy("form_hash").agg(F.min("raw_hash").alias("lo"), F.max("raw_hash").alias("hi")).where("lo <> hi").select("form_hash")
    rows = forms.join(open_forms, "form_hash", "left_semi")
    a = rows.select("form_hash", F.col("raw_hash").alias("raw_a"), F.col(key).alias(f"{key}_a"))
    b = rows.select("form_hash", F.col("raw_hash").alias("raw_b"), F.col(key).alias(f"{key}_b"))
    pairs = a.join(b, "form_hash").where((F.col("raw_a") != F.col("raw_b")) & (F.col(f"{key}_a") < F.col(f"{key}_b")))
    return pairs.select(f"{key}_a", f"{key}_b").distinct()


def form_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_spellings): one row per text; the class is named by the hex digest of its form."""
    forms = canonical_forms(df, key, text)
    sizes = forms.select("form_hash", "raw_hash").distinct().groupBy("form_hash").agg(F.count("*").alias("n_spellings"))
    return forms.join(sizes, "form_hash").select(key, F.lower(F.hex("form_hash")).alias("class_id"), "n_spellings")
