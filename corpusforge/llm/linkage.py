"""Which found work is which known paper, without a shared identifier.

Blocking by keys that both sides derive from themselves: the sentences of the abstract,
and, where an abstract is missing, author with the start or the end of the title, and the title
itself. Keys that more than `hot` papers have give the same pairs and counts as others: those
a found work can spare (it needs a third of its sentences) are only counted, the rest are joined in salted parts. On every candidate pair several labelling functions vote
(abstract, title, authors, year, system name, marks of a follow-up, another subject); a generative model with the classes unrelated, follow-up,
sibling (other work of the same people) and same learns their accuracies and correlations from the vote patterns and gives each pattern its posterior.

A found work without abstract takes that of another row with the same title and an author in
common, if there is one; that evidence has its own vote.

Defined cases: null, empty and placeholder fields abstain; repeated rows count once; rows without
id are ignored; of a paper crawled several times all versions are compared and the best counts;
each candidate is linked to at most one paper, the one of highest posterior, ties to more shared
sentences, then the lower id; a row that has no key in common with a paper has no link.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import labelmodel
from corpusforge.llm.names import BASE_LETTERS, first_letters, read_name
from corpusforge.session import materialize

OPENING = 64  # letters of a sentence's start that make a key of their own, for abstracts that end within their first sentence
#: Texts that stand for a missing abstract, in letters and digits only.
PLACEHOLDERS = ("na", "none", "null", "nan", "tbd", "tba", "abstractnotavailable", "noabstract", "noabstractavailable", "notavailable", "unknown", "")
#: Words that make a title that of another work when they stand beside an earlier title.
FOLLOW_UP = (
    "revisited revisiting revisit comment comments reply replying response rebuttal reproducing reproduction reproducibility replicating replication replicability "
    "part ii iii iv second third look beyond extending extension improved improving again reconsidered reexamined reexamining erratum corrigendum "
    "followup sequel lessons independent critical 2 3 v2 v3 plus scale"
).split()
#: What search services put around a title.
NOISE = r"(?i)\[(?:html|pdf|book|citation|c|b|v\d+)\]|\((?:extended abstract|preprint|short paper|workshop version|poster|demo)\)|\s[—–-]\s*(?:\w+ )?preprint\s*$|\bextended abstract\s*$"
VOTES = ("abstract", "twin", "title", "authors", "year", "system", "follow_up", "topic")


SALTS = 8  # parts of a key that many papers have
SHAPE = (
    "id {kind}, year int, cut boolean, letters string, words array<bigint>, marks array<string>, system string, n_who int, who array<bigint>, "
    "n_said int, said array<bigint>, titled array<bigint>, lead array<bigint>, twin array<bigint>"
)


_NOISE, _CUT = re.compile(NOISE), re.compile(r"(?:\.\.\.|…)\s*$")
_MARK = re.compile(r"(?:\s*(?:\[\.\.\.\]|\.\.\.|…))+\s*$")
_BREAK = re.compile(r"(?<=[.!?])\s+(?=[A-Z0-9\"“(])")
_NOT_LETTER, _WORD = re.compile(r"[^a-z0-9]+"), re.compile(r"[^\W_]+\+*")
_SYSTEM = re.compile(r"\s*([^:]{2,40}):\s")
_GROWN = re.compile(r"(\+\+|v\d)$")
_FOLLOW = frozenset(FOLLOW_UP)


def _plain(text: str) -> str:
    return (text if text.isascii() else text.translate(BASE_LETTERS)).lower()


# One pass over bytes: capitals to small, all but letters and digits of ASCII left out.
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_OTHERS = bytes(c for c in range(256) if not chr(c).isascii() or not chr(c).isalnum())
_OTHERS_THAN_NUL = _OTHERS.replace(b"\0", b"")


def _bare(text: str) -> str:
    return text.encode("ascii", "ignore").translate(_SMALL, _OTHERS).decode()


def sentences(abstract: str) -> tuple[list[str], list[str]]:
    """(letters of the whole sentences; first OPENING letters of all that have so many)."""
    text = abstract.strip()
    if text[-1:] in ("…", "]", "."):
        text = text[:-24] + _MARK.sub("", text[-24:]) if len(text) > 24 else _MARK.sub("", text)
    if "\0" in text:
        text = text.replace("\0", " ")
    # All sentences are brought to their letters at once, with NUL between them.
    parts = _BREAK.sub("\0", text).encode("ascii", "ignore").translate(_SMALL, _OTHERS_THAN_NUL).decode().split("\0")
    whole = [x for x in (parts if text[-1:] in (".", "!", "?") else parts[:-1]) if len(x) >= 30]
    return whole, [x[:OPENING] for x in parts if len(x) >= OPENING]


@lru_cache(maxsize=300_000)
def _author_keys(entry: str) -> tuple[str, ...]:
    read = read_name(entry)
    if read is None or not read[5]:
        return ()
    kind, _, s2, g2, i2, s1, g1, i1 = read
    if kind != "person":
        return (f"{s1}|{kind[0]}",)
    out = {f"{s1}|{x}" for x in first_letters(g1, i1)}
    if s2:
        out |= {f"{s2}|{x}" for x in first_letters(g2, i2)}
    return tuple(sorted(out))


def _hashes(lists: list[list[str]]) -> pa.Array:
    """Lists of the 64-bit hashes of the strings of every list, all hashed at once."""
    flat = [s for x in lists for s in x]
    values = pd.util.hash_array(np.array(flat, object), categorize=False).view(np.int64) if flat else np.zeros(0, np.int64)
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


@lru_cache(maxsize=100_000)
def _title_parts(name: str) -> tuple:
    """(cut, letters, words, marks, system) of a title."""
    name = _NOISE.sub(" ", name)
    bare = _CUT.sub("", name)
    plain = _plain(bare)
    words = _WORD.findall(plain)
    system = _SYSTEM.match(plain)
    system = _NOT_LETTER.sub("", system[1]) + "+" * system[1].count("+") if system and len(system[1].split()) <= 2 else None
    return bare != name, _NOT_LETTER.sub("", plain), list(dict.fromkeys(words)), sorted({w for w in words if w in _FOLLOW or _GROWN.search(w)}), system


def described(df: DataFrame, key: str, title: str, all_titles: bool) -> DataFrame:
    """SHAPE: what is compared of every row, and the keys it is met by. One narrow pass.

    said: sentences of the abstract. titled: start and end of the title with every author, and the
    whole title; given where the abstract is missing, or always. lead: the same with the first
    author only. twin: the title with the first author.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, authors, abstract in zip(b["title"].to_pylist(), b["authors"].to_pylist(), b["abstract"].to_pylist()):
                cut, letters, words, marks, system = _title_parts(name or "")
                who = [k for k in [_author_keys(a) for a in authors if a] if k] if authors else []
                whole, starts = sentences(abstract) if abstract and (len(abstract) > 60 or _bare(abstract) not in PLACEHOLDERS) else ([], [])
                # A found abstract without a whole sentence is met by how its sentences start; papers offer both.
                said = [*whole, *["<" + x for x in starts]] if all_titles else whole or ["<" + x for x in starts]
                keys = list(dict.fromkeys([k for ks in who for k in ks]))
                known = len(letters) >= 8
                start, end = "s" + letters[:10] + "|", "e" + letters[-10:] + "|"
                first = who[0] if who and known else ()
                lead = [x for k in first for x in (start + k, end + k)]
                full = [x for k in keys for x in (start + k, end + k)] if known and (all_titles or not said) else []
                if known:
                    lead.append("t" + letters)
                twin = [f"w{letters}|{k}" for k in first] if len(letters) >= 12 else []
                rows.append((cut, letters, words, marks, system, len(who), keys, said, len(set(whole or starts)), full, lead, twin))
            out = dict(zip(("cut", "letters", "words", "marks", "system", "n_who", "who", "said", "n_said", "titled", "lead", "twin"), map(list, zip(*rows)) if rows else [[] for _ in range(12)]))
            kinds = {"cut": pa.bool_(), "letters": pa.string(), "marks": pa.list_(pa.string()), "system": pa.string(), "n_who": pa.int32(), "n_said": pa.int32()}
            columns = {"id": b["id"], "year": b["year"]} | {c: pa.array(v, kinds[c]) if c in kinds else _hashes(v) for c, v in out.items()}
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in (x.split()[0] for x in SHAPE.split(", "))})

    kind = df.schema[key].dataType.simpleString()
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col("year").cast("int").alias("year"), F.col(title).alias("title"), "authors", "abstract")
    return materialize(rows.mapInArrow(run, SHAPE.format(kind=kind)), "described")


def _lent(found: DataFrame) -> DataFrame:
    """(id, lent): for rows without abstract, the sentences of a row of the same title and first author (the longest, ties by value)."""
    wanted = found.where("n_said = 0").select("id", F.explode("twin").alias("k"))
    given = found.where("n_said > 0").select(F.explode("twin").alias("k"), "n_said", "said").join(wanted.select("k").distinct(), "k", "left_semi")
    best = given.groupBy("k").agg(F.max(F.struct("n_said", "said"))["said"].alias("lent"))
    return wanted.join(best, "k").groupBy("id").agg(F.max("lent").alias("lent"))


def candidate_pairs(found: DataFrame, papers: DataFrame, lent: DataFrame, hot: int = 64) -> DataFrame:
    """(id, paper, n_shared, n): pairs with a title key in common or at least a third of the n sentences of the found work."""
    tagged = lambda d, column, spoken, n: d.select("id", F.explode(column).alias("key"), F.lit(spoken).alias("o"), n.alias("n"))
    none = F.lit(0)
    mine = tagged(found, "said", True, F.col("n_said")).unionByName(tagged(lent, "lent", True, F.size("lent"))).unionByName(tagged(found, "titled", False, none)).unionByName(tagged(found, "lead", False, none))
    theirs = tagged(papers, "said", True, none).unionByName(tagged(papers, "titled", False, none)).unionByName(tagged(papers, "lead", False, none)).select(F.col("id").alias("paper"), "key").distinct()
    heavy = materialize(theirs.groupBy("key").agg(F.count("*").alias("papers")).where(F.col("papers") > hot), "hot")
    any_hot = heavy.limit(1).count() > 0
    usual = theirs.join(heavy, "key", "left_anti") if any_hot else theirs
    out = mine.join(usual, "key").select("id", "paper", "key", "o", "n")
    if any_hot:
        # A pair with a third of n sentences in common has one of them outside the most common ceil(n / 3) - 1: those meet no one.
        common = mine.where("o").distinct().join(heavy, "key").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("papers"), "key")))
        common = materialize(common, "common")
        meeting = common.where("rank >= ceil(n / 3)").select("id", "key", "o").unionByName(mine.where("not o").select("id", "key", "o").distinct().join(heavy, "key", "left_semi"))
        salted = theirs.join(heavy, "key", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        through = meeting.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
        out = out.unionByName(through.select("id", "paper", F.lit(None).cast("bigint").alias("key"), "o", F.lit(0).alias("n")))
    met = out.groupBy("id", "paper").agg(F.size(F.collect_set(F.when(F.col("o"), F.col("key")))).alias("n_shared"), F.max("n").alias("n"), F.max(~F.col("o")).alias("by_title"))
    if any_hot:  # all common sentences of a pair count, whatever it met by
        said_f = common.groupBy("id").agg(F.collect_set("key").alias("f_common"), F.max("n").alias("n_all"))
        said_p = papers.select(F.col("id").alias("paper"), F.explode("said").alias("key")).join(heavy, "key", "left_semi").groupBy("paper").agg(F.collect_set("key").alias("p_common"))
        both = F.coalesce(F.size(F.array_intersect("f_common", "p_common")), F.lit(0))
        met = met.join(said_f, "id", "left").join(said_p, "paper", "left").withColumn("both", F.when(F.col("f_common").isNull() | F.col("p_common").isNull(), 0).otherwise(both))
        met = met.select("id", "paper", (F.col("n_shared") + F.col("both")).alias("n_shared"), F.when(F.col("both") > 0, F.greatest("n", "n_all")).otherwise(F.col("n")).alias("n"), "by_title")
    return met.where(F.col("by_title") | (F.col("n_shared") * 3 >= F.col("n"))).drop("by_title")


def _votes(d: DataFrame) -> DataFrame:
    """The labelling functions on pairs with columns f_ (found) and p_ (paper)."""
    n = F.least(F.greatest("f_n_said", "f_n_lent"), F.col("p_n_said"))
    s = F.col("n_shared")
    said = F.when(n <= 0, 0).when(s >= 0.5 * n, F.when(s >= 2, 2).otherwise(1)).when(s <= 0.34 * n, -1).otherwise(0)
    common = F.size(F.array_intersect("f_words", "p_words"))
    fewest = F.least(F.size("f_words"), F.size("p_words"))
    jaccard = common / F.greatest(F.size("f_words") + F.size("p_words") - common, F.lit(1))
    inside = common / F.greatest(fewest, F.lit(1))
    f, p = F.col("f_letters"), F.col("p_letters")
    start = F.col("f_cut") & (F.length(f) >= 12) & F.startswith(p, f)
    near_start = F.col("f_cut") & (F.length(f) >= 20) & (F.levenshtein(f, F.left(p, F.length(f)), 3) >= 0)
    title = (
        F.when((f == "") | (p == ""), 0).when((f == p) | (F.levenshtein(f, p, 4) >= 0), 2).when(start | near_start, 1)
        .when((jaccard >= 0.8) | ((inside >= 0.95) & (fewest >= 4)), 1).when(jaccard < 0.5, -1).otherwise(0)
    )
    n_who = F.when(F.col("p_n_who") <= 0, 0).otherwise(F.col("f_n_who"))  # found lists are cut short, those of papers are whole
    s_who = F.size(F.array_intersect("f_who", "p_who"))
    authors = F.when(n_who <= 0, 0).when(s_who >= 0.7 * n_who, F.when(s_who >= 2, 2).otherwise(1)).when(s_who == 0, -1).otherwise(0)
    gap = F.abs(F.col("f_year") - F.col("p_year"))
    year = F.when(gap.isNull(), 0).when(gap == 0, 2).when(gap == 1, 1).otherwise(-1)
    a, b = F.col("f_system"), F.col("p_system")
    suffix = r"^(\+\+|v?\d+|ii|plus|pro|xl|next)$"
    grown = (a != b) & ((F.startswith(a, b) & F.expr("substr(f_system, length(p_system) + 1)").rlike(suffix)) | (F.startswith(b, a) & F.expr("substr(p_system, length(f_system) + 1)").rlike(suffix)))
    system = F.when(a.isNull() | b.isNull(), 0).when(a == b, 1).when(F.levenshtein(a, b, 2) >= 0, 0).otherwise(-1)
    marked = F.coalesce(grown, F.lit(False)) | (F.size(F.array_except("f_marks", "p_marks")) > 0) | ((F.size(F.array_except("p_marks", "f_marks")) > 0) & ~F.col("f_cut"))
    related = (jaccard >= 0.4) | (inside >= 0.7)
    own = F.col("f_n_said") > 0
    # Words of each title that the other lacks: some on both sides name another subject.
    topic = (F.size(F.array_except("f_words", "p_words")) >= 2) & (F.size(F.array_except("p_words", "f_words")) >= 2) & ~F.col("f_cut")
    return d.select(
        "id", "paper", "n_shared", F.when(own, said).otherwise(0).alias("abstract"), F.when(own, 0).otherwise(said).alias("twin"),
        title.alias("title"), authors.alias("authors"), year.alias("year"), system.alias("system"), F.when(related & marked, -1).otherwise(0).alias("follow_up"), F.when(related & topic & (title < 2), -1).otherwise(0).alias("topic"),
    ).distinct()


def _first_guess(votes: np.ndarray) -> np.ndarray:
    """Soft start of the classes unrelated, follow-up, sibling, same from plain sums of the votes."""
    abstract, twin, title, authors, year, system, follow, topic = (votes[:, i].astype(float) for i in range(len(VOTES)))
    said = np.where(abstract != 0, abstract, twin)
    near = 1 / (1 + np.exp(-2 * (title + authors)))
    same = 1 / (1 + np.exp(-2 * (2 * said + 0.7 * title + authors + 0.4 * year + 0.4 * system + 3 * follow + 2 * topic))) * np.where(said < 0, 0.02, 1.0)
    late = np.where(follow < 0, 0.9, 0.3)
    return np.stack([(1 - same) * (1 - near), (1 - same) * near * late, (1 - same) * near * (1 - late), same], 1) + 1e-3


def judged_pairs(found: DataFrame, papers: DataFrame) -> DataFrame:
    """(id, paper, votes..., n_shared, posterior) of all candidate pairs."""
    f, p = described(found, "cand_id", "paper_title", all_titles=False), described(papers, "paper_id", "title", all_titles=True)
    lent = materialize(_lent(f), "lent")
    pairs = candidate_pairs(f, p, lent)
    kept = ("year", "cut", "letters", "words", "marks", "system", "n_who", "who", "n_said")
    side_f = f.select("id", *[F.col(c).alias(f"f_{c}") for c in kept])
    side_p = p.select(F.col("id").alias("paper"), *[F.col(c).alias(f"p_{c}") for c in kept])
    with_lent = pairs.withColumnRenamed("n", "f_n_lent")
    voted = materialize(_votes(with_lent.join(side_p, "paper").join(side_f, "id")), "votes")
    patterns = voted.groupBy(*VOTES).agg(F.count("*").alias("n")).limit(labelmodel.MOST_PATTERNS + 1).toPandas()  # at most 4 * 4 * 4 * 4 * 4 * 3 * 2 * 2 patterns exist
    if len(patterns) > labelmodel.MOST_PATTERNS:
        raise ValueError("more vote patterns than the votes allow")
    votes = patterns[list(VOTES)].to_numpy(np.int64).reshape(-1, len(VOTES))
    posterior, _ = labelmodel.fit(votes, patterns["n"].to_numpy(float), _first_guess(votes))
    patterns["posterior"] = posterior[:, 3] if len(patterns) else []
    schema = ", ".join(f"{v} int" for v in VOTES) + ", n bigint, posterior double"
    learned = voted.sparkSession.createDataFrame(patterns, schema) if len(patterns) else voted.sparkSession.createDataFrame([], schema)
    return voted.join(F.broadcast(learned.drop("n")), list(VOTES))


def linked(found: DataFrame, papers: DataFrame, least: float = 0.5) -> DataFrame:
    """(cand_id, paper_id, confidence): the paper of each found work that is one."""
    best = judged_pairs(found, papers).where(F.col("posterior") >= least).groupBy("id", "paper").agg(F.max(F.struct("posterior", "n_shared")).alias("b"))
    top = best.groupBy("id").agg(F.max(F.struct("b.posterior", "b.n_shared")).alias("m"))
    same = best.join(top, "id").where((F.col("b.posterior") == F.col("m.posterior")) & (F.col("b.n_shared") == F.col("m.n_shared")))
    return same.groupBy(F.col("id").alias("cand_id")).agg(F.min("paper").alias("paper_id"), F.max("b.posterior").alias("confidence"))
