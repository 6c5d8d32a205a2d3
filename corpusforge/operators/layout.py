"""Page layout: fragments to lines, lines to blocks, sections, runs, regions, metadata.

Tables: fragments (doc, page, frag, text, x, y, font_size), lines (LINES), blocks (doc, page, block, block_type, y, text,
caption, x0, y0, x1, y1), regions (doc, page, block_type, caption, x0, y0, x1, y1). y grows upwards. Steps with a fixed
look-back are windows or array expressions; those that depend on how far a group has grown
(`captions`, `page_blocks`) run per page over arrays; `markdown_of_sets` does all steps over sets (doc, page, set), a
page's fragments in one row. A page is the unit of work, so a document of any length never becomes one task. Nulls: a fragment without place or text is left out, one without a font size
counts as 8 points; a line without text is no part of a block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.functions.text import heading_name, joined_lines, squeeze

# Geometry in points, patterns and words.
ROW_TOLERANCE, BLOCK_GAP, OVERLAP = 2.5, 18.0, 0.35
DEFAULT_FONT, WORD_GAP_SHARE, LEAST_WORD_GAP, GLYPH = 8.0, 0.3, 4.0, 0.55
TABLE_GAP, FIGURE_FIRST_GAP, FIGURE_GAP, TABLE_INDENT = 20.0, 160.0, 18.0, 40.0
PAGE_MARGIN, COLUMN_MARGIN, GUTTER, WIDE_CAPTION = 24.0, 36.0, 18.0, 0.55
HEADING = r"^(?:\d+|[A-Z])(?:\.\d+)*\s+[A-Z]"
TOP_HEADING, TOP_APPENDIX = r"^\d+\s+[A-Z]", r"^[A-Z]\s+[A-Z]"
CAPTION = r"^(Figure|Fig\.?|Table)\s+[A-Za-z]?\d+\s*[:.\-]\s*.+$"
FULL_HEADINGS = ("ABSTRACT", "REFERENCES", "APPENDIX CONTENTS")
BACK_MATTER = ("references", "bibliography")
CAPTION_LINES, CAPTION_CHARS, CAPTION_FULL_STOP = 4, 320, 50
NOISE = ("appendix contents", "back to appendix table of contents")
RUNNING_HEAD = "published as a conference paper"
INSTITUTIONS = ("university", "institute", "college", "school", "academy", "department", "center", "centre", "hospital", "laboratory", "lab")
VENUE_WORDS = ("proceedings", "conference", "arxiv", "openreview.net", "aclanthology.org")
PROSE_WORDS = ("asking", "considered", "define", "defined", "document", "follows", "query", "question", "relevant", "represented", "sequence", "where")
PANEL_WORDS = ("positive docs", "negative docs", "annotated web pages", "multimodal collections")
MATH = r"[=≤≥≈∑∫√±×÷^_{}]|[α-ωΑ-Ω]"

LINES = "doc string, page int, line int, text string, x_min double, x_max double, y double, font_size double"
BLOCK_FIELDS = ("page_number", "container_section", "subsection_name", "subsection_path", "block_type", "text", "caption", "asset_path", "bbox_pdf", "line_indices", "caption_line_indices", "content_line_indices")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# Predicates on lines and texts; false for null unless stated.


def is_heading(text: Column) -> Column:
    return _heading(squeeze(text))


def _heading(t: Column) -> Column:
    return _sure(t.isin(*FULL_HEADINGS) | t.rlike(HEADING))


def is_top_heading(text: Column, appendix: bool = False) -> Column:
    t = squeeze(text)
    return _sure(t.rlike(TOP_APPENDIX if appendix else TOP_HEADING))


def is_back_matter(text: Column) -> Column:
    return _sure(F.lower(heading_name(text)).isin(*BACK_MATTER))


def is_caption(text: Column) -> Column:
    return _sure(text.rlike("(?i)" + CAPTION))


def names_institution(text: Column) -> Column:
    return _sure(_any(F.lower(text), INSTITUTIONS))


def is_noise(text: Column) -> Column:
    """Blank and null lines, page numbers, running heads and the marks of a table of contents."""
    return _noise(squeeze(text))


def _noise(t: Column) -> Column:
    t = F.lower(t)
    return F.coalesce((t == "") | F.startswith(t, F.lit(RUNNING_HEAD)) | t.isin(*NOISE) | t.rlike(r"^\d+$"), F.lit(True))


def is_visual_artifact(text: Column) -> Column:
    """Text that belongs to a picture: panel words, several labels, or few words with many hyphens."""
    t = F.lower(text)
    labels = F.regexp_count(t, F.lit("task:")) + F.regexp_count(t, F.lit("query:"))
    words = F.regexp_count(text, F.lit(r"(?U)\w+"))
    return _sure(F.contains(t, F.lit("<image")) | _any(t, PANEL_WORDS) | (labels >= 2) | ((F.regexp_count(text, F.lit("-")) >= 2) & (words <= 8)))


def is_equation(text: Column) -> Column:
    """A line that is mostly formula: numbered, or few words with an assignment, a chain of operators, a call or several signs."""
    return _equation(squeeze(text))


def _equation(t: Column) -> Column:
    count = lambda p: F.regexp_count(t, F.lit(p))
    words, signs, digits = count("[A-Za-z]+"), count(MATH), count(r"\d")
    prose = F.exists(F.regexp_extract_all(F.lower(t), F.lit("([a-z]+)"), F.lit(1)), lambda w: w.isin(*PROSE_WORDS)) & (words > 5)
    shape = (
        (t.rlike(r"[A-Za-z0-9_)\]}]\s*=\s*[^=]") & ((signs >= 2) | (digits >= 2))) | t.rlike(r"\d+\s*[+*/^]\s*\d+")
        | (t.rlike(r"[A-Za-z0-9_]+\([^)]*\)") & t.rlike("[=+*/^]") & (words <= 8)) | (t.rlike("[=≤≥≈∑∫√]") & (signs >= 3) & (words <= 6))
    )
    no = (F.length(t) < 4) | _heading(t) | F.contains(F.lower(t), F.lit("<image"))
    return _sure(~no & (t.rlike(r"\(\d+\)$") | ((words <= 10) & ~prose & shape)))


def is_item_noise(text: Column) -> Column:
    """Of a converted document: blank, lone marks, and up to two signs without letter or digit."""
    t = squeeze(text)
    return F.coalesce((t == "") | t.isin("…", ".", ",", ":", ";", "[", "]", "(", ")", "Web", "].") | ((F.length(t) <= 2) & ~t.rlike(r"[\p{L}\p{N}]")), F.lit(True))


def is_references_heading(text: Column) -> Column:
    return _sure(F.upper(squeeze(text)).isin("REFERENCES", "REFERENCE"))


def is_appendix_heading(text: Column) -> Column:
    t = F.upper(squeeze(text))
    return _sure(F.startswith(t, F.lit("APPENDIX")) | t.rlike(r"^[A-Z]\s+[A-Z]"))


def is_visual_child(parent: Column) -> Column:
    return _sure(parent.rlike(r"^cref='#/(pictures|tables)/"))


# Pages.


def page_evidence(lines: DataFrame) -> DataFrame:
    """(doc, page, n_lines, n_url, n_venue, n_author, n_year, is_references): counts of lines that speak for a list of references, and the verdict."""
    kept = lines.withColumn("_t", squeeze(F.col("text"))).where("_t <> ''").withColumn("_k", F.row_number().over(W.partitionBy("doc", "page").orderBy("line")))
    low = F.lower("_t")
    out = kept.groupBy("doc", "page").agg(
        F.count("*").alias("n_lines"), F.count_if(_any(low, ("urlhttp",))).alias("n_url"), F.count_if(_any(low, VENUE_WORDS)).alias("n_venue"),
        F.count_if(F.col("_t").rlike(r"^[A-Z][A-Za-z'`.-]+(?: [A-Z][A-Za-z'`.-]+){0,4}\.") | F.col("_t").rlike(r"^[A-Z][A-Za-z'`.-]+, [A-Z]")).alias("n_author"), F.count_if(F.col("_t").rlike(r"\b20\d{2}\b")).alias("n_year"),
        F.max((F.col("_k") == 1) & F.startswith(low, F.lit("references"))).alias("_first"), F.max((F.col("_k") <= 10) & is_top_heading(F.col("_t"))).alias("_headed"),
    )
    c = F.col
    counted = ((c("n_url") >= 2) & (c("n_venue") >= 3) & (c("n_year") >= 4)) | ((c("n_url") >= 3) & (c("n_author") >= 4))
    return out.withColumn("is_references", c("_first") | (~c("_headed") & counted)).drop("_first", "_headed")


def appendix_start(lines: DataFrame) -> DataFrame:
    """(doc, appendix_page): the first page with the marks of an appendix; documents without one are left out."""
    t = F.lower(squeeze(F.col("text")))
    first5 = F.row_number().over(W.partitionBy("doc", "page").orderBy("line")) <= 5
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_top"), F.struct("line", "text")))), lambda x: x["text"]), " ")
    pages = lines.withColumns({"_top": first5, "_mark": _any(t, NOISE)}).groupBy("doc", "page").agg(F.max("_mark").alias("_mark"), F.upper(top).alias("_head"))
    found = pages.where(_sure(F.col("_mark") | F.startswith("_head", F.lit("APPENDIX")) | F.col("_head").rlike(r"^[A-Z]\s+[A-Z]{4,}")))
    return found.groupBy("doc").agg(F.min("page").alias("appendix_page"))


def without_contents_pages(blocks: DataFrame) -> DataFrame:
    """Blocks of pages that hold no text block 'Appendix Contents'."""
    listed = blocks.where("block_type = 'text' and text = 'Appendix Contents'").select("doc", "page").distinct()
    return blocks.join(listed, ["doc", "page"], "left_anti")


# Lines.


def cleaned_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments with NUL as blank and outer blanks taken off; those without text or place are left out."""
    filled = F.col("text").rlike(r"(?U)[^\s\x00\x1c-\x1f]")
    return fragments.where(filled & F.expr("doc is not null and page is not null and x is not null and y is not null")).withColumn("text", squeeze(F.replace("text", F.lit("\x00"), F.lit(" "))))


def lines_of(fragments: DataFrame, tolerance: float = ROW_TOLERANCE) -> DataFrame:
    """LINES of fragments.

    Fragments go from the top down; one joins a row while it is within the tolerance of the row's
    first fragment, so rows are numbered by one fold over a page's sorted heights. In a row fragments go
    from left to right, with a blank where the gap to the estimated end of the one before exceeds
    max(0.3 font, 4). A line has the height of its leftmost fragment and the mean font size. Ties go by frag.
    """
    font = F.coalesce(F.nullif("font_size", F.lit(0.0)), F.lit(DEFAULT_FONT))
    end = F.col("x") + F.greatest(font * GLYPH * F.greatest(F.length(F.replace(F.col("text"), F.lit(" "))), F.lit(1)), font)
    piece = F.struct((-F.col("y")).alias("down"), "x", "frag", "text", font.alias("font"), F.coalesce("font_size", F.lit(0.0)).alias("size"), end.alias("end"))
    pages = cleaned_fragments(fragments).groupBy("doc", "page").agg(F.sort_array(F.collect_list(piece)).alias("all"))

    def begun(acc: Column, f: Column) -> Column:
        begins = acc["top"].isNull() | (F.abs(f["down"] - acc["top"]) > tolerance)
        return F.struct(F.when(begins, f["down"]).otherwise(acc["top"]).alias("top"), (acc["i"] + 1).alias("i"), F.when(begins, F.concat(acc["at"], F.array(acc["i"]))).otherwise(acc["at"]).alias("at"))

    start = F.struct(F.lit(None).cast("double").alias("top"), F.lit(1).alias("i"), F.array().cast("array<int>").alias("at"))
    row = lambda own: F.sort_array(F.transform(own, lambda f: F.struct(f["x"].alias("x"), f["frag"].alias("frag"), f["down"].alias("down"), f["text"].alias("text"), f["font"].alias("font"), f["size"].alias("size"), f["end"].alias("end"))))
    cut = lambda at: F.transform(at, lambda a, k: row(F.slice("all", a, F.coalesce(F.get(at, k + 1), F.size("all") + 1) - a)))
    rows = F.flatten(F.transform(F.array(F.aggregate("all", start, begun)["at"]), cut))

    def line(own: Column, k: Column) -> Column:
        apart = lambda f, i: (i > 0) & (f["x"] - F.get(own, i - 1)["end"] > F.greatest(f["size"] * WORD_GAP_SHARE, F.lit(LEAST_WORD_GAP)))
        text = F.array_join(F.transform(own, lambda f, i: F.when(apart(f, i), F.concat(F.lit(" "), f["text"])).otherwise(f["text"])), "")
        mean = F.aggregate(own, F.lit(0.0), lambda a, f: a + f["font"]) / F.size(own)
        first = F.get(own, F.lit(0))
        return F.struct(k.alias("line"), text.alias("text"), first["x"].alias("x_min"), F.array_max(own["end"]).alias("x_max"), (-first["down"]).alias("y"), mean.alias("font_size"))

    return pages.select("doc", "page", F.inline(F.transform(rows, line)))


# Sets: all fragments of a page in one row. White space as `squeeze` has it, and NUL.
SET = "struct<frag: array<int>, text: array<string>, x: array<double>, y: array<double>, font_size: array<double>>"
_SET_LINE = pa.struct([("text", pa.string()), ("x_min", pa.float64()), ("x_max", pa.float64()), ("y", pa.float64()), ("font_size", pa.float64())])
_PIECE = pa.struct([("piece", pa.string()), ("doubt", pa.bool_())])
_PIECES = "array<struct<piece: string, doubt: boolean>>"
_WHITE = r"\x{00}\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNTIDY = f"[{_WHITE.replace('{20}', '{1f}')}]|  |^ | $|^$"
_SET_FIELDS, _SET_BYTES = ("frag", "text", "x", "y", "font_size"), 2_000_000


def _above(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a > b as SQL has it, where NaN is above all numbers."""
    return (a > b) | (np.isnan(a) & ~np.isnan(b))


def _same(a: np.ndarray) -> np.ndarray:
    """Which values equal the one before."""
    return (a[1:] == a[:-1]) | (np.isnan(a[1:]) & np.isnan(a[:-1]))


def _rows(page: np.ndarray, down: np.ndarray, tolerance: float) -> np.ndarray:
    """The row of every fragment, counted over all pages; fragments by page and from the top down. The fold goes over distinct heights."""
    new = np.ones(len(down), bool)
    new[1:] = (page[1:] != page[:-1]) | (down[1:] != down[:-1]) | ~np.isfinite(down[1:])
    heights = np.flatnonzero(new)
    begins, last, top = [], -1, 0.0
    for i, p, d in zip(heights.tolist(), page[heights].tolist(), down[heights].tolist()):
        if p != last or not d - top <= tolerance:
            begins.append(i)
            last, top = p, d
    row = np.zeros(len(down), int)
    row[begins] = 1
    return np.cumsum(row) - 1


def _set_in_lines(frag: pa.Array, text: pa.Array, x: pa.Array, y: pa.Array, font_size: pa.Array, tolerance: float) -> pa.Array:
    """Lists of lines of lists of fragments, a list a page, by the rules of `lines_of`."""
    numbers = lambda a, filler: pc.fill_null(pc.cast(a, pa.float64()), filler).to_numpy(zero_copy_only=False)
    n_pages = len(text)
    page = np.repeat(np.arange(n_pages), pc.fill_null(text.value_lengths(), 0).to_numpy(zero_copy_only=False))
    frag, text, x, y, font_size = (a.flatten() for a in (frag, text, x, y, font_size))
    untidy = pc.fill_null(pc.match_substring_regex(text, _UNTIDY), False)
    if pc.any(untidy).as_py():
        text = pc.if_else(untidy, pc.utf8_trim(pc.replace_substring_regex(text, f"[{_WHITE}]+", " "), " "), text)
    kept = pc.and_(pc.and_(x.is_valid(), y.is_valid()), pc.fill_null(pc.not_equal(text, ""), False))
    if not pc.all(kept).as_py():
        page = page[kept.to_numpy(zero_copy_only=False)]
        frag, text, x, y, font_size = (a.filter(kept) for a in (frag, text, x, y, font_size))
    places = np.zeros(n_pages + 1, np.int32)
    if not len(text):
        return pa.ListArray.from_arrays(places, pa.array([], _SET_LINE))
    down, x, frag, size = -numbers(y, np.nan), numbers(x, np.nan), numbers(frag, -np.inf), numbers(font_size, 0.0)
    font = np.where(size == 0, DEFAULT_FONT, size)
    letters = np.maximum(pc.subtract(pc.utf8_length(text), pc.count_substring(text, " ")).to_numpy(zero_copy_only=False), 1)
    end = x + np.maximum(font * GLYPH * letters, font)

    fall = np.lexsort((down, page))
    row = np.empty(len(down), int)
    row[fall] = _rows(page[fall], down[fall], tolerance)
    order = np.lexsort((frag, x, row))
    if (_same(row[order]) & _same(x[order]) & _same(frag[order])).any():
        order = np.lexsort((end, size, font, pc.rank(text, tiebreaker="dense").to_numpy(zero_copy_only=False), down, frag, x, row))
    down, x, size, font, end, row, text = down[order], x[order], size[order], font[order], end[order], row[order], text.take(pa.array(order))

    starts = np.flatnonzero(np.diff(row, prepend=-1))
    apart = np.zeros(len(row), bool)
    apart[1:] = _above(x[1:] - end[:-1], np.maximum(size[1:] * WORD_GAP_SHARE, LEAST_WORD_GAP))
    apart[starts] = False
    pieces = pc.binary_join_element_wise(pc.if_else(pa.array(apart), " ", ""), text, "")
    lengths = np.diff(np.append(starts, len(row)))
    lines = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()), pieces)
    mean = np.bincount(row, weights=font) / lengths
    own = pa.StructArray.from_arrays([pc.binary_join(lines, ""), pa.array(x[starts]), pa.array(np.maximum.reduceat(end, starts)), pa.array(-down[starts]), pa.array(mean)], fields=list(_SET_LINE))
    places[1:] = np.cumsum(np.bincount(page[order][starts], minlength=n_pages))
    return pa.ListArray.from_arrays(places, own)


def in_parts(f: Callable[..., pa.Array], texts: pa.Array, *columns: pa.Array) -> pa.Array:
    """f of columns of lists, over runs of rows with some 2 MB of texts (or one row) at a time, so that no batch needs much memory."""
    upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts.flatten()), 0).to_numpy(zero_copy_only=False), dtype=int)])
    part = upto[np.cumsum(pc.fill_null(texts.value_lengths(), 0).to_numpy(zero_copy_only=False))] // _SET_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return pa.concat_arrays([f(*[c.slice(a, b - a) for c in columns]) for a, b in zip(cuts, cuts[1:])])


def set_pages(fragments: DataFrame) -> DataFrame:
    """(doc, page, set): the fragments of every page as SET, in no order."""
    piece = F.struct("frag", "text", *[F.col(n).cast("double").alias(n) for n in _SET_FIELDS[2:]])
    pages = fragments.where("doc is not null and page is not null").groupBy("doc", "page").agg(F.collect_list(piece).alias("all"))
    return pages.select("doc", "page", F.struct(*[F.col("all")[n].alias(n) for n in _SET_FIELDS]).alias("set"))


def line_box(prefix: str = "") -> dict[str, Column]:
    """The box of a line, from its ends, height and font size."""
    c = lambda n: F.col(prefix + n)
    return {"x0": c("x_min"), "y0": F.greatest(c("y") - 2.0, F.lit(0.0)), "x1": c("x_max"), "y1": c("y") + F.greatest(F.coalesce(c("font_size"), F.lit(DEFAULT_FONT)), F.lit(DEFAULT_FONT))}


def merged_boxes(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, x0, y0, x1, y1): the box around all boxes of a group."""
    return rows.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def blocks_of(lines: DataFrame, gap: float = BLOCK_GAP, used: Column | None = None, by: tuple[str, ...] = ("doc", "page")) -> DataFrame:
    """lines with `block`: a new block begins at a heading, after one, at a used line and at a vertical gap above `gap`."""
    used = F.lit(False) if used is None else used
    order = W.partitionBy(*by).orderBy("line")
    head = is_heading(F.col("text"))
    starts = F.col("_h") | F.col("_u") | F.coalesce(F.lag("_h").over(order), F.lit(True)) | F.coalesce(F.lag("_u").over(order), F.lit(False)) | (F.lag("y").over(order) - F.col("y") > gap)
    marked = lines.withColumns({"_h": head, "_u": used}).withColumn("_s", F.coalesce(starts, F.lit(True)).cast("int"))
    return marked.withColumn("block", F.sum("_s").over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int") - 1).drop("_h", "_u", "_s")


def _reach(stop: np.ndarray, gap: np.ndarray, first: float, later: float) -> int:
    """How many of the following lines belong on: up to a stop or a gap above the limit (another one for the first line)."""
    limit = np.full(len(gap), later)
    limit[:1] = first
    ends = np.flatnonzero(stop | (gap > limit))
    return int(ends[0]) if len(ends) else len(stop)


def _caption_groups(text: list, head: np.ndarray, cap: np.ndarray, x: np.ndarray, y: np.ndarray, gap: float) -> dict[int, int]:
    """First line -> number of lines of every caption of a page."""
    groups, free = {}, 0
    for start in np.flatnonzero(cap).tolist():
        if start < free:
            continue
        after = slice(start + 1, start + CAPTION_LINES)
        stop = head[after] | cap[after]
        if text[start].lower().startswith("table"):
            stop = stop | (np.abs(x[after] - x[start]) > TABLE_INDENT)
        n = 1 + _reach(stop, np.abs(y[start : start + CAPTION_LINES - 1][: len(stop)] - y[after]), gap, gap)
        sizes = np.cumsum([len(t) + 1 for t in text[start : start + n]]) - 1
        full = [k for k in range(1, n) if sizes[k] >= CAPTION_CHARS or (text[start + k].endswith(".") and sizes[k] > CAPTION_FULL_STOP)]
        groups[start] = min(n, full[0] + 1) if full else n
        free = start + groups[start]
    return groups


def captions(lines: DataFrame, gap: float = BLOCK_GAP) -> DataFrame:
    """(doc, page, line, caption, n_lines): captions from their first line on, until another caption or a heading, a gap, four lines, 320 characters, a full stop after 50 characters, or (tables) an indent."""
    marked = lines.where("text is not null").select("doc", "page", "line", "text", "y", *(["x_min"] if "x_min" in lines.columns else [F.lit(0.0).alias("x_min")]), is_heading(F.col("text")).alias("_head"), is_caption(F.col("text")).alias("_cap"))

    def run(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values("line")
        text = page["text"].tolist()
        found = _caption_groups(text, page["_head"].to_numpy(bool), page["_cap"].to_numpy(bool), page["x_min"].to_numpy(float), page["y"].to_numpy(float), gap)
        rows = [(page["doc"].iloc[0], page["page"].iloc[0], int(page["line"].iloc[i]), " ".join(text[i : i + n]), n) for i, n in found.items()]
        return pd.DataFrame(rows, columns=["doc", "page", "line", "caption", "n_lines"])

    return marked.groupBy("doc", "page").applyInPandas(run, "doc string, page int, line int, caption string, n_lines int")


STRUCTURE = "doc string, page int, kind string, head int, caption_lines array<int>, content_lines array<int>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("head", pa.int32()), ("caption", pa.list_(pa.int32())), ("content", pa.list_(pa.int32()))]))
_PLAIN = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
_PARTS = "struct<found: array<struct<kind: string, head: int, caption: array<int>, content: array<int>>>, plain: array<struct<at: int, n: int>>>"


def _found(text: list, head: np.ndarray, cap: np.ndarray, noise: np.ndarray, eq: np.ndarray, x: np.ndarray, wide: np.ndarray, y: np.ndarray, gap: float) -> tuple[list[dict], np.ndarray]:
    """Figures, tables and equations of a page by the places of their lines, and which lines they use. text is read only where there are captions."""
    groups, stop, out = _caption_groups(text, head, cap, x, y, gap) if cap.any() else {}, head | cap, []
    taken = np.zeros(len(head), bool)
    for start, n in groups.items():
        taken[start : start + n] = True
    for start, n in groups.items():
        table = text[start].lower().startswith("table")
        if table:
            below = np.arange(start + n, len(text))
            content = below[: _reach(stop[below] | taken[below], y[below - 1] - y[below], np.inf, TABLE_GAP)]
            taken[content] = True
        else:
            above = np.arange(start - 1, -1, -1)
            above = above[: _reach(stop[above], np.zeros(len(above)), np.inf, np.inf)]
            above = above[~(noise[above] | wide[above])]
            content = above[: _reach(np.zeros(len(above), bool), y[above] - np.concatenate([[y[start]], y[above[:-1]]]) if len(above) else y[above], FIGURE_FIRST_GAP, FIGURE_GAP)][::-1]
        out.append({"kind": "table" if table else "figure", "head": start, "caption": list(range(start, start + n)), "content": content.tolist()})
    formula = np.flatnonzero(eq & ~taken)
    if len(formula):
        apart = (np.diff(formula) > 1) | (y[formula[:-1]] - y[formula[1:]] > gap)
        for own in np.split(formula, np.flatnonzero(apart) + 1):
            out.append({"kind": "equation", "head": int(own[0]), "caption": [], "content": own.tolist()})
        taken[formula] = True
    return out, taken


def _split(begin: np.ndarray, y: np.ndarray, x_min: np.ndarray, x_max: np.ndarray, mark: np.ndarray, text: Callable[[int], list], gap: float) -> tuple[list[list[dict]], np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines of many pages, a page beginning at each place of `begin` (none is empty): what is found on every page, the first lines and lengths of all runs, and which lines are no text. text: the lines of a page."""
    head, cap, noise, eq, used = ((mark & (1 << k)) != 0 for k in range(5))
    found: list[list[dict]] = [[] for _ in begin[1:]]
    for k in np.unique(np.searchsorted(begin, np.flatnonzero(cap | eq), "right") - 1).tolist():
        own = slice(begin[k], begin[k + 1])
        found[k], taken = _found(text(k), head[own], cap[own], noise[own], eq[own], x_min[own], x_max[own] > 2000, y[own], gap)
        used[own] |= taken
    alone = head | used
    starts = np.ones(len(y), bool)
    starts[1:] = alone[1:] | alone[:-1] | ~(y[:-1] - y[1:] <= gap)
    starts[begin[:-1]] = True
    starts = np.flatnonzero(starts)
    return found, starts, np.diff(np.append(starts, len(y))), used


def _parted(pages: DataFrame, gap: float) -> DataFrame:
    """pages (`all`: lines by number) with `parts`: what is found on a page, and the runs of its other lines that are text blocks; lines by their places from 0.

    Only numbers and marks go to Python, texts only of pages with a caption.
    """

    def run(y: pa.Array, x_min: pa.Array, x_max: pa.Array, marks: pa.Array, text: pa.Array) -> pa.Array:
        flat = lambda a: pc.fill_null(a.flatten(), float("nan")).to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
        found, starts, n, used = _split(begin, flat(y), flat(x_min), flat(x_max), marks.flatten().to_numpy(zero_copy_only=False), lambda k: text[k].as_py(), gap)
        kept = ~used[starts]
        starts, n = starts[kept], n[kept]
        page = np.searchsorted(begin, starts, "right") - 1
        runs = pa.StructArray.from_arrays([pa.array(starts - begin[page], pa.int32()), pa.array(n, pa.int32())], fields=list(_PLAIN.value_type))
        plain = pa.ListArray.from_arrays(pa.array(np.searchsorted(page, np.arange(len(marks) + 1)), pa.int32()), runs)
        return pa.StructArray.from_arrays([pa.array(found, _FOUND), plain], ["found", "plain"])

    text = F.when(F.exists("all.marks", lambda m: m.bitwiseAND(2) != 0), F.col("all.text"))
    return pages.withColumn("parts", F.arrow_udf(run, _PARTS)("all.y", "all.x_min", "all.x_max", "all.marks", text))


def _pages(lines: DataFrame, gap: float) -> DataFrame:
    """(doc, page, all, parts) of lines with a text."""
    c = F.col

    def marked(t: Column) -> Column:
        kinds = [_heading(t), is_caption(c("text")), _noise(t), _equation(t), t == ""]
        return sum((F.when(kind, 1 << k).otherwise(0) for k, kind in enumerate(kinds)), F.lit(0))

    marks = F.get(F.transform(F.array(squeeze(c("text"))), marked), F.lit(0))  # the squeezed text is made once
    line = F.struct("line", "text", *[c(n).cast("double").alias(n) for n in ("x_min", "x_max", "y")], marks.alias("marks"), *[box.alias(n) for n, box in line_box().items() if n in ("y0", "y1")])
    return _parted(lines.where("text is not null").groupBy("doc", "page").agg(F.sort_array(F.collect_list(line)).alias("all")), gap)


def page_structure(lines: DataFrame, gap: float = BLOCK_GAP) -> DataFrame:
    """STRUCTURE: the figures, tables and equations of every page, as the numbers of their lines; head is their first line in reading order.

    A table takes the lines below its caption, a figure those above it (noise in between is passed over), an
    equation the formulas that follow each other; each until a caption, a heading or a gap.
    """
    number = lambda i: F.get("all.line", i)
    found = F.transform("parts.found", lambda s: F.struct(s["kind"].alias("kind"), number(s["head"]).alias("head"), F.transform(s["caption"], number).alias("caption_lines"), F.transform(s["content"], number).alias("content_lines")))
    return _pages(lines, gap).select("doc", "page", F.inline(found))


def page_blocks(lines: DataFrame, gap: float = BLOCK_GAP) -> DataFrame:
    """(doc, page, block, block_type, y, text, caption, x0, y0, x1, y1): all blocks of every page from the top down, headings before others of one height.

    Lines of captions, tables and equations are no text; the lines that a figure takes stay text as well. Noise and
    artifacts of pictures are left out. Lines are brought together by page once, without joins; the rest runs over a page's array.
    """
    none = F.lit(None).cast("string")
    box = lambda own: [F.array_min(own["x_min"]).alias("x0"), F.array_min(own["y0"]).alias("y0"), F.array_max(own["x_max"]).alias("x1"), F.array_max(own["y1"]).alias("y1")]
    of = lambda places: F.transform(places, lambda i: F.get("all", i))
    content = lambda s: F.when(s["kind"] != "figure", s["content"]).otherwise(F.array().cast("array<int>"))
    found = F.transform("parts.found", lambda s: F.struct(s["kind"].alias("kind"), of(s["caption"]).alias("caption"), of(content(s)).alias("content")))

    def visual(s: Column) -> Column:
        own = F.concat(s["caption"], s["content"])
        return F.struct(
            s["kind"].alias("block_type"), F.when(s["kind"] == "equation", F.array_max(own["y"])).otherwise(F.array_max(own["y1"])).alias("y"),
            F.nullif(F.array_join(s["content"]["text"], "\n"), F.lit("")).alias("text"), F.nullif(squeeze(F.array_join(s["caption"]["text"], " ")), F.lit("")).alias("caption"), *box(own), F.size(own).alias("n"),
        )

    def plain(own: Column) -> Column:
        return F.struct(none.alias("block_type"), F.array_max(own["y"]).alias("y"), squeeze(F.array_join(own["text"], " ")).alias("text"), none.alias("caption"), *box(own), F.size(own).alias("n"))

    runs = F.transform("parts.plain", lambda p: F.slice("all", p["at"] + 1, p["n"]))
    blocks = _pages(lines, gap).select("doc", "page", F.inline(F.concat(F.transform(runs, plain), F.transform(found, visual))))
    heading = (F.col("n") == 1) & _heading(F.col("text"))
    blocks = blocks.where(F.col("block_type").isNotNull() | (~_noise(F.col("text")) & (heading | ~is_visual_artifact(F.col("text")))))
    blocks = blocks.withColumn("block_type", F.coalesce("block_type", F.when(heading, "heading").otherwise("text")))
    order = W.partitionBy("doc", "page").orderBy(F.col("y").desc(), F.when(F.col("block_type") == "heading", 0).otherwise(1), "x0", "block_type", "text", "caption", "y0", "x1", "y1")
    return blocks.withColumn("block", F.row_number().over(order)).select("doc", "page", "block_type", "y", "text", "caption", "x0", "y0", "x1", "y1", "block")


# Sections.


def filled_sections(blocks: DataFrame, by: str, order: list[str], heading: Column, stop: Column) -> DataFrame:
    """Blocks with the latest heading before them as `section`; those before the first heading and after `stop` are left out."""
    w = W.partitionBy(by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = blocks.withColumns({"section": F.last(heading, ignorenulls=True).over(w), "_stop": F.max(F.coalesce(stop, F.lit(False)).cast("int")).over(w)})
    return out.where("section is not null and _stop = 0").drop("_stop")


def numbered_repeats(df: DataFrame, by: list[str], path: str, order: list[str]) -> DataFrame:
    """`path` with ' (k)' from its second occurrence on, as `path_unique`."""
    k = F.row_number().over(W.partitionBy(*by, path).orderBy(*order))
    return df.withColumn("_k", k).withColumn("path_unique", F.when(F.col("_k") > 1, F.concat(F.col(path), F.lit(" ("), F.col("_k").cast("string"), F.lit(")"))).otherwise(F.col(path))).drop("_k")


def sectioned_items(items: DataFrame) -> DataFrame:
    """(doc, container, section_no, heading, start_page, end_page, n_items) of the items of converted documents (doc, pos, page, kind, text, parent).

    kind is header, text, list, picture, table or formula. A header opens a section, in the appendix from the first
    header of one on; the references and what follows them in the main text are left out, as are items before the
    first section, noise and children of pictures and tables. Running flags over one window per document.
    """
    seen = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = items.where(~is_visual_child(F.col("parent")) | F.col("kind").isin("picture", "table"))
    header = F.col("kind") == "header"
    flagged = rows.withColumns({"_r": header & is_references_heading(F.col("text")), "_a": header & is_appendix_heading(F.col("text"))})
    state = flagged.withColumns({"_late": F.max("_a").over(seen), "_ref": F.max("_r").over(seen)}).where(F.col("_late") | ~F.col("_ref")).where(~F.col("_r"))
    numbered = state.withColumn("section_no", F.sum(header.cast("int")).over(seen)).where("section_no > 0").where(header | ~F.col("kind").isin("text", "list") | ~is_item_noise(F.col("text")))
    return numbered.groupBy("doc", "section_no").agg(
        F.max(F.when(F.col("_late"), "appendix").otherwise("maintext")).alias("container"), F.max(F.when(header, squeeze(F.col("text")))).alias("heading"), F.min("page").alias("start_page"), F.max("page").alias("end_page"), F.count("*").alias("n_items")
    )


def numbered_assets(items: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(doc, pos, asset) of pictures and tables: 'page_003_figure_02', counted per page and kind. kinds: item kind -> word."""
    words = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    page = F.coalesce("page", F.lit(0))
    k = F.row_number().over(W.partitionBy("doc", page, "kind").orderBy("pos"))
    return items.where(F.col("kind").isin(*kinds)).withColumn("_k", k).select("doc", "pos", F.format_string("page_%03d_%s_%02d", page, words[F.col("kind")], F.col("_k")).alias("asset"))


def document_metadata(lines: DataFrame) -> DataFrame:
    """(doc, title, authors, institutions, abstract) from the first page.

    The title is the run of up to four leading lines in capitals; between it and the abstract stand authors
    (two words or more in small letters) and institutions; the abstract goes to the first numbered heading. One
    page of a document is folded to an array, so this is one row per document.
    """
    t = squeeze(F.col("text"))
    first = lines.where("page = 1").withColumn("_t", t).where("_t <> ''").groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "_t"))), lambda r: r["_t"]).alias("a"))
    head = F.startswith(F.lower(F.get("a", F.lit(0))), F.lit(RUNNING_HEAD))
    a = first.withColumn("a", F.when(head, F.slice("a", 2, 1_000_000_000)).otherwise(F.col("a")))
    letters = lambda s: F.length(F.regexp_replace(s, r"\P{L}", ""))
    capitals = lambda s: F.length(F.regexp_replace(s, r"\P{Lu}", ""))
    lone = lambda s: F.size(F.filter(F.split(s, " "), lambda w: w.rlike(r"^\p{Lu}$")))
    plain = lambda s: (F.upper(s) != "ABSTRACT") & ~s.rlike(r"[∗*]") & (lone(s) < 3) & (letters(s) > 0) & (capitals(s) >= 0.7 * letters(s))
    flags = F.transform("a", plain)
    run = F.least(F.coalesce(F.nullif(F.array_position(flags, F.lit(False)), F.lit(0)) - 1, F.size("a")), F.lit(4)).cast("int")
    at = lambda test: F.nullif(F.array_position(F.transform("a", test), F.lit(True)), F.lit(0)).cast("int")
    marked = a.withColumns({"n": run, "abstract_at": at(lambda s: F.upper(s) == "ABSTRACT"), "intro_at": at(lambda s: is_top_heading(s))})
    between = F.when(F.col("abstract_at").isNotNull(), F.slice("a", F.col("n") + 1, F.greatest(F.col("abstract_at") - 1 - F.col("n"), F.lit(0)))).otherwise(F.array().cast("array<string>"))
    body = F.when(F.col("abstract_at").isNotNull() & (F.col("intro_at") > 1), F.slice("a", F.col("abstract_at") + 1, F.greatest(F.col("intro_at") - 1 - F.col("abstract_at"), F.lit(0)))).otherwise(F.array().cast("array<string>"))
    small = lambda s: F.size(F.filter(F.split(s, " "), lambda w: w.rlike("[a-z]")))
    return marked.select(
        "doc", joined_lines(F.slice("a", 1, F.col("n"))).alias("title"), F.filter(between, lambda s: ~names_institution(s) & (small(s) >= 2)).alias("authors"), F.filter(between, names_institution).alias("institutions"), joined_lines(body).alias("abstract")
    )


# Runs and boxes.


def runs(df: DataFrame, by: list[str], pos: str, count: Column, least: int, gap: int) -> DataFrame:
    """(by, run_start, run_end): runs of positions with count >= least; up to `gap` others in between are bridged."""
    w = W.partitionBy(*by).orderBy(pos)
    kept = df.where(count >= least).withColumn("_new", F.coalesce((F.col(pos) - F.lag(pos).over(w) > gap + 1).cast("int"), F.lit(1)))
    numbered = kept.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_run").agg(F.min(pos).alias("run_start"), F.max(pos).alias("run_end")).drop("_run")


def run_nearest_edge(found: DataFrame, by: list[str], from_start: bool, least_span: int) -> DataFrame:
    """(by, run_start, run_end): of the runs of at least the span the first, or the one that ends last."""
    wide = found.where(F.col("run_end") - F.col("run_start") >= least_span)
    pick = F.min_by if from_start else F.max_by
    edge = F.struct("run_start", "run_end") if from_start else F.struct("run_end", "run_start")
    return wide.groupBy(*by).agg(pick(F.struct("run_start", "run_end"), edge).alias("r")).select(*by, "r.*")


def line_runs(lines: Column, full: int, gap: int) -> Column:
    """array<struct<run_start, run_end>> of an array of lines: runs of lines with at least `full` characters, up to `gap` others bridged. No shuffle."""
    places = F.filter(F.transform(lines, lambda line, i: F.when(F.length(line) >= full, i)), lambda i: i.isNotNull())
    ends = lambda far: F.transform(places, lambda p, k: F.when(F.coalesce(far(p, k) > gap + 1, F.lit(True)), p))
    kept = lambda xs: F.filter(xs, lambda p: p.isNotNull())
    starts = kept(ends(lambda p, k: p - F.get(places, k - 1)))
    stops = kept(ends(lambda p, k: F.get(places, k + 1) - p))
    return F.transform(starts, lambda s, k: F.struct(s.alias("run_start"), F.get(stops, k).alias("run_end")))


def line_sections(lines: Column, mark: str, stop: str) -> Column:
    """array<struct<heading, n_lines>> of an array of lines: lines from each heading (starting with `mark`) on, up to the line `stop`; one entry per heading as it comes. No shuffle."""
    end = F.array_position(lines, F.lit(stop)).cast("int")
    kept = F.when(end > 0, F.slice(lines, F.lit(1), end - 1)).otherwise(lines)
    heads = F.filter(F.transform(kept, lambda line, i: F.when(F.startswith(line, F.lit(mark)), i)), lambda i: i.isNotNull())
    return F.transform(heads, lambda i, k: F.struct(F.get(kept, i).substr(F.lit(len(mark) + 1), F.length(F.get(kept, i))).alias("heading"), (F.coalesce(F.get(heads, k + 1), F.size(kept)) - i).alias("n_lines")))


def overlap_share(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Share of box a (of at least one unit of area) that box b covers; boxes are x0, y0, x1, y1."""
    wide = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    high = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = F.greatest(F.lit(0.0), a["x1"] - a["x0"]) * F.greatest(F.lit(0.0), a["y1"] - a["y0"])
    return wide * high / F.greatest(area, F.lit(1.0))


def clear_of(boxes: DataFrame, regions: DataFrame, on: list[str], most: float = OVERLAP) -> DataFrame:
    """Boxes that no region of the same page covers by `most` or more."""
    cols = lambda t: {k: F.col(f"{t}.{k}") for k in ("x0", "y0", "x1", "y1")}
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    cond = overlap_share(cols("a"), cols("b")) >= most
    for s in same:
        cond = s & cond
    return boxes.alias("a").join(regions.alias("b"), cond, "left_anti")


def with_regions(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Blocks and regions in one table: on pages with regions, figures and tables that were guessed and blocks that a region covers give way to them."""
    paged = regions.select("doc", "page").distinct()
    guessed = blocks.where("block_type in ('figure', 'table')").join(paged, ["doc", "page"], "left_anti")
    kept = clear_of(blocks.where("block_type not in ('figure', 'table')"), regions, ["doc", "page"])
    return kept.unionByName(guessed).unionByName(regions, allowMissingColumns=True)


def regions_in(records: DataFrame, item: str, heights: DataFrame) -> DataFrame:
    """(doc, page, block_type, caption, x0, y0, x1, y1) of raw region records (doc, variant `item`), measured from the top, for pages (doc, page, height).

    A box is given by two corners or by left, top, width and height, under one of several names; records
    without a box or of no known page are left out.
    """
    get = lambda *paths, kind="string": F.coalesce(*[F.try_variant_get(item, p, kind) for p in paths])
    box = lambda name: F.coalesce(*[F.try_variant_get(item, f"$.{outer}.{name}", "double") for outer in ("regionBoundary", "figureBoundary", "boundary")])
    raw = records.select(
        "doc", get("$.page", "$.pageNumber", kind="int").alias("page"), F.when(F.contains(F.lower(F.coalesce(get("$.figureType", "$.type"), F.lit("figure"))), F.lit("table")), "table").otherwise("figure").alias("block_type"),
        squeeze(F.coalesce(get("$.caption", "$.captionText", "$.name"), F.lit(""))).alias("caption"), *[box(n).alias("_" + n) for n in ("x1", "y1", "x2", "y2", "left", "top", "width", "height")],
    )
    c = F.col
    corners = c("_x1").isNotNull() & c("_y1").isNotNull() & c("_x2").isNotNull() & c("_y2").isNotNull()
    pick = lambda a, b: F.when(corners, a).otherwise(b)
    down = raw.select("doc", "page", "block_type", "caption", pick(F.least("_x1", "_x2"), c("_left")).alias("x0"), pick(F.greatest("_x1", "_x2"), c("_left") + c("_width")).alias("x1"), pick(F.least("_y1", "_y2"), c("_top")).alias("_t"), pick(F.greatest("_y1", "_y2"), c("_top") + c("_height")).alias("_b"))
    return down.join(heights, ["doc", "page"]).where("x0 is not null and x1 is not null and _t is not null and _b is not null").select("doc", "page", "block_type", "caption", "x0", (c("height") - c("_b")).alias("y0"), "x1", (c("height") - c("_t")).alias("y1"))


def vertical_limits(blocks: DataFrame, height: float) -> DataFrame:
    """blocks with upper_limit and lower_limit: the nearest edges of the blocks with a box before and after each on its page, within the page's margins."""
    order = W.partitionBy("doc", "page").orderBy("block")
    before, after = F.last("y0", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)), F.first("y1", ignorenulls=True).over(order.rowsBetween(1, W.unboundedFollowing))
    return blocks.withColumns({"upper_limit": F.least(F.lit(height - PAGE_MARGIN), before), "lower_limit": F.greatest(F.lit(PAGE_MARGIN), after)})


def pixel_box(box: dict[str, Column], page: tuple[float, float], image: tuple[int, int]) -> dict[str, Column]:
    """A box in pixels from the top left, rounded half to even and kept within the image."""
    (wide, high), (px, py) = page, image
    clip = lambda v, most: F.greatest(F.lit(0), F.least(F.lit(most), F.bround(v).cast("int")))
    x = [clip(box[k] / wide * px, px) for k in ("x0", "x1")]
    y = [clip((high - box[k]) / high * py, py) for k in ("y0", "y1")]
    return {"x0": F.least(*x), "y0": F.least(*y), "x1": F.greatest(*x), "y1": F.greatest(*y)}


def expanded_box(box: dict[str, Column], page: tuple[float, float], left: float = 0.0, bottom: float = 0.0, right: float = 0.0, top: float = 0.0) -> dict[str, Column]:
    """A box with margins, kept within the page."""
    return {"x0": F.greatest(F.lit(0.0), box["x0"] - left), "y0": F.greatest(F.lit(0.0), box["y0"] - bottom), "x1": F.least(F.lit(page[0]), box["x1"] + right), "y1": F.least(F.lit(page[1]), box["y1"] + top)}


def caption_column(x0: Column, x1: Column, wide: float) -> tuple[Column, Column]:
    """(left, right) of the column that a caption stands in: the whole width, or the half its middle lies in."""
    middle = wide / 2
    across = (x1 - x0 >= wide * WIDE_CAPTION) | ((x0 <= middle - GUTTER) & (x1 >= middle + GUTTER))
    on_left = (x0 + x1) / 2 < middle
    return F.when(across | on_left, COLUMN_MARGIN).otherwise(middle + GUTTER), F.when(across | ~on_left, wide - COLUMN_MARGIN).otherwise(middle - GUTTER)


def block_payload(blocks: DataFrame) -> DataFrame:
    """The fields of blocks that are handed on, as far as there are any."""
    return blocks.select(*[c for c in BLOCK_FIELDS if c in blocks.columns])


def markdown(blocks: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """(by, markdown): headings and texts of blocks in order, parted by blank lines."""
    piece = F.when(is_heading(F.col("text")), F.concat(F.lit("## "), F.col("text"))).otherwise(F.col("text"))
    pieces = F.array_sort(F.collect_list(F.struct(*order, piece.alias("piece"))))
    return blocks.where("text is not null").groupBy(*by).agg(F.array_join(F.transform(pieces, lambda x: x["piece"]), "\n\n").alias("markdown"))


def _has(text: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(text, pattern).to_numpy(zero_copy_only=False)


def _count(text: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(text, pattern).to_numpy(zero_copy_only=False)


def _low(text: pa.Array) -> pa.Array:
    """Small letters as Spark makes them, as far as they can make ASCII letters."""
    return pc.utf8_lower(pc.replace_substring(text, "\u0130", "i\u0307"))


def _in(text: pa.Array, words: tuple[str, ...]) -> np.ndarray:
    return pc.is_in(text, pa.array(words)).to_numpy(zero_copy_only=False)


# The predicates on lines for squeezed texts, in Arrow's pattern language (whose \s and (?i) are others than Java's; here blanks are the only white space).
_ARROW_CAPTION = r"^([Ff][Ii][Gg][Uu][Rr][Ee]|[Ff][Ii][Gg]\.?|[Tt][Aa][Bb][Ll][Ee]) +[A-Za-z]?[0-9]+ *[:.\-] *.+$"
_ARROW_SHAPES = (r"[A-Za-z0-9_)\]}] *= *[^=]", r"[0-9]+ *[+*/^] *[0-9]+", r"[A-Za-z0-9_]+\([^)]*\)", "[=+*/^]", "[=≤≥≈∑∫√]")


def _heads(text: pa.Array) -> np.ndarray:
    return _in(text, FULL_HEADINGS) | _has(text, HEADING.replace(r"\s", " "))


def _noises(text: pa.Array, low: pa.Array) -> np.ndarray:
    return pc.equal(text, "").to_numpy(zero_copy_only=False) | pc.starts_with(low, RUNNING_HEAD).to_numpy(zero_copy_only=False) | _in(low, NOISE) | _has(text, "^[0-9]+$")


def _equations(text: pa.Array, low: pa.Array, head: np.ndarray) -> np.ndarray:
    """`is_equation`; what is costly is looked up only in lines with a sign of operation."""
    out = _has(text, r"\([0-9]+\)$")
    signed = np.flatnonzero(_has(text, "[=≤≥≈∑∫√+*/^]") & ~out)
    t, small = text.take(pa.array(signed)), low.take(pa.array(signed))
    words, signs, digits = _count(t, "[A-Za-z]+"), _count(t, MATH), _count(t, "[0-9]")
    prose = _has(small, "(?:^|[^a-z])(?:" + "|".join(PROSE_WORDS) + ")(?:$|[^a-z])") & (words > 5)
    assigned, chained, called, operated, signal = (_has(t, p) for p in _ARROW_SHAPES)
    shape = (assigned & ((signs >= 2) | (digits >= 2))) | chained | (called & operated & (words <= 8)) | (signal & (signs >= 3) & (words <= 6))
    out[signed] = (words <= 10) & ~prose & shape
    return out & (pc.utf8_length(text).to_numpy(zero_copy_only=False) >= 4) & ~head & ~pc.match_substring(low, "<image").to_numpy(zero_copy_only=False)


def _artifacts(text: pa.Array, low: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What is surely `is_visual_artifact`, and what is if it has eight words at most (which is certain not to be where nine ASCII words end at blanks)."""
    sure = _has(low, "|".join(("<image", *PANEL_WORDS))) | (_count(low, "task:|query:") >= 2)
    return sure, (_count(text, "-") >= 2) & (_count(text, "[A-Za-z0-9_] ") < 9)


def _pieces(lines: pa.Array, gap: float) -> pa.Array:
    """The pieces of `markdown` of lists of lines, a list a page, in order; doubt: to be left out if it has eight words at most."""
    n_pages, n_lines = len(lines), lines.value_lengths().to_numpy(zero_copy_only=False)
    flat = lines.flatten()
    text, x_min, x_max, y, font = (flat.field(k) for k in range(5))
    places = np.zeros(n_pages + 1, np.int32)
    if not len(flat):
        return pa.ListArray.from_arrays(places, pa.array([], _PIECE))
    x_min, x_max, y, font = (a.to_numpy(zero_copy_only=False) for a in (x_min, x_max, y, font))
    low_edge, high_edge = np.maximum(y - 2.0, 0.0), y + np.maximum(font, DEFAULT_FONT)
    low, head = _low(text), _heads(text)
    noise = _noises(text, low)
    kinds = [head, _has(text, _ARROW_CAPTION), noise, _equations(text, low, head), np.zeros(len(head), bool)]
    mark = sum(kind.astype(int) << k for k, kind in enumerate(kinds))
    filled = np.flatnonzero(n_lines)
    begin = np.concatenate([[0], np.cumsum(n_lines[filled])]).astype(int)
    found, starts, n, used = _split(begin, y, x_min, x_max, mark, lambda k: text.slice(begin[k], begin[k + 1] - begin[k]).to_pylist(), gap)

    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(y)), pa.int32()), text), " ")
    low, head = _low(joined), _heads(joined)
    sure, doubt = _artifacts(joined, low)
    heading = head & (n == 1)
    kept = ~used[starts] & ~_noises(joined, low) & (heading | ~sure)
    page = filled[np.searchsorted(begin, starts, "right") - 1][kept]
    reach = [f.reduceat(a, starts)[kept] for f, a in ((np.maximum, y), (np.fmin, x_min), (np.fmin, low_edge), (np.maximum, x_max), (np.maximum, high_edge))]
    texts, kind, caption = joined.filter(pa.array(kept)), np.where(heading[kept], "heading", "text"), pa.nulls(int(kept.sum()), pa.string())
    head, doubt = head[kept], (doubt & ~heading)[kept]

    visual = []
    for k in [k for k, own in enumerate(found) if own]:
        for s in found[k]:
            if s["kind"] != "figure" and s["content"]:
                own = begin[k] + np.array(s["caption"] + s["content"])
                top = y if s["kind"] == "equation" else high_edge
                taken = [text[int(begin[k] + i)].as_py() for i in s["caption"] + s["content"]]
                cut = len(s["caption"])
                visual.append((filled[k], [top[own].max(), np.fmin.reduce(x_min[own]), np.fmin.reduce(low_edge[own]), x_max[own].max(), high_edge[own].max()], s["kind"], "\n".join(taken[cut:]), " ".join(taken[:cut]) or None))
    if visual:
        pages, reaches, kinds, own, captions_ = zip(*visual)
        page, kind = np.concatenate([page, pages]), np.concatenate([kind, kinds])
        reach = [np.concatenate([a, b]) for a, b in zip(reach, np.array(reaches).T)]
        more = pa.array(own, pa.string())
        texts, caption = pa.concat_arrays([texts, more]), pa.concat_arrays([caption, pa.array(captions_, pa.string())])
        head, doubt = np.concatenate([head, _heads(pc.replace_substring(more, "\n", " "))]), np.concatenate([doubt, np.zeros(len(own), bool)])

    top, x0, y0, x1, y1 = reach
    keys = (x0, kind != "heading", -top, ~np.isnan(top), page)
    order = np.lexsort(keys)
    if len(order) > 1 and np.logical_and.reduce([_same(k[order].astype(float)) for k in keys]).any():
        rank = lambda a: pc.rank(a, tiebreaker="dense", null_placement="at_start").to_numpy(zero_copy_only=False)
        order = np.lexsort((y1, x1, y0, rank(caption), rank(texts), kind, *keys))
    pieces = pc.binary_join_element_wise(pc.if_else(pa.array(head), "## ", ""), texts, "").take(pa.array(order))
    places[1:] = np.cumsum(np.bincount(page, minlength=n_pages))
    return pa.ListArray.from_arrays(places, pa.StructArray.from_arrays([pieces, pa.array(doubt[order])], fields=list(_PIECE)))


def markdown_of_sets(pages: DataFrame, tolerance: float = ROW_TOLERANCE, gap: float = BLOCK_GAP) -> DataFrame:
    """(doc, page, markdown): `markdown` of `page_blocks` of `lines_of`, for pages (doc, page, set) of `set_pages`.

    A page stays one row from its fragments to its text: nothing is exploded or shuffled, and numpy and Arrow work on all pages
    of a batch at once. Texts of fragments are squeezed before they are joined by single blanks, so lines and texts need no squeezing.
    """

    def run(sets: pa.Array) -> pa.Array:
        columns = [sets.field(n) for n in _SET_FIELDS]
        return in_parts(lambda *own: _pieces(_set_in_lines(*own, tolerance), gap), columns[1], *columns)

    once = F.arrow_udf(run, _PIECES).asNondeterministic()  # else the condition below would run it a second time
    words = lambda p: F.regexp_count(p["piece"], F.lit(r"(?U)\w+"))
    kept = pages.select("doc", "page", once("set").alias("all")).select("doc", "page", F.filter("all", lambda p: ~(p["doubt"] & (words(p) <= 8))).alias("kept"))
    return kept.where(F.size("kept") > 0).select("doc", "page", F.array_join("kept.piece", "\n\n").alias("markdown"))
