"""Queries of page layout over fragments, lines, blocks and regions made from the documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from corpusforge.functions.text import heading_name
from corpusforge.operators import layout, notes
from corpusforge.plans.base import Catalog
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

# The documents set in pages of forty lines of 18 points. A line is laid down in fragments of three words, 8 points a character, which
# stand up to 1.6 points below each other; every fifth has no font size.
PAGE_LINES, LEADING, TOP = 40, 18.0, 760.0
_LINE_SQL = "(select doc_id::varchar as doc, unnest(string_split(text, chr(10))) as raw, unnest(range(len(string_split(text, chr(10))))) as pos from documents)"
_SPACES = r"[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+"
_SQUEEZE = lambda c: f"trim(regexp_replace({c}, '{_SPACES}', ' ', 'g'), ' ')"
_PAGED_SQL = f"""(select *, row_number() over (partition by doc, page order by pos) - 1 as line from (select doc, (pos // {PAGE_LINES} + 1)::int as page, pos, {_SQUEEZE('raw')} as text, ({TOP} - (pos % {PAGE_LINES}) * {LEADING})::double as y, string_split({_SQUEEZE('raw')}, ' ') as words from {_LINE_SQL}) where text <> '')"""


def _fragments(spark, folder):
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    threes = F.regexp_extract_all(F.trim(F.regexp_replace("line", r"(?U)[\s\x1c-\x1f]+", " ")), F.lit("[^ ]+(?: [^ ]+){0,2}"), F.lit(0))
    place = lambda a, t: F.struct((a["at"] + F.length(t) + 1).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all"))
    places = lambda of: F.aggregate(of, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), place)["all"]
    of = F.flatten(F.transform(F.array(threes), lambda of: F.zip_with(of, places(of), lambda text, at: F.struct(text.alias("text"), at.alias("at")))))
    each = lines.select(F.col("doc_id").cast("string").alias("doc"), "pos", F.posexplode(of).alias("k", "f")).select("doc", "pos", "k", "f.*")
    at = F.col("at")
    base = F.lit(TOP) - (F.col("pos") % PAGE_LINES) * F.lit(LEADING)
    return each.select(
        "doc", (F.floor(F.col("pos") / PAGE_LINES) + 1).cast("int").alias("page"), (F.col("pos") * 1000 + F.col("k")).cast("int").alias("frag"), "text", (F.lit(50.0) + at * 8.0).alias("x"),
        (base - (F.col("k") % 3) * 0.8).alias("y"), F.when(F.col("k") % 5 != 4, F.lit(10.0)).alias("font_size"),
    )


def _laid(pos: pa.Array, line: pa.Array) -> pa.Array:
    """What `_fragments` lays down, for lists of lines, a list a page."""
    upto = lambda a: np.concatenate([[0], np.cumsum(a)]).astype(int)
    place, split = pos.flatten().to_numpy(zero_copy_only=False).astype(int), pc.utf8_split_whitespace(line.flatten())
    filled = pc.not_equal(split.flatten(), "")
    words, of_line = split.flatten().filter(filled), upto(filled.to_numpy(zero_copy_only=False))[upto(split.value_lengths())]
    n = -(np.diff(of_line) // -3)
    pieces = upto(n)  # where the fragments of a line begin
    own = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(own)) - pieces[own]
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(of_line[own] + 3 * k, len(words)), pa.int32()), words), " ")
    far = upto(pc.utf8_length(text).to_numpy(zero_copy_only=False) + 1)
    at, down = far[:-1] - far[pieces[own]], place[own]
    y = TOP - (down % PAGE_LINES) * LEADING - (k % 3) * 0.8
    pages = pa.array(pieces[upto(line.value_lengths())], pa.int32())
    columns = [pa.array(down * 1000 + k, pa.int32()), text, pa.array(50.0 + at * 8.0), pa.array(y), pa.array(np.full(len(k), 10.0), mask=k % 5 == 4)]
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pages, c) for c in columns], ["frag", "text", "x", "y", "font_size"])


def _set_pages(spark, folder):
    """The fragments of every page as `layout.set_pages` has them, but lines come together before they are laid down: a page is one small row in the shuffle."""
    lines = F.split("text", "\n")
    starts = F.sequence(F.lit(0), F.size(lines) - 1, F.lit(PAGE_LINES))
    each = table(spark, folder, "documents").where("doc_id is not null and text is not null").select(F.col("doc_id").cast("string").alias("doc"), lines.alias("lines"), F.explode(starts).alias("start"))
    cut = F.transform(F.slice("lines", F.col("start") + 1, PAGE_LINES), lambda line, k: F.struct((F.col("start") + k).alias("pos"), line.alias("line")))
    pages = each.groupBy("doc", (F.floor(F.col("start") / PAGE_LINES) + 1).cast("int").alias("page")).agg(F.flatten(F.collect_list(cut)).alias("all"))
    laid = lambda pos, line: layout.in_parts(_laid, line, pos, line)

    return pages.select("doc", "page", F.arrow_udf(laid, layout.SET)("all.pos", "all.line").alias("set"))


def _lines(spark, folder):
    return layout.lines_of(_fragments(spark, folder))


@query(f"select doc, page, line::int as line, md5(text) as digest, y, 50.0::double as x_min, ((10.0 * n - 2.0 * (n // 5)) / n)::double as font_size from (select *, ceil(len(words) / 3.0)::int as n from {_PAGED_SQL})")
def page_lines(spark, folder):
    """Fragments set together to lines."""
    return _lines(spark, folder).select("doc", "page", "line", F.md5("text").alias("digest"), "y", "x_min", F.col("font_size"))


_HEAD = r"(text in ('ABSTRACT', 'REFERENCES', 'APPENDIX CONTENTS') or regexp_matches(text, '^(?:[0-9]+|[A-Z])(?:\.[0-9]+)*\s+[A-Z]'))"
_FLAGS = {
    "heading": _HEAD, "top_heading": r"regexp_matches(text, '^[0-9]+\s+[A-Z]')", "noise": r"(text = '' or starts_with(lower(text), 'published as a conference paper') or lower(text) in ('appendix contents', 'back to appendix table of contents') or regexp_matches(text, '^[0-9]+$'))",
    "institution": "(" + " or ".join(f"contains(lower(text), '{w}')" for w in layout.INSTITUTIONS) + ")", "caption": r"regexp_matches(text, '(?i)^(Figure|Fig\.?|Table)\s+[A-Za-z]?[0-9]+\s*[:.\-]\s*.+$')",
    "appendix": r"(starts_with(upper(text), 'APPENDIX') or regexp_matches(upper(text), '^[A-Z]\s+[A-Z]'))", "references": "(upper(text) in ('REFERENCES', 'REFERENCE'))",
}


@query("select " + ", ".join(f"count(*) filter (where {sql}) as {name}" for name, sql in _FLAGS.items()) + f", count(*) as n from (select {_SQUEEZE('raw')} as text from {_LINE_SQL})")
def line_kinds(spark, folder):
    """Lines of all documents by what they look like."""
    t = F.col("line")
    kinds = {"heading": layout.is_heading(t), "top_heading": layout.is_top_heading(t), "noise": layout.is_noise(t), "institution": layout.names_institution(t), "caption": layout.is_caption(F.trim(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", " "))), "appendix": layout.is_appendix_heading(t), "references": layout.is_references_heading(t)}
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    return lines.agg(*[F.count_if(c).alias(n) for n, c in kinds.items()], F.count("*").alias("n"))


_EQ_WORDS = "len(regexp_extract_all(text, '[A-Za-z]+'))"
_EQ_SIGNS = "len(regexp_extract_all(text, '[=≤≥≈∑∫√±×÷^_{}]|[α-ωΑ-Ω]'))"
_EQUATION = rf"""(length(text) >= 4 and not {_HEAD} and not contains(lower(text), '<image') and (regexp_matches(text, '\([0-9]+\)$') or ({_EQ_WORDS} <= 10 and not ({_EQ_WORDS} > 5 and len(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: w in {layout.PROSE_WORDS})) > 0)
and ((regexp_matches(text, '[A-Za-z0-9_)\]}}]\s*=\s*[^=]') and ({_EQ_SIGNS} >= 2 or len(regexp_extract_all(text, '[0-9]')) >= 2)) or regexp_matches(text, '[0-9]+\s*[+*/^]\s*[0-9]+') or (regexp_matches(text, '[A-Za-z0-9_]+\([^)]*\)') and regexp_matches(text, '[=+*/^]') and {_EQ_WORDS} <= 8) or (regexp_matches(text, '[=≤≥≈∑∫√]') and {_EQ_SIGNS} >= 3 and {_EQ_WORDS} <= 6)))))"""


@query(f"select doc, count(*) as n_lines, count(*) filter (where {_EQUATION}) as n_equations, count(*) filter (where (contains(lower(text), '<image') or (len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]+')) <= 8 and length(text) - length(replace(text, '-', '')) >= 2))) as n_artifacts from (select doc, {_SQUEEZE('raw')} as text from {_LINE_SQL}) group by 1")
def equation_lines(spark, folder):
    """Formulas and remains of pictures among the lines of every document."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text").withColumn("t", F.trim(F.regexp_replace("line", r"(?U)[\s\x1c-\x1f]+", " ")))
    return lines.groupBy(F.col("doc_id").cast("string").alias("doc")).agg(F.count("*").alias("n_lines"), F.count_if(layout.is_equation(F.col("t"))).alias("n_equations"), F.count_if(layout.is_visual_artifact(F.col("t"))).alias("n_artifacts"))


@query(rf"""select doc, page, n_lines, n_url, n_venue, n_author, n_year, coalesce(first, false) or (not coalesce(headed, false) and ((n_url >= 2 and n_venue >= 3 and n_year >= 4) or (n_url >= 3 and n_author >= 4))) as is_references from (select doc, page, count(*) as n_lines, count(*) filter (where contains(lower(text), 'urlhttp')) as n_url, count(*) filter (where {" or ".join(f"contains(lower(text), '{w}')" for w in layout.VENUE_WORDS)}) as n_venue,
count(*) filter (where regexp_matches(text, '^[A-Z][A-Za-z''`.-]+(?: [A-Z][A-Za-z''`.-]+){{0,4}}\.') or regexp_matches(text, '^[A-Z][A-Za-z''`.-]+, [A-Z]')) as n_author, count(*) filter (where regexp_matches(text, '(^|[^0-9\p{{L}}_])20[0-9]{{2}}($|[^0-9\p{{L}}_])')) as n_year, bool_or(line = 0 and starts_with(lower(text), 'references')) as first, bool_or(line < 10 and {_FLAGS['top_heading']}) as headed from {_PAGED_SQL} group by 1, 2)""")
def page_evidence(spark, folder):
    """What speaks for a list of references on every page."""
    return layout.page_evidence(_lines(spark, folder))


@query(rf"""select doc, min(page)::int as appendix_page from (select doc, page, bool_or(contains(lower(text), 'appendix contents') or contains(lower(text), 'back to appendix table of contents')) as mark, upper(string_agg(text, ' ' order by line) filter (where line < 5)) as head from {_PAGED_SQL} group by 1, 2) where mark or starts_with(head, 'APPENDIX') or regexp_matches(head, '^[A-Z]\s+[A-Z]{{4,}}') group by 1""")
def appendix_pages(spark, folder):
    """Where the appendix of a document begins."""
    return layout.appendix_start(_lines(spark, folder))


_BLOCKS_SQL = f"""(select *, sum(s) over (partition by doc, page order by line) - 1 as block from (select *, ({_HEAD} or coalesce(lag({_HEAD}) over w, true) or coalesce(lag(y) over w - y > 18, false))::int as s from {_PAGED_SQL} window w as (partition by doc, page order by line)))"""


@query(f"select doc, page, max(block)::int + 1 as n_blocks, count(*) as n_lines from {_BLOCKS_SQL} group by 1, 2")
def page_text_blocks(spark, folder):
    """Lines of every page in blocks: at headings and gaps."""
    return layout.blocks_of(_lines(spark, folder)).groupBy("doc", "page").agg((F.max("block") + 1).alias("n_blocks"), F.count("*").alias("n_lines"))


@query(f"select doc, page, block::int as block, 50.0::double as x0, greatest(min(y) - 2.0, 0.0)::double as y0, round(max(y + (10.0 * n - 2.0 * (n // 5)) / n), 6)::double as y1 from (select *, ceil(len(words) / 3.0)::int as n from {_BLOCKS_SQL}) group by 1, 2, 3")
def block_boxes(spark, folder):
    """The boxes of the text blocks of every page."""
    lines = layout.blocks_of(_lines(spark, folder)).withColumns(layout.line_box())
    return layout.merged_boxes(lines, ["doc", "page", "block"]).select("doc", "page", "block", "x0", "y0", F.round("y1", 6).alias("y1"))


@query()
def page_blocks(spark, folder):
    """Headings, texts, figures, tables and equations of every page, from the top down."""
    return layout.page_blocks(_lines(spark, folder)).select("doc", "page", "block", "block_type", "y", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "caption")


@query()
def page_markdown(spark, folder):
    """Every page as marked-up text, as its digest."""
    return layout.markdown_of_sets(_set_pages(spark, folder)).select("doc", "page", F.md5("markdown").alias("digest"))


@query()
def document_metadata(spark, folder):
    """Title, authors, institutions and abstract from the first pages."""
    return layout.document_metadata(_lines(spark, folder))


# Boxes of candidates on pages of papers, as in bbox_overlap_antijoin: 60 by 20 points, with every seventh unknown.
_BOX_SQL = """(select paper_id as doc, (year - 2000)::int as page, row_number() over (partition by paper_id, year order by cand_pos, cand_id) as block, case when cand_id % 7 <> 0 then (700.0 - cand_pos * 25.0 - (cand_id % 3))::double end as y0, case when cand_id % 7 <> 0 then (720.0 - cand_pos * 25.0 - (cand_id % 3))::double end as y1, cand_id from (select distinct cand_id, paper_id, year, cand_pos from candidates where year is not null))"""


def _boxes(spark, folder):
    c = table(spark, folder, "candidates").where("year is not null").select("cand_id", "paper_id", "year", "cand_pos").distinct()
    known = lambda top: F.when(F.col("cand_id") % 7 != 0, F.lit(top) - F.col("cand_pos") * 25.0 - F.col("cand_id") % 3)
    block = F.row_number().over(layout.W.partitionBy("paper_id", "year").orderBy("cand_pos", "cand_id"))
    return c.select(F.col("paper_id").alias("doc"), (F.col("year") - 2000).cast("int").alias("page"), block.alias("block"), known(700.0).alias("y0"), known(720.0).alias("y1"), "cand_id")


@query(f"""select cand_id, least(768.0::double, coalesce(last_value(y0 ignore nulls) over (partition by doc, page order by block rows between unbounded preceding and 1 preceding), 768.0)) as upper_limit, greatest(24.0::double, coalesce(first_value(y1 ignore nulls) over (partition by doc, page order by block rows between 1 following and unbounded following), 24.0)) as lower_limit from {_BOX_SQL}""")
def vertical_limits(spark, folder):
    """How far a box may grow up and down before it meets a neighbour."""
    return layout.vertical_limits(_boxes(spark, folder), 792.0).select("cand_id", "upper_limit", "lower_limit")


@query("""with b as (select cand_id, (cand_pos * 37 % 500)::double as x0, (cand_id % 600)::double as y0, (cand_pos * 37 % 500) + 20.0 + cand_id % 90 as x1, (cand_id % 600) + 11.0 as y1 from (select distinct cand_id, cand_pos from candidates)),
p as (select *, greatest(0, least(1224, round_even(x0 / 612.0 * 1224, 0)::int)) as a, greatest(0, least(1224, round_even(x1 / 612.0 * 1224, 0)::int)) as b, greatest(0, least(1584, round_even((792.0 - y1) / 792.0 * 1584, 0)::int)) as c, greatest(0, least(1584, round_even((792.0 - y0) / 792.0 * 1584, 0)::int)) as d from b)
select cand_id, least(a, b) as px0, least(c, d) as py0, greatest(a, b) as px1, greatest(c, d) as py1, greatest(0.0::double, x0 - 5) as ex0, least(792.0::double, y1 + 7) as ey1,
case when x1 - x0 >= 612 * 0.55 or (x0 <= 288 and x1 >= 324) or (x0 + x1) / 2 < 306 then 36.0 else 324.0 end::double as col_left, case when x1 - x0 >= 612 * 0.55 or (x0 <= 288 and x1 >= 324) or (x0 + x1) / 2 >= 306 then 576.0 else 288.0 end::double as col_right from p""")
def box_arithmetic(spark, folder):
    """Boxes in pixels, with margins, and the column they stand in."""
    c = table(spark, folder, "candidates").select("cand_id", "cand_pos").distinct()
    x0, y0 = F.pmod(F.col("cand_pos") * 37, F.lit(500)).cast("double"), F.pmod("cand_id", F.lit(600)).cast("double")
    box = {"x0": x0, "y0": y0, "x1": x0 + 20.0 + F.col("cand_id") % 90, "y1": y0 + 11.0}
    pixels, wider = layout.pixel_box(box, (612.0, 792.0), (1224, 1584)), layout.expanded_box(box, (612.0, 792.0), left=5.0, top=7.0)
    left, right = layout.caption_column(box["x0"], box["x1"], 612.0)
    return c.select("cand_id", *[pixels[k].alias("p" + k) for k in ("x0", "y0", "x1", "y1")], wider["x0"].alias("ex0"), wider["y1"].alias("ey1"), left.alias("col_left"), right.alias("col_right"))


@query(r"""select doc, page, block_type, caption, x0, (792.0 - y0 - 30.0)::double as y0, (x0 + 40.0)::double as x1, (792.0 - y0)::double as y1 from (select cand_id, paper_id as doc, (year - 2000)::int as page, case when cand_id % 2 = 0 then 'table' else 'figure' end as block_type, trim(regexp_replace(paper_title, '[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+', ' ', 'g'), ' ') as caption, (cand_pos * 10)::double as x0, (cand_id % 500)::double as y0 from (select distinct cand_id, paper_id, year, cand_pos, paper_title from candidates)) where page between 15 and 30 and cand_id % 11 <> 0""")
def figure_regions(spark, folder):
    """Regions of figures from raw records with boxes of either kind, measured from the bottom."""
    c = table(spark, folder, "candidates").select("cand_id", "paper_id", "year", "cand_pos", "paper_title").distinct()
    x, y = (F.col("cand_pos") * 10).cast("double"), (F.col("cand_id") % 500).cast("double")
    corners = F.when((F.col("cand_id") % 3 == 0) & (F.col("cand_id") % 11 != 0), F.struct((x + 40).alias("x1"), y.alias("y1"), x.alias("x2"), (y + 30).alias("y2")))
    sized = F.when((F.col("cand_id") % 3 != 0) & (F.col("cand_id") % 11 != 0), F.struct(x.alias("left"), y.alias("top"), F.lit(40.0).alias("width"), F.lit(30.0).alias("height")))
    record = F.struct(corners.alias("regionBoundary"), sized.alias("boundary"), (F.col("year") - 2000).alias("pageNumber"), F.col("paper_title").alias("captionText"), F.when(F.col("cand_id") % 2 == 0, "Table").otherwise("Figure").alias("figureType"))
    raw = c.select(F.col("paper_id").alias("doc"), F.parse_json(F.to_json(record)).alias("item"))
    heights = c.select(F.col("paper_id").alias("doc"), F.explode(F.sequence(F.lit(15), F.lit(30))).alias("page")).distinct().withColumn("height", F.lit(792.0))
    return layout.regions_in(raw, "item", heights)


# A converted document made of the lines: headings of one number sign and more are headers, others texts, with every ninth a picture or table.
_ITEM_SQL = f"""(select doc, pos, (pos // {PAGE_LINES} + 1)::int as page, case when raw like '#%' then 'header' when pos % 18 = 9 then 'picture' when pos % 18 = 0 and pos > 0 then 'table' else 'text' end as kind, {_SQUEEZE("regexp_replace(raw, '^#+', '')")} as text from {_LINE_SQL})"""


def _items(spark, folder):
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    kind = F.when(F.startswith("line", F.lit("#")), "header").when(F.col("pos") % 18 == 9, "picture").when((F.col("pos") % 18 == 0) & (F.col("pos") > 0), "table").otherwise("text")
    return lines.select(F.col("doc_id").cast("string").alias("doc"), "pos", (F.floor(F.col("pos") / PAGE_LINES) + 1).cast("int").alias("page"), kind.alias("kind"), F.regexp_replace("line", "^#+", "").alias("text"), F.lit(None).cast("string").alias("parent"))


@query(rf"""with f as (select *, kind = 'header' and upper(text) in ('REFERENCES', 'REFERENCE') as r, kind = 'header' and (starts_with(upper(text), 'APPENDIX') or regexp_matches(upper(text), '^[A-Z]\s+[A-Z]')) as a from {_ITEM_SQL}), s as (select *, bool_or(a) over w as late, bool_or(r) over w as ref from f window w as (partition by doc order by pos rows between unbounded preceding and current row)),
n as (select *, sum((kind = 'header')::int) over (partition by doc order by pos rows between unbounded preceding and current row) as section_no from s where (late or not ref) and not r)
select doc, section_no::bigint as section_no, max(case when late then 'appendix' else 'maintext' end) as container, max(case when kind = 'header' then text end) as heading, min(page) as start_page, max(page) as end_page, count(*) as n_items from n where section_no > 0 and (kind <> 'text' or not (text = '' or text in ('…', '.', ',', ':', ';', '[', ']', '(', ')', 'Web', '].') or (length(text) <= 2 and not regexp_matches(text, '[\p{{L}}\p{{N}}]')))) group by 1, 2""")
def document_sections(spark, folder):
    """Sections of converted documents, without references."""
    return layout.sectioned_items(_items(spark, folder))


@query(f"select doc, pos, printf('page_%03d_%s_%02d', page, case kind when 'picture' then 'figure' else 'table' end, k) as asset from (select *, row_number() over (partition by doc, page, kind order by pos) as k from {_ITEM_SQL} where kind in ('picture', 'table'))")
def page_assets(spark, folder):
    """Names of pictures and tables, counted on every page."""
    return layout.numbered_assets(_items(spark, folder), {"picture": "figure", "table": "table"})


@query(f"""with k as (select doc, pos from (select doc, pos, raw from {_LINE_SQL}) where length(raw) >= 40), n as (select *, coalesce((pos - lag(pos) over (partition by doc order by pos) > 3)::int, 1) as s from k), r as (select *, sum(s) over (partition by doc order by pos) as run from n), e as (select doc, min(pos) as run_start, max(pos) as run_end from r group by doc, run)
select doc, arg_max(run_start, (run_end, run_start))::int as run_start, max(run_end)::int as run_end from e where run_end - run_start >= 1 group by 1""")
def run_at_the_end(spark, folder):
    """Of every document the run of full lines that ends last."""
    d = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc"), F.inline(layout.line_runs(F.split("text", "\n"), 40, 2)))
    return layout.run_nearest_edge(d, ["doc"], False, 1)


_UNNUMBERED = r"regexp_replace(h, '^(?:[0-9]+|[A-Z])\s+', '')"
_NAME = rf"trim(regexp_replace({_SQUEEZE(_UNNUMBERED)}, '^[ .:-]+|[ .:-]+$', '', 'g'))"
_TITLE = r"array_to_string(list_transform(regexp_extract_all(lower({0}), '\p{{L}}+|[^\p{{L}}]+'), lambda w: upper(w[1]) || substr(w, 2)), '')"


@query(rf"""select doc, pos, case when n = '' then 'Untitled Section' else {_TITLE.format('n')} end as name, lower({_TITLE.format('n')}) in ('references', 'bibliography') as back_matter from (select doc, pos, {_NAME} as n from (select doc, pos, {_SQUEEZE("substr(raw, 4)")} as h from {_LINE_SQL} where raw like '## %'))""")
def heading_names(spark, folder):
    """Headings of the documents as names: without numbers, in title case."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text").where("line like '## %'").withColumn("h", F.expr("substr(line, 4)"))
    return lines.select(F.col("doc_id").cast("string").alias("doc"), "pos", heading_name(F.col("h")).alias("name"), layout.is_back_matter(F.col("h")).alias("back_matter"))


@query("""with b as (select doc, page, block, case when cand_id % 5 = 0 then 'figure' else 'text' end as block_type, y0, y1, cand_id from """ + _BOX_SQL + """ where y0 is not null), r as (select distinct paper_id as doc, (year - 2000)::int as page, 500.0 as y0, 640.0 as y1 from papers where year is not null and rating is not null)
select doc, page, cand_id, block_type from b where (block_type = 'figure' and not exists (select 1 from r where r.doc = b.doc and r.page = b.page)) or (block_type <> 'figure' and not exists (select 1 from r where r.doc = b.doc and r.page = b.page and greatest(0, least(b.y1, r.y1) - greatest(b.y0, r.y0)) * 60 / 1200.0 >= 0.35))
union all select doc, page, null, 'region' from r""")
def page_regions(spark, folder):
    """Boxes of pages with the regions that are known: guesses and covered boxes give way."""
    kind = F.when(F.col("cand_id") % 5 == 0, "figure").otherwise("text")
    b = _boxes(spark, folder).where("y0 is not null").select("doc", "page", kind.alias("block_type"), F.lit(0.0).alias("x0"), "y0", F.lit(60.0).alias("x1"), "y1", "cand_id")
    p = table(spark, folder, "papers").where("year is not null and rating is not null").select(F.col("paper_id").alias("doc"), (F.col("year") - 2000).cast("int").alias("page")).distinct()
    r = p.select("doc", "page", F.lit("region").alias("block_type"), F.lit(0.0).alias("x0"), F.lit(500.0).alias("y0"), F.lit(60.0).alias("x1"), F.lit(640.0).alias("y1"))
    return layout.with_regions(b, r).select("doc", "page", "cand_id", "block_type")


QUERIES, ORACLE = _C.queries, _C.oracle
