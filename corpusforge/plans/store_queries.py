"""Queries of merging, joins, windows and the feedback store over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.functions import text as tx
from corpusforge.operators import dedupe, feedback, layout, notes, textmodel
from corpusforge.plans.base import Catalog
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

_KEY = "paper_id, query_text, source_view"
_CAND = "(select distinct cand_id, paper_id, query_text, source_view, cand_pos, label, paper_title, arxiv_id, pdf_url, pdf_download_status, source from candidates)"


def _candidates(spark, folder):
    """Candidates without the rows that arrived twice."""
    return table(spark, folder, "candidates").select("cand_id", "paper_id", "query_text", "source_view", "cand_pos", "label", "paper_title", "arxiv_id", "pdf_url", "pdf_download_status", "source").distinct()


@query("select paper_id, min(pos) as first_pos, max(pos) as pos, arg_max(title, pos) as title, arg_max({'c': num_citations}, pos).c as num_citations from papers group by paper_id")
def dedupe_first_pos_last_value(spark, folder):
    """Papers crawled again: the place of the first, the values of the last."""
    p = table(spark, folder, "papers").select("paper_id", "pos", "title", "num_citations")
    return dedupe.first_place_last_value(p, "paper_id")


@query(r"""select title_key, min(cand_id) as cand_id from (select cand_id, lower(trim(regexp_replace(paper_title, '[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+', ' ', 'g'), ' ')) as title_key from candidates) where title_key <> '' group by 1""")
def dedupe_first_wins_title(spark, folder):
    """Candidates by comparable title, the first of each."""
    c = table(spark, folder, "candidates").select("cand_id", tx.title_key(F.col("paper_title")).alias("title_key"))
    return dedupe.first_wins(c, "title_key", "cand_id")


@query("""with u as (select paper_id as id, 0 as source, pos from papers union all select paper_id, 1, qpos from queries union all select paper_id, 2, cand_id from candidates union all select paper_forum_id, 3, id from human_feedback)
select id, arg_min(source, (source, pos)) as source, min((source, pos))[2] as pos from u where id is not null group by id""")
def id_spine_union(spark, folder):
    """Ids of four tables in first-seen order."""
    t = lambda n: table(spark, folder, n)
    return dedupe.id_spine((t("papers"), "paper_id", "pos"), (t("queries"), "paper_id", "qpos"), (t("candidates"), "paper_id", "cand_id"), (t("human_feedback"), "paper_forum_id", "id"))


@query("""with ids as (select paper_id as id from papers union select paper_id from queries union select paper_forum_id from human_feedback union select paper_id from documents where paper_id is not null),
p as (select paper_id, arg_max(title, pos) as title from papers group by 1), q as (select paper_id, count(*) as n from queries group by 1), h as (select paper_forum_id as paper_id, count(*) as n from human_feedback group by 1), d as (select paper_id, count(*) as n from documents group by 1)
select ids.id as paper_id, p.title, coalesce(q.n, 0) as n_queries, coalesce(h.n, 0) as n_feedback, coalesce(d.n, 0) as n_documents from ids left join p on p.paper_id = ids.id left join q on q.paper_id = ids.id left join h on h.paper_id = ids.id left join d on d.paper_id = ids.id where ids.id is not null""")
def stage_full_outer_merge(spark, folder):
    """One row per paper known anywhere, with what each table holds of it. Sides are summed per id before the join."""
    t = lambda n: table(spark, folder, n)
    last = F.max_by("title", "pos")
    sides = [
        t("papers").groupBy("paper_id").agg(last.alias("title"), *[F.lit(0).cast("bigint").alias(n) for n in ("q", "h", "d")]),
        t("queries").groupBy("paper_id").agg(F.lit(None).cast("string").alias("title"), F.count("*").alias("q"), *[F.lit(0).cast("bigint").alias(n) for n in ("h", "d")]),
        t("human_feedback").groupBy(F.col("paper_forum_id").alias("paper_id")).agg(F.lit(None).cast("string").alias("title"), F.lit(0).cast("bigint").alias("q"), F.count("*").alias("h"), F.lit(0).cast("bigint").alias("d")),
        t("documents").groupBy("paper_id").agg(F.lit(None).cast("string").alias("title"), *[F.lit(0).cast("bigint").alias(n) for n in ("q", "h")], F.count("*").alias("d")),
    ]
    rows = sides[0].unionByName(sides[1]).unionByName(sides[2]).unionByName(sides[3]).where("paper_id is not null")
    return rows.groupBy("paper_id").agg(F.max("title").alias("title"), F.sum("q").alias("n_queries"), F.sum("h").alias("n_feedback"), F.sum("d").alias("n_documents"))


@query(f"select paper_id, qpos from queries q where exists (select 1 from candidates c where c.label = 'positive' and c.paper_id = q.paper_id and c.query_text = q.query_text and c.source_view = q.source_view)")
def keep_semi_join(spark, folder):
    """Queries with a positive candidate."""
    c = table(spark, folder, "candidates").where("label = 'positive'").select("paper_id", "query_text", "source_view")
    return table(spark, folder, "queries").join(c, ["paper_id", "query_text", "source_view"], "left_semi").select("paper_id", "qpos")


@query("select paper_id, qpos from queries q where not exists (select 1 from candidates c where c.label = 'positive' and c.paper_id = q.paper_id and c.query_text = q.query_text and c.source_view = q.source_view)")
def resume_anti_join(spark, folder):
    """Queries that have no positive yet."""
    return dedupe.missing_from(table(spark, folder, "queries"), table(spark, folder, "candidates").where("label = 'positive'"), ["paper_id", "query_text", "source_view"]).select("paper_id", "qpos")


@query("""select paper_id from (select distinct paper_id, query_text from queries where query_text is not null) q left join (select distinct paper_id, query_text, 1 as have from candidates where label = 'positive') c using (paper_id, query_text) group by paper_id having count(*) = count(have)""")
def completeness_division(spark, folder):
    """Papers all of whose queries have a positive."""
    return dedupe.complete_groups(table(spark, folder, "queries").where("query_text is not null"), table(spark, folder, "candidates").where("label = 'positive'"), "paper_id", ["query_text"])


@query("""with k as (select paper_id, unnest(keywords) as keyword, unnest(range(len(keywords))) as qpos from (select paper_id, arg_max(keywords, pos) as keywords from papers group by 1))
select q.paper_id, q.qpos, coalesce(k.keyword, 'none') as keyword from queries q left join k on k.paper_id = q.paper_id and k.qpos = q.qpos""")
def positional_zip_join(spark, folder):
    """Queries beside the keyword of the same place; a default where there are fewer."""
    last = table(spark, folder, "papers").groupBy("paper_id").agg(F.max_by("keywords", "pos").alias("keywords"))
    k = last.select("paper_id", F.posexplode("keywords").alias("qpos", "keyword"))
    return textmodel.zipped(table(spark, folder, "queries").select("paper_id", "qpos"), k, ["paper_id"], "qpos", {"keyword": "none"})


@query("""with k as (select paper_id, unnest(keywords) as bullet, unnest(range(1, len(keywords) + 1)) as i from (select paper_id, arg_max(keywords, pos) as keywords from papers group by 1))
select q.paper_id, q.qpos, k.bullet from queries q left join k on k.paper_id = q.paper_id and k.i = q.related_bullet_indice""")
def bullet_lookup(spark, folder):
    """The bullet that a query names by its number."""
    last = table(spark, folder, "papers").groupBy("paper_id").agg(F.max_by("keywords", "pos").alias("keywords"))
    k = last.select("paper_id", F.posexplode("keywords").alias("i", "bullet")).withColumn("related_bullet_indice", F.col("i") + 1).drop("i")
    return table(spark, folder, "queries").join(k, ["paper_id", "related_bullet_indice"], "left").select("paper_id", "qpos", "bullet")


@query("""with l as (select paper_id, arg_max({'t': title, 'v': venue}, pos) as m from papers group by 1)
select q.paper_id, q.qpos, coalesce(nullif(l.m.t, ''), q.query_text) as title, coalesce(nullif(l.m.v, ''), q.source_view) as venue from queries q left join l using (paper_id)""")
def metadata_refresh_coalesce(spark, folder):
    """Queries with the metadata of their paper, the old value where the new is empty."""
    last = table(spark, folder, "papers").groupBy("paper_id").agg(F.max_by(F.struct("title", "venue"), "pos").alias("m"))
    q = table(spark, folder, "queries").join(last, "paper_id", "left")
    new = lambda c, old: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(old))
    return q.select("paper_id", "qpos", new("m.title", "query_text").alias("title"), new("m.venue", "source_view").alias("venue"))


@query("select paper_id, count(*) as n_queries, count(*) filter (where is_multimodal) as n_multimodal, count(distinct source_view) as n_views from queries group by 1")
def paper_stats(spark, folder):
    """Queries of every paper."""
    return table(spark, folder, "queries").groupBy("paper_id").agg(F.count("*").alias("n_queries"), F.count_if("is_multimodal").alias("n_multimodal"), F.count_distinct("source_view").alias("n_views"))


@query(f"select source, label, count(*) as n from {_CAND} group by 1, 2")
def decision_counts(spark, folder):
    """Candidates by source and label."""
    return _candidates(spark, folder).groupBy("source", "label").agg(F.count("*").alias("n"))


@query(f"select paper_id, query_text, source_view, k, cand_id from (select *, row_number() over (partition by {_KEY} order by cand_pos, cand_id) as k from {_CAND} where label = 'hard_negative') where k <= 5")
def candidate_top5(spark, folder):
    """The first five hard negatives of every query."""
    k = F.row_number().over(W.partitionBy("paper_id", "query_text", "source_view").orderBy("cand_pos", "cand_id"))
    return _candidates(spark, folder).where("label = 'hard_negative'").withColumn("k", k).where("k <= 5").select("paper_id", "query_text", "source_view", "k", "cand_id")


@query(f"select case when pdf_url is not null then 'url_only' when arxiv_id is not null then 'url_only' else 'unavailable' end as status, count(*) as n from {_CAND} group by 1")
def pdf_status_case(spark, folder):
    """Whether a candidate's text could be fetched, without fetching it."""
    status = F.when(F.col("pdf_url").isNotNull() | F.col("arxiv_id").isNotNull(), "url_only").otherwise("unavailable")
    return _candidates(spark, folder).groupBy(status.alias("status")).agg(F.count("*").alias("n"))


_LAST = """(select paper_forum_id, query_id, feedback_item_id, reviewer_username, min(id) as id, min(created_at) as created_at, arg_max({'j': judgement, 'u': updated_at}, (updated_at, id)) as r from human_feedback
where paper_forum_id is not null and query_id is not null and feedback_item_id is not null and reviewer_username is not null group by 1, 2, 3, 4)"""


@query(f"select id, paper_forum_id, query_id, feedback_item_id, reviewer_username, r.j as judgement from {_LAST}")
def feedback_upsert_latest(spark, folder):
    """The store after all rows were put in by key."""
    h = table(spark, folder, "human_feedback")
    return feedback.upserted(h.where("id % 2 = 0"), h.where("id % 2 = 1")).select("id", *feedback.KEY, "judgement")


@query("select id from human_feedback h where not exists (select 1 from human_feedback x where x.judgement = '?' and x.paper_forum_id = h.paper_forum_id and x.query_id = h.query_id and x.reviewer_username = h.reviewer_username)")
def feedback_delete(spark, folder):
    """The store without the answers of reviewers who answered '?' to a query."""
    h = table(spark, folder, "human_feedback")
    return feedback.deleted(h, h.where("judgement = '?'"), ["paper_forum_id", "query_id", "reviewer_username"]).select("id")


@query("select reviewer_username, count(*) as n_rows, count(distinct paper_forum_id) as n_papers, count(distinct query_id) as n_queries, epoch_us(max(updated_at)) as latest_us from human_feedback group by 1")
def feedback_reviewer_counts(spark, folder):
    """Rows, papers and queries of every reviewer."""
    return table(spark, folder, "human_feedback").groupBy("reviewer_username").agg(F.count("*").alias("n_rows"), F.count_distinct("paper_forum_id").alias("n_papers"), F.count_distinct("query_id").alias("n_queries"), F.unix_micros(F.max("updated_at").cast("timestamp")).alias("latest_us"))


@query("select id, reviewer_username, judgement from human_feedback order by updated_at desc, id desc limit 20")
def feedback_recent_topk(spark, folder):
    """The twenty latest answers (a top-k report)."""
    return table(spark, folder, "human_feedback").orderBy(F.col("updated_at").desc(), F.col("id").desc()).limit(20).select("id", "reviewer_username", "judgement")


_PIVOT = """(select paper_forum_id, query_id, reviewer_username, feedback_item_id, arg_max(judgement, (updated_at, id)) as j from human_feedback group by 1, 2, 3, 4)"""


@query(f"select paper_forum_id, query_id, reviewer_username, max(j) filter (where feedback_item_id = 'query_relevance') as query_relevance, max(j) filter (where feedback_item_id = 'human_like') as human_like, count(*) filter (where feedback_item_id not in ('query_relevance', 'human_like')) as n_candidates from {_PIVOT} group by 1, 2, 3")
def feedback_pivot(spark, folder):
    """One row per query and reviewer with the answers as columns."""
    p = feedback.pivoted(table(spark, folder, "human_feedback"), ["paper_forum_id", "query_id", "reviewer_username"], ["updated_at", "id"])
    return p.select("paper_forum_id", "query_id", "reviewer_username", *feedback.QUERY_ITEMS, F.size("candidates").cast("bigint").alias("n_candidates"))


@query(f"select paper_forum_id, query_id, reviewer_username, feedback_item_id, j as judgement from {_PIVOT} where j is not null")
def feedback_unpivot(spark, folder):
    """The rows again, from the pivoted form."""
    by = ["paper_forum_id", "query_id", "reviewer_username"]
    return feedback.unpivoted(feedback.pivoted(table(spark, folder, "human_feedback"), by, ["updated_at", "id"]), by)


@query("select paper_forum_id, count(distinct query_id) as n_queries, count(*) as n_rows, count(distinct (query_id, reviewer_username)) as n_reviews, epoch_us(max(updated_at)) as latest_us from human_feedback group by 1")
def feedback_export_counts(spark, folder):
    """Counts of the nested export."""
    e = feedback.exported(table(spark, folder, "human_feedback"))
    counts = feedback.export_counts(e)
    return counts.select("paper_forum_id", "n_queries", "n_rows", "n_reviews", F.unix_micros(F.col("latest").cast("timestamp")).alias("latest_us"))


@query("select count(distinct nullif(reviewer_username, '')) as n_reviewers, count(distinct paper_forum_id) as n_papers, count(distinct query_id) as n_queries from human_feedback")
def feedback_overview(spark, folder):
    """Reviewers, papers and queries of the whole store."""
    return feedback.overview(table(spark, folder, "human_feedback"))


@query("""with f as (select distinct paper_forum_id as paper_id, query_text from human_feedback where query_text is not null)
select q.paper_id, count(*) as n_queries, count(f.query_text) as n_matched from queries q left join f on f.paper_id = q.paper_id and f.query_text = q.query_text group by 1""")
def feedback_matched_unmatched(spark, folder):
    """Queries of every paper with and without feedback."""
    f = table(spark, folder, "human_feedback").where("query_text is not null").select(F.col("paper_forum_id").alias("paper_id"), "query_text", F.lit(1).alias("have")).distinct()
    return table(spark, folder, "queries").join(f, ["paper_id", "query_text"], "left").groupBy("paper_id").agg(F.count("*").alias("n_queries"), F.count("have").alias("n_matched"))


@query("select query_id, arg_max(reviewer_username, (updated_at, id)) as reviewer_username, arg_max(judgement, (updated_at, id)) as judgement, count(*) as n from human_feedback group by 1")
def latest_row_max_by(spark, folder):
    """The latest answer to every query."""
    last = F.max_by(F.struct("reviewer_username", "judgement"), F.struct("updated_at", "id"))
    return table(spark, folder, "human_feedback").groupBy("query_id").agg(last.alias("r"), F.count("*").alias("n")).select("query_id", "r.reviewer_username", "r.judgement", "n")


@query("select id, try_cast(json_extract_string(case when regexp_matches(selection_type, '^\\s*[\\[{]') then selection_type end, '$[0]') as varchar) as first_choice, feedback_item_id as item, split_part(feedback_item_id, ':', 1) as kind, try_cast(nullif(split_part(feedback_item_id, ':', 2), '') as int) as place from human_feedback")
def feedback_json_fields(spark, folder):
    """Choices out of JSON text, kind and place out of item ids."""
    kind, place = feedback.kind_and_place(F.col("feedback_item_id"))
    first = F.try_variant_get(feedback.parsed_json(F.col("selection_type")), "$[0]", "string")
    return table(spark, folder, "human_feedback").select("id", first.alias("first_choice"), F.col("feedback_item_id").alias("item"), kind.alias("kind"), place.alias("place"))


@query("select doc_id, row_number() over (partition by paper_id order by created_at is null, created_at, doc_id::varchar) as k from documents where paper_id is not null")
def notes_sorted(spark, folder):
    """Notes of every thread in reading order; ids compare as text."""
    return notes.ordered(table(spark, folder, "documents").where("paper_id is not null"), "paper_id", "created_at", "doc_id").select("doc_id", "k")


_INV = "lower('Venue/2024/-/' || case note_kind when 'review' then 'Official_Review' when 'rebuttal' then 'Response_to_Review' when 'comment' then 'Official_Comment' when 'decision' then 'Paper_Decision' else coalesce(note_kind, 'None') end)"


@query(f"select kind, count(*) as n from (select case when contains(i, 'decision') then 'decision' when contains(i, 'meta_review') or contains(i, 'metareview') then 'meta_review' when contains(i, 'rebuttal') or contains(i, 'response') then 'rebuttal' when contains(i, 'review') then 'review' when contains(i, 'comment') then 'comment' else 'other' end as kind from (select {_INV} as i from documents)) group by 1")
def classify_notes(spark, folder):
    """Notes by kind, from their invitations."""
    k = F.col("note_kind")
    inv = F.concat(F.lit("Venue/2024/-/"), F.when(k == "review", "Official_Review").when(k == "rebuttal", "Response_to_Review").when(k == "comment", "Official_Comment").when(k == "decision", "Paper_Decision").otherwise(F.coalesce(k, F.lit("None"))))
    return table(spark, folder, "documents").groupBy(notes.kind(inv).alias("kind")).agg(F.count("*").alias("n"))


@query("""select paper_id, kind, ((k - 1) // 100)::int as page, md5(string_agg('[' || kind || '/' || k || '] ' || text, chr(10) order by k)) as digest, count(*) as n from (select paper_id, coalesce(note_kind, 'note') as kind, text, row_number() over (partition by paper_id, coalesce(note_kind, 'note') order by doc_id) as k from documents where paper_id is not null and text is not null) group by 1, 2, 3""")
def thread_render(spark, folder):
    """Every thread as text in pages of a hundred notes, as their digests."""
    d = table(spark, folder, "documents").where("paper_id is not null").withColumn("kind", F.coalesce("note_kind", F.lit("note")))
    return notes.rendered(d, "paper_id", "kind", "doc_id", "text").select("paper_id", "kind", "page", F.md5("text").alias("digest"), "n")


@query("""with p as (select paper_id, note_kind, doc_id, text, n_chars % 7 as num, row_number() over (partition by paper_id, note_kind order by n_chars % 7 nulls last, doc_id) as place from documents where paper_id is not null),
r as (select paper_id, qpos, case qpos % 3 when 0 then 'review' when 1 then 'comment' else 'decision' end as sec, coalesce(related_bullet_indice, 1) as entry from queries),
a as (select paper_id, note_kind, num, arg_min(doc_id, place) as doc_id from p where num is not null group by 1, 2, 3)
select r.paper_id, r.qpos, coalesce(c.doc_id, a.doc_id, b.doc_id) as doc_id from r left join a on a.paper_id = r.paper_id and a.note_kind = r.sec and a.num = r.entry
left join p b on b.paper_id = r.paper_id and b.note_kind = r.sec and b.place = r.entry left join p c on c.paper_id = r.paper_id and c.note_kind = r.sec and r.sec = 'decision' and c.place = 1""")
def source_ref_lookup(spark, folder):
    """Notes that references of the form section/entry name, by number or else by place."""
    q = table(spark, folder, "queries")
    ref = F.concat(F.when(F.col("qpos") % 3 == 0, "Review").when(F.col("qpos") % 3 == 1, "Comment").otherwise("Decision"), F.lit("/Entry "), F.coalesce("related_bullet_indice", F.lit(1)).cast("string"), F.lit("/text"))
    section, entry, _ = notes.parsed_ref(ref)
    d = table(spark, folder, "documents").select("paper_id", "note_kind", "doc_id", (F.col("n_chars") % 7).alias("number"))
    refs = q.select("paper_id", "qpos", section.alias("section"), entry.alias("entry"))
    return notes.referenced(refs, d, "paper_id", "section", "entry", "note_kind", "number", "doc_id").select("paper_id", "qpos", "doc_id")


_LINES = "(select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from documents)"


@query(f"""with l as (select *, line like '## %' as h from {_LINES}), b as (select doc_id, pos, sum((h or coalesce(prev, true))::int) over (partition by doc_id order by pos) as b from (select *, lag(h) over (partition by doc_id order by pos) as prev from l))
select doc_id, max(b)::bigint as n_blocks, count(*) as n_lines from b group by 1""")
def line_blocks_islands(spark, folder):
    """Blocks of lines: one begins at a heading and after one (headings of the documents begin with number signs)."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    shown = lines.select("doc_id", F.col("pos").alias("line"), F.when(F.startswith("line", F.lit("## ")), "ABSTRACT").otherwise("text").alias("text"), F.lit(0.0).alias("y"))
    return layout.blocks_of(shown, by=("doc_id",)).groupBy("doc_id").agg((F.max("block") + 1).cast("bigint").alias("n_blocks"), F.count("*").alias("n_lines"))


@query(f"""with l as (select *, case when line like '## %' then substr(line, 4) end as h, line = '## References' as stop from {_LINES}),
f as (select doc_id, pos, last_value(h ignore nulls) over w as section, max(stop::int) over w as stopped from l window w as (partition by doc_id order by pos rows between unbounded preceding and current row))
select doc_id, section, count(*) as n_lines from f where section is not null and stopped = 0 group by 1, 2""")
def section_fill_forward(spark, folder):
    """Lines under the latest heading before them, up to the references. A document is one row, so nothing but the counts is shuffled."""
    sections = layout.line_sections(F.split("text", "\n"), "## ", "## References")
    return table(spark, folder, "documents").select("doc_id", F.inline(sections)).groupBy("doc_id", F.col("heading").alias("section")).agg(F.sum("n_lines").cast("bigint").alias("n_lines"))


@query(f"""with l as (select *, case when line like '## %' then substr(line, 4) end as h, line = '## References' as stop from {_LINES}),
f as (select doc_id, pos, last_value(h ignore nulls) over w as section, max(stop::int) over w as stopped from l window w as (partition by doc_id order by pos rows between unbounded preceding and current row))
select doc_id, count(*) as n_lines, count(distinct section) as n_sections from f where section is not null and stopped = 0 group by 1""")
def sections_by_window(spark, folder):
    """The same over rows of lines, where a document is no single row: lines and sections of every document."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    head = F.when(F.startswith("line", F.lit("## ")), F.expr("substr(line, 4)"))
    return layout.filled_sections(lines, "doc_id", ["pos"], head, F.col("line") == "## References").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_distinct("section").alias("n_sections"))


@query(f"""select doc_id, pos, case when k > 1 then h || ' (' || k || ')' else h end as path_unique from (select doc_id, pos, h, row_number() over (partition by doc_id, h order by pos) as k from (select doc_id, pos, substr(line, 4) as h from {_LINES} where line like '## %'))""")
def duplicate_section_suffix(spark, folder):
    """Headings of every document, repeats numbered."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text").where("line like '## %'").withColumn("h", F.expr("substr(line, 4)"))
    return layout.numbered_repeats(lines, ["doc_id"], "h", ["pos"]).select("doc_id", "pos", "path_unique")


@query(f"""with k as (select doc_id, pos from {_LINES} where length(line) >= 40), n as (select *, coalesce((pos - lag(pos) over (partition by doc_id order by pos) > 3)::int, 1) as s from k), r as (select *, sum(s) over (partition by doc_id order by pos) as run from n)
select doc_id, min(pos) as run_start, max(pos) as run_end from r group by doc_id, run""")
def run_detection_gap(spark, folder):
    """Runs of full lines, gaps of up to two lines bridged."""
    return table(spark, folder, "documents").select("doc_id", F.inline(layout.line_runs(F.split("text", "\n"), 40, 2)))


@query(f"""with k as (select doc_id, pos from {_LINES} where length(line) >= 40), n as (select *, coalesce((pos - lag(pos) over (partition by doc_id order by pos) > 3)::int, 1) as s from k), r as (select *, sum(s) over (partition by doc_id order by pos) as run from n)
select doc_id, count(distinct run) as n_runs, count(*) as n_full from r group by 1""")
def runs_by_window(spark, folder):
    """The same over rows of lines: runs and full lines of every document."""
    lines = notes.document_lines(table(spark, folder, "documents"), "doc_id", "text")
    found = layout.runs(lines, ["doc_id"], "pos", F.length("line"), 40, 2)
    return found.groupBy("doc_id").agg(F.count("*").alias("n_runs")).join(lines.where(F.length("line") >= 40).groupBy("doc_id").agg(F.count("*").alias("n_full")), "doc_id")


@query("""with b as (select distinct cand_id, paper_id, cand_pos * 10.0 as x0, (coalesce(year, 2000) - 2000) * 10.0 as y0 from candidates), p as (select distinct paper_id, (pos % 5) * 10.0 as x0, (coalesce(year, 2000) - 2000) * 10.0 as y0 from papers)
select cand_id from b where not exists (select 1 from p where p.paper_id = b.paper_id and greatest(0, least(b.x0 + 12, p.x0 + 30) - greatest(b.x0, p.x0)) * greatest(0, least(b.y0 + 12, p.y0 + 30) - greatest(b.y0, p.y0)) / 144.0 >= 0.35)""")
def bbox_overlap_antijoin(spark, folder):
    """Boxes that no region of their paper covers by a third."""
    y = (F.coalesce("year", F.lit(2000)) - 2000) * 10.0
    box = lambda d, i, x, w: d.select(i, "paper_id" if i != "paper_id" else F.lit(1).alias("_"), x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + w).alias("y1")).distinct()
    b = box(table(spark, folder, "candidates"), "cand_id", F.col("cand_pos") * 10.0, 12.0)
    p = box(table(spark, folder, "papers"), "paper_id", (F.col("pos") % 5) * 10.0, 30.0)
    return layout.clear_of(b, p, ["paper_id"]).select("cand_id")


QUERIES, ORACLE = _C.queries, _C.oracle
