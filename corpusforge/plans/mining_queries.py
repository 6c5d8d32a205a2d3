"""Queries of candidate mining and of forum threads as downloaded."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import text as tx
from corpusforge.operators import dedupe, forum, mining, mocks, rules
from corpusforge.operators.ranking import ranked
from corpusforge.plans.base import Catalog
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

_D = lambda i, h="h": f"(strpos('0123456789abcdef', substr({h}, {i}, 1)) - 1)"
_SPACES = r"[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+"
_WORDS = f"list_filter(regexp_split_to_array(query_text, '{_SPACES}'), lambda t: t <> '')"
_STRIP = lambda c: rf"regexp_replace({c}, '^{_SPACES}|{_SPACES}$', '', 'g')"
MOST = 10

_FIELDS = "cand_id, query_text, cand_pos, paper_title, arxiv_id, abstract, venue, year, authors, url, pdf_url"
#: Kept results: found again by the query they were found with, and by its first four words.
_INDEX = f"""(select query_text as search_query, cand_pos * 2 as half, * exclude (query_text) from (select distinct {_FIELDS} from candidates where query_text is not null)
union all by name select array_to_string(({_WORDS})[1:4], ' ') as search_query, cand_pos * 2 + 1 as half, * exclude (query_text) from (select distinct {_FIELDS} from candidates where query_text is not null and len({_WORDS}) > 4))"""
_ASKED = rf"""(select paper_id, qpos, query_text, case when {_D(1)} % 4 = 0 then []::varchar[] else ({_WORDS})[1:5] end as keywords from
(select paper_id, qpos, query_text, sha1('Give up to five keywords as a JSON array.' || chr(10) || regexp_replace(query_text, '[\r\n]+', ' ', 'g')) as h from queries where query_text is not null))"""
_VARIED = f"""(select paper_id, qpos, query_text, keywords, list_filter([case when {_STRIP('query_text')} <> '' then {_STRIP('query_text')} end, case when len(keywords) > 0 and lower(array_to_string(keywords[1:4], ' ')) <> lower({_STRIP('query_text')}) then array_to_string(keywords[1:4], ' ') end], lambda x: x is not null) as variants from {_ASKED})"""
_FOUND = rf"""(select * from (select *, row_number() over (partition by paper_id, qpos order by variant, k) - 1 as place from (select *, row_number() over (partition by paper_id, qpos, t order by variant, k) as f from
(select v.paper_id, v.qpos, v.query_text, v.variant, i.k, i.* exclude (k, search_query, half, q), lower(trim(regexp_replace(i.paper_title, '{_SPACES}', ' ', 'g'), ' ')) as t
from (select paper_id, qpos, query_text, unnest(variants) as variant_text, unnest(range(len(variants))) as variant, len(variants) as nv from {_VARIED}) v
join (select *, row_number() over (partition by q order by half, cand_id) as k from (select *, lower({_STRIP('search_query')}) as q from {_INDEX})) i on i.q = lower(v.variant_text) and i.k <= greatest(3, {MOST} // greatest(nv, 1)))
where t <> '') where f = 1) where place < {MOST})"""


def _index(spark, folder):
    c = table(spark, folder, "candidates").where("query_text is not null").select(*_FIELDS.split(", ")).distinct()
    words = tx.tokens(F.col("query_text"))
    whole = c.withColumn("search_query", F.col("query_text")).withColumn("rank", F.struct((F.col("cand_pos") * 2).alias("half"), "cand_id"))
    short = c.where(F.size(words) > 4).withColumn("search_query", F.array_join(F.slice(words, 1, 4), " ")).withColumn("rank", F.struct((F.col("cand_pos") * 2 + 1).alias("half"), "cand_id"))
    return whole.unionByName(short).drop("query_text", "cand_pos")


def _mined(spark, folder):
    q = table(spark, folder, "queries").where("query_text is not null").select("paper_id", "qpos", "query_text")
    return mining.mined(q, _index(spark, folder), ["paper_id", "qpos"], "query_text", mocks.keyword_model, mocks.review_model, MOST)


@query(f"select v.paper_id, v.qpos, len(v.keywords)::int as n_keywords, len(v.variants)::int as n_variants, coalesce(n, 0) as n_candidates from {_VARIED} v left join (select paper_id, qpos, count(*) as n from {_FOUND} group by 1, 2) f on f.paper_id = v.paper_id and f.qpos = v.qpos")
def mining_runs(spark, folder):
    """Keywords, search queries and candidates of every query."""
    runs, _ = _mined(spark, folder)
    return runs.select("paper_id", "qpos", F.size("keywords").alias("n_keywords"), F.size("variants").alias("n_variants"), "n_candidates")


_LINK = r"coalesce(nullif(pdf_url, ''), 'https://arxiv.org/pdf/' || nullif(arxiv_id, '') || '.pdf', case when regexp_matches(url, '(?i)https?://\S+\.pdf(\?.*)?$') then trim(url) end)"
_REVIEWED = f"""(select *, [ 'positive', 'hard_negative', 'ignored', 'unsure'][{_D(1)} % 4 + 1] as label, 'r' || substr(h, 2, 3) as reason from (select *, sha1('Query: ' || query_text || chr(10) || 'Title: ' || coalesce(paper_title, '') || chr(10) || 'Authors: ' || coalesce(nullif(array_to_string(list_filter(authors[1:6], lambda a: a is not null), ', '), ''), 'unknown') || chr(10) || 'Year: ' || coalesce(year::varchar, 'unknown')
|| chr(10) || 'Venue: ' || coalesce(venue, 'unknown') || chr(10) || 'Abstract: ' || coalesce(abstract, 'none') || chr(10) || 'Text: ' || {_LINK} || chr(10) || 'Answer as JSON with label and reason.') as h from {_FOUND} where {_LINK} is not null))"""


@query(f"select paper_id, qpos, label, k, cand_id, reason from (select * exclude (k), row_number() over (partition by paper_id, qpos, label order by place) as k from {_REVIEWED} where label in ('positive', 'hard_negative')) where label = 'positive' or k <= 5")
def mined_candidates(spark, folder):
    """Positives and hard negatives of every query, found, reviewed and chosen."""
    return _mined(spark, folder)[1].select("paper_id", "qpos", "label", "k", "cand_id", "reason")


@query(rf"""select cand_id, title as paper_title, coalesce(link_id, bare_id) as arxiv_id, nullif({_STRIP('abstract')}, '') as abstract, site as venue, year, array_to_string(authors, '|') as authors, pdf_url as url, citations from (select cand_id, {_STRIP('paper_title')} as title, abstract, pdf_url, citations,
nullif(regexp_extract(pdf_url, '(?i)[\w.-]+/(?:abs|pdf)/([0-9]+\.[0-9]+)', 1), '') as link_id, nullif(regexp_extract(pdf_url, '\b([0-9]{{4}}\.[0-9]{{4,5}})(?:v\d+)?\b', 1), '') as bare_id,
'example.org' as site, year, list_filter(list_transform(list_filter(coalesce(authors, []), lambda a: a is not null), lambda a: {_STRIP('a')}), lambda a: a <> '') as authors from (select distinct cand_id, paper_title, abstract, pdf_url, citations, year, authors from candidates where year between 1900 and 2099)) where title <> ''""")
def service_records(spark, folder):
    """Raw results of a search service as candidates."""
    c = table(spark, folder, "candidates").where("year between 1900 and 2099").select("cand_id", "paper_title", "abstract", "pdf_url", "citations", "year", "authors").distinct()
    info = F.struct(F.transform("authors", lambda a: F.struct(a.alias("name"))).alias("authors"), F.concat(F.lit("A Writer - Venue, "), F.col("year").cast("string"), F.lit(" - example.org")).alias("summary"))
    record = F.struct(F.col("paper_title").alias("title"), F.col("pdf_url").alias("link"), F.col("abstract").alias("snippet"), info.alias("publication_info"), F.struct(F.struct(F.col("citations").alias("total")).alias("cited_by")).alias("inline_links"))
    raw = c.select("cand_id", F.parse_json(F.to_json(record)).alias("item"))
    return mining.candidates_in(raw, "item", ["cand_id"]).drop("pdf_url", "source").withColumn("authors", F.array_join("authors", "|"))


@query(rf"""select cand_id, {_STRIP('paper_title')} as paper_title, nullif({_STRIP('abstract')}, '') as abstract, nullif({_STRIP('venue')}, '') as venue, year, array_to_string(list_filter(list_transform(string_split(array_to_string(list_filter(authors, lambda a: a is not null), ' and '), ' and '), lambda a: {_STRIP('a')}), lambda a: a <> ''), '|') as authors, citations
from (select distinct cand_id, paper_title, abstract, venue, year, coalesce(authors, []) as authors, citations from candidates) where {_STRIP('paper_title')} <> ''""")
def library_records(spark, folder):
    """Raw publications of a search library as candidates."""
    c = table(spark, folder, "candidates").select("cand_id", "paper_title", "abstract", "venue", "year", "authors", "citations", "pdf_url").distinct()
    bib = F.struct(F.col("paper_title").alias("title"), F.array_join("authors", " and ").alias("author"), "abstract", "venue", F.col("year").cast("string").alias("pub_year"))
    raw = c.select("cand_id", F.parse_json(F.to_json(F.struct(bib.alias("bib"), F.col("pdf_url").alias("eprint_url"), F.col("citations").alias("num_citations")))).alias("item"))
    return mining.candidates_in(raw, "item", ["cand_id"], mining.record_of_library).drop("pdf_url", "source", "url", "arxiv_id").withColumn("authors", F.array_join("authors", "|"))


# Raw notes of a forum made from the documents: names of fields, wrapped values and gaps as a forum has them.
_KIND = "case note_kind when 'review' then 'Official_Review' when 'rebuttal' then 'Rebuttal' when 'comment' then 'Official_Comment' when 'decision' then 'Decision' end"


def _raw_notes(spark, folder):
    d = table(spark, folder, "documents").where("paper_id is not null")
    kind = F.expr(_KIND)
    decision = F.to_json(F.struct(F.struct(F.when(F.col("n_chars") % 2 == 0, "Accept (Oral)").otherwise("Reject").alias("value")).alias("decision")))
    other = F.to_json(F.struct(F.struct(F.left("text", F.lit(40)).alias("value")).alias("summary"), F.col("lang").alias("strengths"), F.struct(F.col("n_chars").alias("value")).alias("rating")))
    return d.select(
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id").cast("string")).alias("id"), F.col("paper_id").alias("forum"), F.col("paper_id").alias("replyto"), F.when(F.col("n_chars") % 3 != 0, F.concat(F.lit("V/-/"), kind)).alias("invitation"),
        F.array(F.lit(""), F.concat(F.lit("V/Paper/-/"), kind)).alias("invitations"), F.when(F.col("n_chars") % 5 == 0, "x").otherwise((F.col("n_chars") % 11).cast("string")).alias("number"), F.unix_millis(F.col("created_at").cast("timestamp")).alias("cdate"),
        F.parse_json(F.when(F.col("note_kind") == "decision", decision).otherwise(other)).alias("content"), F.col("doc_id").alias("pos"),
    )


_NOTE = f"""(select *, {_KIND} as word, case when note_kind in ('review', 'rebuttal', 'comment', 'decision') then note_kind else 'other' end as kind from documents where paper_id is not null)"""


@query(f"""select paper_id as forum, case when doc_id % 7 <> 0 then doc_id::varchar else paper_id || '_' || kind || '_' || doc_id end as id, kind, case when n_chars % 3 <> 0 and word is not null then 'V/-/' || word when word is not null then 'V/Paper/-/' || word else 'unknown_invitation' end as invitation,
case when n_chars % 5 = 0 then 0 else n_chars % 11 end as number, case when kind <> 'decision' then left(text, 40) end as review, case when kind <> 'decision' then lang end as pros, case when kind <> 'decision' then n_chars::varchar end as rating, case when kind = 'decision' then case when n_chars % 2 = 0 then 'Accept (Oral)' else 'Reject' end end as decision from {_NOTE}""")
def notes_split(spark, folder):
    """Raw notes by kind with ids, invitations and numbers made up where they lack, fields under their newer names."""
    out = forum.split_notes(_raw_notes(spark, folder))
    return out.select("forum", "id", "kind", "invitation", "number", *[F.col("content")[c].alias(c) for c in ("review", "pros", "rating", "decision")])


@query(f"""select coalesce(doc_id % 7 <> 0, false) as has_id, count(*) as n, count(*) filter (where n_chars % 3 <> 0 and word is not null) as n_invitation, count(*) filter (where kind <> 'decision') as n_summary from {_NOTE} group by 1""")
def notes_projected(spark, folder):
    """Raw notes on their twelve fields with wrapped values taken out."""
    p = forum.projected(_raw_notes(spark, folder))
    return p.groupBy(F.col("id").isNotNull().alias("has_id")).agg(F.count("*").alias("n"), F.count("invitation").alias("n_invitation"), F.count(forum.text_of(F.col("content"), "summary")).alias("n_summary"))


@query(f"""select p.paper_id as id, coalesce(n_reviews, 0) as n_reviews, coalesce(n_decisions, 0) as n_decisions, case when coalesce(n_reviews, 0) = 0 then 'no_reviews' when coalesce(n_decisions, 0) = 0 then 'no_decision' when first % 2 <> 0 then 'not_accepted' else 'ok' end as state
from (select distinct paper_id from papers) p left join (select paper_id, count(*) filter (where kind = 'review') as n_reviews, count(*) filter (where kind = 'decision') as n_decisions, arg_min(n_chars, doc_id) filter (where kind = 'decision') as first from {_NOTE} group by 1) n on n.paper_id = p.paper_id""")
def thread_states(spark, folder):
    """The first requirement that every thread fails."""
    p = table(spark, folder, "papers").select(F.col("paper_id").alias("id"))
    return forum.thread_states(p, forum.split_notes(_raw_notes(spark, folder)), F.contains(F.lower(F.col("content")["decision"]), F.lit("accept")))


@query(f"select state, count(*) as n from ({_C.oracle['thread_states']}) group by 1")
def keep_reason_histogram(spark, folder):
    """Threads by the requirement they fail."""
    return thread_states(spark, folder).groupBy("state").agg(F.count("*").alias("n"))


@query("""select paper_id as id, coalesce(title, '') as title, coalesce(abstract, '') as abstract, array_to_string(coalesce(list_filter(list_transform(string_split(array_to_string(keywords, ', '), ','), lambda k: trim(k)), lambda k: k <> ''), []), '|') as keywords, array_to_string(coalesce(authors, []), '|') as authors,
coalesce(nullif(trim(venue), ''), case when venueid is null then null else string_split(venueid, '/')[1] end, 'Fallback') as venue, coalesce(try_cast(nullif(regexp_extract(year::varchar, '((?:19|20)[0-9]{2})', 1), '') as int), try_cast(nullif(regexp_extract(venueid, '\\b((?:19|20)[0-9]{2})\\b', 1), '') as int), 1999) as year,
'https://openreview.net/pdf?id=' || paper_id as pdf_url, 'https://openreview.net/forum?id=' || paper_id as forum_url, submission_number from papers""")
def papers_built(spark, folder):
    """Papers made of submission notes: venue and year from the best source, keywords from a text."""
    p = table(spark, folder, "papers")
    wrap = lambda c: F.struct(c.alias("value"))
    content = F.struct(wrap(F.col("title")).alias("title"), F.col("abstract").alias("abstract"), wrap(F.col("authors")).alias("authors"), F.array_join("keywords", ", ").alias("keywords"), wrap(F.col("venue")).alias("venue"), wrap(F.col("venueid")).alias("venueid"), wrap(F.col("year")).alias("year"))
    notes = p.select(F.col("paper_id").alias("id"), F.lit(None).cast("string").alias("invitation"), F.array().cast("array<string>").alias("invitations"), F.col("submission_number").cast("string").alias("number"), F.parse_json(F.to_json(content)).alias("content"))
    return forum.papers_of(notes, "Fallback", 1999).drop("venueid").withColumns({c: F.array_join(c, "|") for c in ("authors", "keywords")})


@query("""with d as (select * from documents where paper_id is not null), u as (select *, 0 as s from d where note_kind = 'review' union all select *, 1 from d) select paper_id as forum, doc_id::varchar as id, arg_min(note_kind, (s, doc_id)) as note_kind, arg_min(s, (s, doc_id)) as side from u group by 1, 2""")
def thread_note_union(spark, folder):
    """Direct replies and thread notes in one list, the first of every id."""
    d = table(spark, folder, "documents").where("paper_id is not null").select(F.col("paper_id").alias("forum"), F.col("doc_id").cast("string").alias("id"), "note_kind", F.col("doc_id").alias("pos"))
    both = forum.thread_notes(d.where("note_kind = 'review'").withColumn("side", F.lit(0)), d.withColumn("side", F.lit(1)))
    return both.select("forum", "id", "note_kind", "side")


@query("""with u as (select paper_id, title, pos, 0 as s from papers where venue is not null union all select paper_id, title || '!', pos, 1 from papers where abstract is not null) select paper_id, min(s * 1000000000000 + pos)::bigint as first_pos, arg_max(title, s * 1000000000000 + pos) as title from u group by 1""")
def merge_papers(spark, folder):
    """Papers fetched now on top of those kept: the place of the first, the values of the last."""
    p = table(spark, folder, "papers").select("paper_id", "title", "pos", "venue", "abstract")
    kept = p.where("venue is not null").select("paper_id", "title", "pos")
    fetched = p.where("abstract is not null").select("paper_id", F.concat("title", F.lit("!")).alias("title"), "pos")
    return dedupe.merged(kept, fetched, "paper_id").select("paper_id", "first_pos", "title")


@query("""with w as (select distinct trim(unnest(string_split(string_agg(paper_id, ' , '), ','))) as id from (select distinct coalesce(paper_forum_id, '') as paper_id from human_feedback) union select distinct paper_id from documents where paper_id is not null),
have as (select paper_id as id, arg_max(venue, pos) as venue from papers where venue is not null and rating is not null group by 1) select w.id, have.id is not null as stale from w left join have on have.id = w.id where w.id <> '' and (have.id is null or case upper(replace(trim(have.venue), ' ', '_')) when 'ICLR' then 'ICLR.cc' when 'NEURIPS' then 'NeurIPS.cc' when 'NIPS' then 'NeurIPS.cc' when 'ICML' then 'ICML.cc' else replace(trim(have.venue), ' ', '_') end in ('ICLR.cc', 'NeurIPS.cc', 'ICML.cc'))""")
def ids_to_fetch(spark, folder):
    """Requested ids that are missing or have only a fall-back venue."""
    spec = table(spark, folder, "human_feedback").groupBy(F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(F.array_join(F.array_sort(F.collect_set("paper_forum_id")), " , ").alias("spec"))
    wanted = spec.select(F.explode(forum.requested_ids(F.col("spec"))).alias("id")).unionByName(table(spark, folder, "documents").select(F.col("paper_id").alias("id")))
    have = table(spark, folder, "papers").where("venue is not null and rating is not null").select(F.col("paper_id").alias("id"), "venue", "pos")
    return forum.to_fetch(wanted, have)


@query("select paper_id, pos, true as passed, true as accepted, false as is_similar, true as has_mentions from papers")
def skip_filter(spark, folder):
    """Papers passed without looking at the rules."""
    return forum.skipped_filter(table(spark, folder, "papers").select("paper_id", "pos"))


@query("""select cand_id, case when pdf_url is null then 'unavailable' when source = 'google_scholar' or (citations is null and coalesce(year, 0) > 2000 and (cand_pos % 2 = 0 or contains(lower(venue), 'conf'))) then 'downloaded' else 'failed' end as status,
case when pdf_url is null then 'no link of a PDF' when source = 'google_scholar' then null when citations is not null then 'error ' || citations when coalesce(year, 0) <= 2000 then 'empty response' when not (cand_pos % 2 = 0 or coalesce(contains(lower(venue), 'conf'), false)) then 'no PDF: ' || coalesce(case when contains(lower(venue), 'conf') then 'application/pdf' else venue end, 'unknown') end as error
from (select distinct cand_id, pdf_url, source, citations, year, cand_pos, venue from candidates)""")
def download_states(spark, folder):
    """What became of fetching the text of every candidate, for made-up responses."""
    c = table(spark, folder, "candidates").select("cand_id", "pdf_url", "source", "citations", "year", "cand_pos", "venue").distinct()
    kind = F.when(F.contains(F.lower("venue"), F.lit("conf")), "application/pdf").otherwise(F.col("venue"))
    status, error = mining.download_state(
        F.col("pdf_url"), F.col("source") == "google_scholar", F.concat(F.lit("error "), F.col("citations").cast("string")), F.greatest(F.col("year") - 2000, F.lit(0)), F.when(F.col("cand_pos") % 2 == 0, "%PDF-1.7").otherwise("<html>"), kind
    )
    return c.select("cand_id", status.alias("status"), error.alias("error"))


@query("select doc_id from documents where note_kind = 'review' and n_chars > 200 order by created_at nulls first, doc_id limit 50")
def passed_limit(spark, folder):
    """The first fifty documents that pass a rule, in order of time (a limit is the feature)."""
    d = table(spark, folder, "documents").withColumn("passed", F.coalesce((F.col("note_kind") == "review") & (F.col("n_chars") > 200), F.lit(False)))
    return rules.first_passed(d, ["created_at", "doc_id"], 50).select("doc_id")


@query("with s as (select paper_id, min(pos) as pos from papers where venue is not null group by 1), r as (select paper_id, count(*) as n from queries group by 1) select r.paper_id, r.n, s.pos, row_number() over (order by s.pos, r.paper_id) as place from r join s on s.paper_id = r.paper_id")
def restored_order(spark, folder):
    """Results that are still wanted, in the order of the input."""
    targets = table(spark, folder, "papers").where("venue is not null").select("paper_id", "pos")
    results = table(spark, folder, "queries").groupBy("paper_id").agg(F.count("*").alias("n"))
    out = dedupe.in_first_order(dedupe.still_wanted(results, targets, ["paper_id"]), targets, "paper_id")
    return ranked(out.withColumn("_all", F.lit(1)), ["_all"], [F.col("pos"), F.col("paper_id")], "place").drop("_all")


QUERIES, ORACLE = _C.queries, _C.oracle
