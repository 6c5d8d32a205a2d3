"""Queries of feedback payloads, artifact headers and reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.functions import text as tx
from corpusforge.operators import artifact, feedback, judging, reports
from corpusforge.plans import model_queries
from corpusforge.plans.base import Catalog
from corpusforge.plans.text_queries import QUERY_TOKENS_SQL
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

BY = ["paper_forum_id", "query_id", "reviewer_username"]


def _payloads(spark, folder):
    """Payloads as a viewer sends them: one per feedback row, in the part that its item belongs to."""
    h = table(spark, folder, "human_feedback")
    own = F.struct(F.col("judgement").alias("relevance"), F.col("reason_note").alias("notes"))
    like = F.struct(F.col("judgement").alias("real_researcher_search"), F.col("reason_note").alias("notes"), F.try_parse_json("selection_type").alias("non_human_like_type"))
    check = F.struct(F.col("judgement").alias("label_correct"), F.col("reason_note").alias("notes"), F.col("feedback_item_id").alias("wrong_label_type"))
    item = F.col("feedback_item_id")
    pick = lambda name, value: F.when(item == name, value)
    whole = F.struct(pick("query_relevance", own).alias("query_paper_relevance"), pick("human_like", like).alias("human_like_search"), F.when(~item.isin(*feedback.QUERY_ITEMS), F.create_map(item, check)).alias("candidate_checks"))
    return h.select("id", F.parse_json(F.to_json(whole)).alias("payload"))


_SPACES = r"[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+"
_STRIP = lambda c: f"regexp_replace({c}, '^{_SPACES}|{_SPACES}$', '', 'g')"


@query(f"""select id, feedback_item_id, {_STRIP('judgement')} as judgement, nullif(reason_note, '') as reason_note, case when feedback_item_id not in ('query_relevance', 'human_like') then feedback_item_id end as choice from human_feedback where {_STRIP('judgement')} <> '' and feedback_item_id is not null""")
def feedback_payload_rows(spark, folder):
    """Nested payloads as rows, one per judged item."""
    rows = feedback.payload_rows(_payloads(spark, folder), "payload", ["id"])
    choice = F.when(~F.col("feedback_item_id").isin(*feedback.QUERY_ITEMS), F.try_variant_get(F.try_parse_json("selection"), "$[0]", "string"))
    return rows.select("id", "feedback_item_id", "judgement", "reason_note", choice.alias("choice"))


_LATEST = """(select paper_forum_id, query_id, count(distinct feedback_item_id) as n_items, arg_max(reviewer_username, (updated_at, id)) filter (where feedback_item_id <> '') as reviewer, epoch_us(max(updated_at) filter (where feedback_item_id <> '')) as latest_us from human_feedback where feedback_item_id is not null and feedback_item_id <> '' group by 1, 2)"""


@query(f"select * from {_LATEST}")
def feedback_of_queries(spark, folder):
    """The merged payload of every query, its latest reviewer and change."""
    p = feedback.payload_of(table(spark, folder, "human_feedback"), ["paper_forum_id", "query_id"])
    return p.select("paper_forum_id", "query_id", F.size("payload").cast("bigint").alias("n_items"), "reviewer", F.unix_micros(F.col("latest").cast("timestamp")).alias("latest_us"))


@query(r"""with l as (select paper_forum_id, query_id, reviewer_username, feedback_item_id, arg_max({'j': judgement, 'r': reason_note, 'f': feedback_raw_json}, (updated_at, id)) as m from human_feedback where feedback_item_id = 'query_relevance' group by 1, 2, 3, 4)
select paper_forum_id, query_id, reviewer_username, coalesce(case when json_valid(m.f) and json_type(m.f) = 'OBJECT' and len(json_keys(m.f)) > 0 then json_extract_string(m.f, '$.relevance') else m.j end, null) as relevance from l""")
def feedback_relevance(spark, folder):
    """The relevance that each reviewer's payload holds: from the stored JSON where there is one, else from the columns."""
    p = feedback.payload_of(table(spark, folder, "human_feedback").where("feedback_item_id = 'query_relevance'"), BY)
    return p.select(*BY, F.try_variant_get(F.try_parse_json(F.col("payload")["query_relevance"]), "$.relevance", "string").alias("relevance"))


@query("""select id, paper_forum_id as paper, coalesce(case when length(query_id) % 2 = 0 then nullif(query_id, '') end, paper_forum_id || '::' || coalesce(nullif(feedback_item_id, ''), 'unknown_view') || '::' || (coalesce(list_sum(list_transform(range(1, length(query_text) + 1), lambda i: i * unicode(substr(query_text, i, 1))::bigint)), 0) % 1000000007)::bigint::varchar) as query
from human_feedback where paper_forum_id is not null and query_text is not null and query_text <> ''""")
def feedback_ids(spark, folder):
    """Ids of papers under several names, ids of queries as given or made of paper, view and text."""
    h = table(spark, folder, "human_feedback").where("paper_forum_id is not null and query_text is not null and query_text <> ''")
    even = F.length("query_id") % 2 == 0
    context = F.map_from_arrays(F.array(*map(F.lit, ("forum_id", "query_key", "source_view", "query_text"))), F.array("paper_forum_id", F.when(even, F.col("query_id")), "feedback_item_id", "query_text"))
    return h.withColumn("c", context).select("id", feedback.paper_of(F.col("c")).alias("paper"), feedback.query_of(F.col("c")).alias("query"))


_CAND = "(select distinct cand_id, paper_id, query_text, source_view, cand_pos, label, paper_title, url, reason from candidates where label in ('hard_negative', 'positive'))"


@query(f"""select q.paper_id, q.qpos, c.label || ':' || row_number() over (partition by q.paper_id, q.qpos, c.label order by c.cand_pos, c.cand_id) as key, case c.label when 'positive' then 'Positive' else 'Hard Negative' end as expected, case c.label when 'positive' then 'Positive ' else 'Hard Negative ' end || row_number() over (partition by q.paper_id, q.qpos, c.label order by c.cand_pos, c.cand_id) || ': ' || coalesce(c.paper_title, 'Untitled') as label
from queries q join {_CAND} c on c.paper_id = q.paper_id and c.query_text = q.query_text and c.source_view = q.source_view""")
def candidate_items(spark, folder):
    """The keyed candidates that every query shows for judging."""
    t = lambda n: table(spark, folder, n)
    q = artifact.assembled(t("papers"), t("queries"), t("candidates")).select("paper_id", F.explode("queries").alias("q")).select("paper_id", "q.*")
    return feedback.candidate_items(q).select("paper_id", "qpos", F.inline("items")).select("paper_id", "qpos", "key", "expected", "label")


@query("""with a as (select q.paper_id, q.qpos, nullif(q.source_view, 'contribution') as relevance, case when q.is_multimodal then 'No' else q.related_bullet_justification end as real_search, case when q.related_bullet_indice > 2 then ['Other'] when q.related_bullet_indice > 1 then ['a'] else [] end as types, q.query_text from queries q)
select paper_id, qpos, case when coalesce(query_text, '') = '' then 'No query selected' else array_to_string(list_filter([case when coalesce(relevance, '') = '' then 'query-paper relevance' end, case when coalesce(real_search, '') = '' then 'human-like search' end, case when real_search = 'No' and len(types) = 0 then 'non human-like type' end, case when real_search = 'No' and list_contains(types, 'Other') then 'non human-like other reason' end,
case when relevance is null then 'A label check' end, case when coalesce(real_search, '') = 'No' then 'A wrong-label type' end], lambda x: x is not null), '; ') end as errors from (select *, case when relevance is null then null else real_search end as checked from a)""".replace("case when coalesce(real_search, '') = 'No' then 'A wrong-label type' end", "case when relevance is not null and real_search = 'No' then 'A wrong-label type' end").replace("case when relevance is null then 'A label check' end", "case when coalesce(checked, '') = '' then 'A label check' end"))
def payload_errors(spark, folder):
    """What is missing in answers made of the queries."""
    q = table(spark, folder, "queries")
    relevance = F.nullif("source_view", F.lit("contribution"))
    real = F.when(F.col("is_multimodal"), "No").otherwise(F.col("related_bullet_justification"))
    types = F.when(F.col("related_bullet_indice") > 2, F.array(F.lit("Other"))).when(F.col("related_bullet_indice") > 1, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>"))
    checks = F.array(F.struct(F.lit("A").alias("label"), F.when(relevance.isNotNull(), real).alias("label_correct"), F.array().cast("array<string>").alias("wrong_type")))
    answers = q.select("paper_id", "qpos", F.col("query_text").alias("query_key"), relevance.alias("relevance"), real.alias("real_search"), types.alias("types"), F.lit("").alias("other"), checks.alias("checks"))
    return answers.select("paper_id", "qpos", F.array_join(feedback.payload_errors(answers), "; ").alias("errors"))


@query("select q.paper_id, q.qpos, exists (select 1 from human_feedback h where h.paper_forum_id = q.paper_id and h.query_text = q.query_text) as saved from queries q")
def feedback_saved(spark, folder):
    """Whether there is feedback on a query."""
    rows = table(spark, folder, "human_feedback").select(F.col("paper_forum_id").alias("paper_id"), "query_text")
    return feedback.has_feedback(table(spark, folder, "queries").select("paper_id", "qpos", "query_text"), rows, ["paper_id", "query_text"]).select("paper_id", "qpos", "saved")


@query("select id, row_number() over (order by paper_forum_id nulls first, query_id nulls first, reviewer_username, feedback_item_id nulls first, id) as place from human_feedback where reviewer_username = (select reviewer_username from human_feedback where reviewer_username is not null group by 1 order by count(*) desc, reviewer_username limit 1)")
def feedback_of_reviewer(spark, folder):
    """The rows of the busiest reviewer in the order of an export."""
    h = table(spark, folder, "human_feedback")
    busiest = h.where("reviewer_username is not null").groupBy("reviewer_username").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reviewer_username").first()
    first = busiest["reviewer_username"] if busiest else ""
    order = W.partitionBy("reviewer_username").orderBy("paper_forum_id", "query_id", "feedback_item_id", "id")  # one reviewer's rows
    return feedback.listed(h, first).withColumn("place", F.row_number().over(order)).select("id", "place")


@query("select count(*) as n_deleted from human_feedback h where exists (select 1 from human_feedback x where x.judgement = '?' and x.paper_forum_id = h.paper_forum_id and x.query_id = h.query_id and x.reviewer_username = h.reviewer_username)")
def feedback_delete_count(spark, folder):
    """How many rows the deletion takes away."""
    h = table(spark, folder, "human_feedback")
    return feedback.deleted_count(h, h.where("judgement = '?'"), ["paper_forum_id", "query_id", "reviewer_username"])


_SIDES = """(select paper_id, title, pos, 0 as side from papers where venue is not null union all select paper_id, lower(title), pos, 1 from papers where abstract is not null union all select paper_forum_id, query_text, id, 2 from human_feedback where paper_forum_id is not null)"""


@query(f"select paper_id, coalesce(arg_max({{'t': title}}, (-side, pos)).t, '') as title from {_SIDES} group by 1")
def artifact_titles(spark, folder):
    """Titles from the first of three stages that knows a paper."""
    p = table(spark, folder, "papers").select("paper_id", "title", "pos", "venue", "abstract")
    h = table(spark, folder, "human_feedback").select(F.col("paper_forum_id").alias("paper_id"), F.col("query_text").alias("title"), F.col("id").alias("pos"))
    return artifact.titles(p.where("venue is not null"), p.where("abstract is not null").withColumn("title", F.lower("title")), h)


@query("""with ids as (select paper_id from papers union select paper_forum_id from human_feedback union select 'unknown'), n as (select paper_id, count(*) as n from documents group by 1),
d as (select paper_id, arg_max({'abstract': abstract, 'pdf_url': pdf_url, 'venue': venue, 'year': year, 'authors': authors}, pos) as r from papers where venue is not null group by 1), a as (select paper_id, arg_max({'abstract': abstract, 'pdf_url': pdf_url, 'venue': venue, 'year': year, 'authors': authors}, pos) as r from papers where abstract is not null group by 1)
select ids.paper_id, 'https://openreview.net/forum?id=' || ids.paper_id as forum_url, case when d.r is not null then d.r.abstract else a.r.abstract end as abstract, case when d.r is not null then d.r.pdf_url else a.r.pdf_url end as pdf_url, case when d.r is not null then d.r.venue else a.r.venue end as venue, case when d.r is not null then d.r.year else a.r.year end as year,
array_to_string(coalesce(case when d.r is not null then d.r.authors else a.r.authors end, []), '|') as authors, case when d.r is not null then coalesce(n.n, 0) else 0 end as n_notes, case when d.r is not null then 'download' when a.r is not null then 'analysis' else 'none' end as origin from ids left join d on d.paper_id = ids.paper_id left join a on a.paper_id = ids.paper_id left join n on n.paper_id = ids.paper_id where ids.paper_id is not null""")
def artifact_headers(spark, folder):
    """The header of every paper of an artifact and where it comes from."""
    p = table(spark, folder, "papers")
    ids = p.select("paper_id").unionByName(table(spark, folder, "human_feedback").select(F.col("paper_forum_id").alias("paper_id"))).unionByName(spark.createDataFrame([("unknown",)], "paper_id string"))
    n = table(spark, folder, "documents").groupBy("paper_id").agg(F.count("*").alias("n_notes"))
    return artifact.headers(ids, p.where("venue is not null").join(n, "paper_id", "left"), p.where("abstract is not null")).withColumn("authors", F.array_join("authors", "|"))


@query("with f as (select paper_id, bool_or(n_chars % 2 = 0) as passed, max(doc_id) as pos from documents where paper_id is not null and note_kind = 'review' group by 1) select p.paper_id, f.passed, null::varchar as reason, null::double as score from (select distinct paper_id from papers) p left join f on f.paper_id = p.paper_id")
def artifact_filter_status(spark, folder):
    """Whether papers passed the filter, nulls for those it never saw."""
    f = table(spark, folder, "documents").where("paper_id is not null and note_kind = 'review'").groupBy("paper_id").agg((F.max((F.col("n_chars") % 2 == 0).cast("int")) == 1).alias("passed"), F.max("doc_id").alias("pos"))
    return artifact.filter_status(table(spark, folder, "papers").select("paper_id"), f)


@query("""with p as (select paper_id, arg_max(title, pos) as title, min(pos) as pos from papers group by 1), q as (select paper_id, count(*) as n from queries group by 1) select p.paper_id, '[' || (p.pos + 1) || '] ' || coalesce(p.title, 'Untitled') || ' | ' || p.paper_id || ' | q=' || coalesce(q.n, 0) as label from p left join q on q.paper_id = p.paper_id""")
def paper_labels(spark, folder):
    """How papers are called in a choice."""
    p = table(spark, folder, "papers").groupBy("paper_id").agg(F.max_by("title", "pos").alias("title"), F.min("pos").alias("pos"))
    n = table(spark, folder, "queries").groupBy("paper_id").agg(F.count("*").alias("n"))
    return p.join(n, "paper_id", "left").select("paper_id", reports.paper_label(F.col("pos") + 1, F.col("title"), F.col("paper_id"), F.coalesce("n", F.lit(0))).alias("label"))


@query(f"""select q.paper_id, q.qpos, 'Q' || (q.qpos + 1) || ' | ' || coalesce(q.source_view, 'N/A') || ' | ' || coalesce(a.decision, 'N/A') || case when exists (select 1 from human_feedback h where h.paper_forum_id = q.paper_id and h.query_text = q.query_text) then ' | [saved]' else '' end as label from queries q left join ({model_queries.ORACLE['retrieval_judge_mock']}) a on a.paper_id = q.paper_id and a.qpos = q.qpos""")
def query_labels(spark, folder):
    """How queries are called in a choice: place, view, decision, and whether there is feedback."""
    q = table(spark, folder, "queries").select("paper_id", "qpos", "query_text", "source_view")
    saved = feedback.has_feedback(q, table(spark, folder, "human_feedback").select(F.col("paper_forum_id").alias("paper_id"), "query_text"), ["paper_id", "query_text"])
    judged = model_queries.retrieval_judge_mock(spark, folder).select("paper_id", "qpos", "decision")
    return saved.join(judged, ["paper_id", "qpos"], "left").select("paper_id", "qpos", reports.query_label(F.col("qpos") + 1, F.col("source_view"), F.col("decision"), F.col("saved")).alias("label"))


_VIEWS = ("contribution", "method/dataset", "experiment/result")


@query("with r as (select source_view, row_number() over (partition by source_view order by paper_id, qpos) as place, replace(regexp_replace(query_text, '\\n', ' ', 'g'), '|', '\\|') as t from queries) select place, " + ", ".join(f"max(t) filter (where source_view = '{v}') as side_{i + 1}" for i, v in enumerate(_VIEWS)) + f" from r where source_view in {_VIEWS} and place <= 5 group by 1")
def examples_side_by_side(spark, folder):
    """Five queries of three views beside each other (a report)."""
    return reports.side_by_side(table(spark, folder, "queries"), "source_view", "query_text", ["paper_id", "qpos"], _VIEWS, 5)


@query(f"select decision, count(*) as n from ({model_queries.ORACLE['retrieval_judge_mock']}) group by 1")
def decision_fallback(spark, folder):
    """Decisions counted from the rows where no counts are stored."""
    none = spark.createDataFrame([], "decision string, n bigint")
    return reports.decisions(none, model_queries.retrieval_judge_mock(spark, folder))


_SUM = "select '{0}' as dataset, sum(query_count)::bigint as query_count, " + ", ".join(f"sum({m} * query_count) / sum(query_count) as {m}" for m in judging.METRICS) + " from ({1}) where {2}"


@query(_SUM.format("human", model_queries.ORACLE["summary_metrics"], "source_view = 'contribution'") + " union all " + _SUM.format("generated", model_queries.ORACLE["summary_metrics"], "source_view <> 'contribution'"))
def metric_summary_table(spark, folder):
    """The metrics of a human and a generated dataset, one row each."""
    m = model_queries.summary_metrics(spark, folder)
    one = lambda rows, name: judging.merged_metrics(rows).select(F.lit(name).alias("dataset"), "query_count", *judging.METRICS)
    return one(m.where("source_view = 'contribution'"), "human").unionByName(one(m.where("source_view <> 'contribution'"), "generated"))


@query(f"""with s as (select avg(v) as m from (select {QUERY_TOKENS_SQL}::double as v from queries where source_view = 'contribution')) select paper_id, qpos, greatest(0.0, 1.0 - abs({QUERY_TOKENS_SQL} - m) / 2.0) as similarity from queries, s where query_text is not null""")
def human_similarity(spark, folder):
    """How near the length of every query is to the mean of one view."""
    q = table(spark, folder, "queries").where("query_text is not null").withColumn("v", tx.token_count(F.col("query_text")).cast("double"))
    mean = q.where("source_view = 'contribution'").agg(F.avg("v").alias("m"))
    return q.join(F.broadcast(mean)).select("paper_id", "qpos", tx.similarity_to(F.col("v"), F.col("m")).alias("similarity"))


@query(rf"""select paper_id, pos, coalesce(nullif(regexp_replace(regexp_replace({_STRIP('title')}, '[^\p{{L}}\p{{N}}_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'generated_queries') as dataset_slug, coalesce(nullif({_STRIP('abstract')}, ''), nullif({_STRIP('title')}, ''), 'none') as first_text,
case upper(replace(trim(venue), ' ', '_')) when 'ICLR' then true when 'NEURIPS' then true when 'NIPS' then true when 'ICML' then true else coalesce(replace(trim(venue), ' ', '_') in ('ICLR.cc', 'NeurIPS.cc', 'ICML.cc'), false) end as fallback from papers""")
def paper_texts(spark, folder):
    """Names of datasets, first texts that are not blank, and venues that are only fall-back names."""
    p = table(spark, folder, "papers")
    return p.select("paper_id", "pos", tx.dataset_slug(F.col("title")).alias("dataset_slug"), F.coalesce(tx.nonempty(F.col("abstract"), F.col("title")), F.lit("none")).alias("first_text"), tx.is_fallback_venue(F.col("venue")).alias("fallback"))


QUERIES, ORACLE = _C.queries, _C.oracle
