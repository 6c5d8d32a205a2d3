"""Queries of the stages that ask a text model: summaries, query generation, judging, and the analysis made from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import templates as tpl
from corpusforge.functions import text as tx
from corpusforge.operators import judging, mocks, summaries, textmodel
from corpusforge.plans.base import Catalog
from corpusforge.plans.text_queries import NAMED_SQL, QUERY_TOKENS_SQL
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

_D = lambda i, h="h": f"(strpos('0123456789abcdef', substr({h}, {i}, 1)) - 1)"
_LAST = "(select paper_id, arg_max({'t': title, 'a': abstract}, pos) as m from papers group by 1)"
_HASHED = f"(select paper_id, m.t as title, sha1('Title: ' || coalesce(m.t, '') || chr(10) || 'Abstract: ' || coalesce(m.a, '')) as h from {_LAST})"
_VIEWS = "(select unnest(range(4)) as view_pos, unnest(['" + "', '".join(summaries.VIEWS) + "']) as view_name)"
_SHAPED = f"""(select paper_id, title, h, view_pos, view_name, case substr(h, view_pos::int + 2, 1) when '0' then 0 else {_D('view_pos::int + 2')} % 4 end as shape from {_HASHED}, {_VIEWS} where substr(h, 1, 1) <> '0')"""


def _papers(spark, folder):
    """The last row of every paper."""
    last = F.max_by(F.struct("title", "abstract"), "pos").alias("m")
    return table(spark, folder, "papers").groupBy("paper_id").agg(last).select("paper_id", "m.*")


def _summary_model(prompt: str) -> str:
    return mocks.summary_model(prompt, summaries.VIEWS)


def _summarised(spark, folder):
    prompt = textmodel.rendered("Title: {{title}}\nAbstract: {{abstract}}", {"title": F.col("title"), "abstract": F.col("abstract")})
    out = textmodel.answered(_papers(spark, folder).withColumn("prompt", prompt), "prompt", _summary_model)
    return out.select("paper_id", "title", "abstract", summaries.parsed_views(F.col("answer")).alias("views"))


@query(f"""select paper_id, view_pos::int as view_pos, view_name, case shape when 2 then 's' || substr(h, 9, 3) end as summary, case shape when 0 then 0 when 2 then 1 else 2 end::int as n_bullets,
case shape when 1 then 'b' || substr(h, 6, 3) when 2 then 'x' || substr(h, 12, 3) when 3 then 't' end as first_text, case shape when 2 then 1 when 3 then 2 else 0 end::int as n_refs from {_SHAPED}
union all select paper_id, 0, 'general', null, 1, 'No summary ' || h, 0 from {_HASHED} where substr(h, 1, 1) = '0'""")
def summarize_mock(spark, folder):
    """Papers summarised by view: one call per paper, bullets of any shape brought to one."""
    views = _summarised(spark, folder).select("paper_id", F.posexplode("views").alias("view_pos", "v"))
    refs = F.aggregate("v.bullets", F.lit(0), lambda n, b: n + F.size(b["source_refs"]))
    return views.select("paper_id", "view_pos", "v.view_name", "v.summary", F.size("v.bullets").alias("n_bullets"), F.get("v.bullets", F.lit(0))["text"].alias("first_text"), refs.alias("n_refs"))


_PART = """'### ' || view_name || chr(10) || case shape when 0 then '' when 1 then '1. b' || substr(h, 6, 3) || chr(10) || '2. c' || chr(10)
when 2 then 'Summary: s' || substr(h, 9, 3) || chr(10) || '1. x' || substr(h, 12, 3) || chr(10) else '1. t' || chr(10) || '2. u' || chr(10) end"""
_SUMMARY_TEXT = f"""(select paper_id, title, string_agg({_PART}, chr(10) order by view_pos) as summary from {_SHAPED} group by 1, 2
union all select paper_id, title, '### general' || chr(10) || '1. No summary ' || h || chr(10) from {_HASHED} where substr(h, 1, 1) = '0')"""


@query(f"select paper_id, md5(summary) as digest from {_SUMMARY_TEXT}")
def summary_text(spark, folder):
    """Summaries as text, as their digest."""
    return _summarised(spark, folder).select("paper_id", F.md5(summaries.summary_text(F.col("views"))).alias("digest"))


@query(f"""with g as (select paper_id, sha1('Title: ' || coalesce(title, '') || chr(10) || summary) as h from {_SUMMARY_TEXT}), made as (select * from g where substr(h, 1, 1) <> '0')
select paper_id, 0 as qpos, 'q' || substr(h, 2, 3) as query_text, true as is_multimodal, 'contribution' as source_view, 2 as related_bullet_indice, null as related_bullet_justification from made
union all select paper_id, 1, 'z' || substr(h, 5, 3), true, 'contribution', null, 'j' from made union all select paper_id, 2, 'plain  ' || substr(h, 8, 2), true, 'contribution', null, null from made
union all select paper_id, 3, 'w' || substr(h, 10, 3), false, 'limitation/scope', null, null from made union all select paper_id, 0, 'none ' || h, false, 'general', null, null from g where substr(h, 1, 1) = '0'""")
def generate_queries_mock(spark, folder):
    """Queries made from the summaries: one call per paper, objects and plain text, old names of fields."""
    s = _summarised(spark, folder).withColumn("summary", summaries.summary_text(F.col("views")))
    prompt = textmodel.rendered("Title: {{title}}\n{{summary}}", {"title": F.col("title"), "summary": F.col("summary")})
    out = textmodel.answered(s.select("paper_id", prompt.alias("prompt")), "prompt", mocks.query_model)
    return summaries.queries_in(out, "answer", ["paper_id"])


_LINES = r"""(select *, sha1(place || '. ' || regexp_replace(coalesce(query_text, ''), '[\r\n]+', ' ', 'g')) as h from (select paper_id, qpos, query_text, source_view, row_number() over (partition by paper_id, qpos // 50 order by qpos) as place, count(*) over (partition by paper_id, qpos // 50) as n_lines from queries))"""
_VERDICT = f"case when {_D(1)} % 5 in (0, 1) and not (place = n_lines and n_lines % 3 = 0) then 'PASS' else 'FAIL' end"
_SPEC, _NATURAL, _COUNT = f"case when {_D(1)} % 7 between 1 and 5 then {_D(1)} % 7 end", f"case when {_D(2)} % 6 between 1 and 5 then {_D(2)} % 6 end", f"greatest(0, {_D(3)} - 4)"
_ANALYSIS = f"""(select l.paper_id, l.qpos, l.source_view, {_VERDICT} as full_paper_reliance, case {_VERDICT} when 'PASS' then 'Keep' else 'Hard Reject' end as decision, ({_SPEC})::int as specificity, ({_NATURAL})::int as naturalism, ({_COUNT})::int as constraints,
length(l.query_text) as char_length, {QUERY_TOKENS_SQL.replace('query_text', 'l.query_text')} as token_length, t.template as question_template from {_LINES} l join {NAMED_SQL} t on t.paper_id = l.paper_id and t.qpos = l.qpos)"""


@query(f"select paper_id, qpos, {_VERDICT} as full_paper_reliance, case {_VERDICT} when 'PASS' then 'Keep' else 'Hard Reject' end as decision, case when place = n_lines and n_lines % 3 = 0 then '' else substr(h, 2, 3) end as reasoning from {_LINES}")
def retrieval_judge_mock(spark, folder):
    """Whether a query can be answered without the whole paper, judged in prompts of up to fifty."""
    j = judging.retrieval_judged(table(spark, folder, "queries"), mocks.retrieval_model)
    return j.select("paper_id", "qpos", "full_paper_reliance", textmodel.relied_on(F.col("full_paper_reliance")).alias("decision"), "reasoning")


@query(f"select paper_id, qpos, ({_SPEC})::int as specificity, ({_NATURAL})::int as naturalism, ({_COUNT})::int as constraints, substr(h, 4, 3) as rationale from {_LINES}")
def style_scores_mock(spark, folder):
    """Scores and counts of every query; what is outside its scale is null or zero."""
    return judging.style_judged(table(spark, folder, "queries"), mocks.style_model)


def _analysis(spark, folder):
    """Every query with its rule metrics, verdict and scores."""
    q = table(spark, folder, "queries")
    on = ["paper_id", "qpos"]
    rule = q.select(*on, "query_text", "source_view", F.length("query_text").alias("char_length"), tx.token_count(F.col("query_text")).alias("token_length"), tpl.template_name(tpl.template_rank(F.col("query_text"))).alias("question_template"))
    verdicts = judging.retrieval_judged(q, mocks.retrieval_model).select(*on, "full_paper_reliance", textmodel.relied_on(F.col("full_paper_reliance")).alias("decision"))
    return rule.join(verdicts, on, "left").join(judging.style_judged(q, mocks.style_model).drop("rationale"), on, "left")


@query(f"select a.paper_id, q.qpos, a.decision, a.specificity, a.constraints from queries q left join {_ANALYSIS} a on a.paper_id = q.paper_id and a.qpos = q.qpos")
def query_analysis_join(spark, folder):
    """Queries beside their analysis, looked up by text and view within the paper."""
    key = ["paper_id", "query_text", "source_view"]
    a = _analysis(spark, folder).select(*key, "decision", "specificity", "constraints")
    return table(spark, folder, "queries").select(*key, "qpos").join(a, key, "left").select("paper_id", "qpos", "decision", "specificity", "constraints")


@query(f"""select count(*) as n_queries, count(*) filter (where decision = 'Keep') as n_keep, count(*) filter (where decision = 'Hard Reject') as n_hard_reject, count(*) filter (where full_paper_reliance = 'PASS') as n_pass, count(*) filter (where full_paper_reliance = 'FAIL') as n_fail,
avg(char_length) as char_length_mean, min(char_length) as char_length_min, max(char_length) as char_length_max, avg(token_length) as token_length_mean, min(token_length) as token_length_min, max(token_length) as token_length_max,
avg(specificity) as specificity_mean, avg(naturalism) as naturalism_mean, avg(constraints) as constraints_mean, (select string_agg(t || '=' || n, '; ' order by t collate "C") from (select question_template as t, count(*) as n from {_ANALYSIS} group by 1)) as question_templates from {_ANALYSIS}""".replace(' collate "C"', ""))
def analysis_summary(spark, folder):
    """One row about all analysed queries."""
    one = judging.analysis_totals(_analysis(spark, folder))
    shown = F.array_join(F.transform("question_templates", lambda t: F.concat(t["question_template"], F.lit("="), t["n"].cast("string"))), "; ")
    return one.withColumn("question_templates", shown)


@query(f"""with p as (select distinct paper_id from papers) select p.paper_id, count(a.qpos) as n_queries, count(*) filter (where a.decision = 'Keep') as n_keep, count(*) filter (where a.decision = 'Hard Reject') as n_hard_reject from p left join {_ANALYSIS} a on a.paper_id = p.paper_id group by 1""")
def paper_decision_stats(spark, folder):
    """Queries of every known paper by decision; papers without queries have zeros."""
    counts = _analysis(spark, folder).groupBy("paper_id").agg(F.count("*").alias("n_queries"), F.count_if(F.col("decision") == "Keep").alias("n_keep"), F.count_if(F.col("decision") == "Hard Reject").alias("n_hard_reject"))
    return table(spark, folder, "papers").select("paper_id").distinct().join(counts, "paper_id", "left").select("paper_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_queries", "n_keep", "n_hard_reject")])


_FIT = lambda c: f"avg(greatest(0.0, 1.0 - abs({c} - 3) / 2.0)) filter (where {c} is not null)"
_METRICS = f"""(select source_view, count(*) as query_count, coalesce(avg(char_length), 0.0) as avg_chars, coalesce(avg(token_length), 0.0) as avg_tokens, avg(constraints) as constraints_per_query, coalesce(avg(specificity), 0.0) as specificity_score, coalesce({_FIT('specificity')}, 0.0) as specificity_fit,
coalesce(avg(naturalism), 0.0) as lexical_score, coalesce({_FIT('naturalism')}, 0.0) as lexical_fit, count(*) filter (where question_template = 'other') / count(*) as unmatched_ratio from {_ANALYSIS} group by 1)"""


@query(f"select * from {_METRICS}")
def summary_metrics(spark, folder):
    """The metrics that reports compare, by view."""
    return judging.summary_metrics(_analysis(spark, folder), "source_view")


@query(f"select sum(query_count)::bigint as query_count, {', '.join(f'sum({m} * query_count) / sum(query_count) as {m}' for m in judging.METRICS)} from {_METRICS}")
def merged_summary_metrics(spark, folder):
    """The metrics of all views in one, weighted by their queries."""
    return judging.merged_metrics(judging.summary_metrics(_analysis(spark, folder), "source_view"))


_STAT = lambda c: f"select '{c}' as metric, count({c}) as n, avg({c})::double as mean, stddev_pop({c})::double as std, min({c})::double as min, max({c})::double as max, quantile_cont({c}::double, 0.5) as median, avg(({c} > 0)::int)::double as share_positive from {_ANALYSIS}"


@query(" union all ".join(map(_STAT, ("specificity", "naturalism", "constraints"))))
def judge_metric_stats(spark, folder):
    """Statistics of both scores and of the counts over the queries that have them."""
    long = _analysis(spark, folder).select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in ("specificity", "naturalism", "constraints")])))
    return long.groupBy("metric").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"), F.percentile("x", 0.5).alias("median"), F.avg((F.col("x") > 0).cast("int")).alias("share_positive")
    )


@query(f"select paper_id, qpos, constraints, specificity, naturalism from {_ANALYSIS} where specificity is not null and naturalism is not null")
def paired_judge_scores(spark, folder):
    """Queries that both judges gave results for."""
    j = judging.style_judged(table(spark, folder, "queries"), mocks.style_model)
    return judging.paired_scores(j, j, ["paper_id", "qpos"])


_SIDES = ("contribution", "experiment/result")
_CDF = lambda m: f"""(select coalesce(sum(abs(fa - fb) * dx), 0.0) as w from (select sum(na) over (order by x) / sum(na) over () as fa, sum(nb) over (order by x) / sum(nb) over () as fb, lead(x) over (order by x) - x as dx
from (select {m}::double as x, count(*) filter (where source_view = '{_SIDES[0]}') as na, count(*) filter (where source_view = '{_SIDES[1]}') as nb from f group by 1)))"""  # noqa: E731


@query(f"""with f as (select * from {_ANALYSIS} where source_view in {_SIDES} and specificity is not null and naturalism is not null), d as (select c.w as w_constraints, s.w as w_specificity, n.w as w_naturalism from {_CDF('constraints')} c, {_CDF('specificity')} s, {_CDF('naturalism')} n),
h as (select *, exp(-w_constraints / ((select stddev_pop(constraints) from f where source_view = '{_SIDES[0]}') + 1e-8)) as hc_constraints, least(1.0, greatest(0.0, 1 - w_specificity / 4.0)) as hc_specificity, least(1.0, greatest(0.0, 1 - w_naturalism / 4.0)) as hc_naturalism from d)
select *, (hc_constraints + hc_specificity + hc_naturalism) / 3 as hc_overall from h""")
def closeness_overall(spark, folder):
    """How close the queries of one view are to those of another, over three judged metrics."""
    a = _analysis(spark, folder).where(F.col("source_view").isin(*_SIDES))
    return judging.human_closeness(a, "source_view", *_SIDES)


QUERIES, ORACLE = _C.queries, _C.oracle
