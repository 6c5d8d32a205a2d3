"""Queries of predicates, scalar functions and query analytics over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusforge.functions import templates as tpl
from corpusforge.functions import text as tx
from corpusforge.operators import rules, stats
from corpusforge.plans.base import Catalog
from corpusforge.sources.tables import table

_C = Catalog()
query = _C.query

# Parameters of the rule queries: words that occur in the data.
ACCEPT, LITERALS, WORDS = ["novelty", "well written", "accept"], ["figure", "line"], ["figure", "equation", "table", "results"]
DENSITY, LEAST = 0.02, 2

_TOKENS = r"len(list_filter(regexp_split_to_array(text, '[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+'), lambda t: t <> ''))"
_COUNT = lambda w: f"((length(lower(text)) - length(replace(lower(text), '{w}', ''))) / {len(w)})"
_WORD = lambda w: rf"len(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}\x{{200C}}\x{{200D}}]+'), lambda t: t = '{w}'))"
_FLAGS = f"""
  select doc_id, lang, {" or ".join(f"contains(lower(text), '{w}')" for w in ACCEPT)} as has_accept,
    case when {_TOKENS} > 0 then ({" + ".join(map(_COUNT, LITERALS))})::double / {_TOKENS} >= {DENSITY} else 0.0 >= {DENSITY} end as is_similar,
    {" + ".join(map(_WORD, WORDS))} >= {LEAST} as has_mentions
  from documents"""


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_flags(table(spark, folder, "documents"), "text", ACCEPT, LITERALS, DENSITY, WORDS, LEAST)


@query(f"select doc_id, has_accept, is_similar, has_mentions, has_accept and not is_similar and has_mentions as passed from ({_FLAGS})")
def rule_flags_per_doc(spark, folder):
    """Every document with its rule flags."""
    return _flags(spark, folder).select("doc_id", "has_accept", "is_similar", "has_mentions", "passed")


@query(f"select lang, count(*) as n_input, count(*) filter (where has_accept and not is_similar and has_mentions) as n_passed from ({_FLAGS}) group by lang")
def rule_filter_funnel(spark, folder):
    """Documents in and through the rules, by language code."""
    return _flags(spark, folder).groupBy("lang").agg(F.count("*").alias("n_input"), F.count_if("passed").alias("n_passed"))


@query(f"""select source, count(*) as n, avg(v) as mean, stddev_pop(v) as std, min(v) as min, max(v) as max, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.25) as p25, quantile_cont(v, 0.75) as p75
from (select source, {_TOKENS}::double as v from documents) group by source""")
def token_length_stats(spark, folder):
    """Token statistics of the documents by source."""
    return stats.length_stats(table(spark, folder, "documents"), tx.token_count(F.col("text")), ["source"])


@query("""select note_kind, count(v) as n, avg(v) as mean, stddev_pop(v) as std, min(v) as min, max(v) as max, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.25) as p25, quantile_cont(v, 0.75) as p75
from (select note_kind, length(text)::double as v from documents) group by note_kind""")
def char_length_stats(spark, folder):
    """Character statistics of the documents by kind of note."""
    return stats.length_stats(table(spark, folder, "documents"), F.length("text"), ["note_kind"])


QUERY_TOKENS_SQL = _TOKENS.replace("(text,", "(query_text,")


@query(f"""with c as (select source_view, greatest(ceil({QUERY_TOKENS_SQL} / 5.0) - 1, 0)::bigint as bin, count(*) as n from queries where query_text is not null group by 1, 2)
select source_view, bin, n, n / sum(n) over (partition by source_view) as share from c where source_view is not null""")
def word_count_bins5(spark, folder):
    """Word counts of the queries in bins of five, by view."""
    return stats.bins(table(spark, folder, "queries").where("source_view is not null"), tx.token_count(F.col("query_text")), 5, ["source_view"])


@query(f"""with r as (select source_view as g, {QUERY_TOKENS_SQL} as v from queries where source_view is not null and query_text is not null), span as (select min(v) as lo, max(v) as hi from r),
spine as (select g, unnest(range(lo, hi + 1)) as v from (select distinct g from r), span)
select s.g as source_view, s.v::int as value, count(r.v) as n from spine s left join r on r.g = s.g and r.v = s.v group by 1, 2""")
def length_hist_unit(spark, folder):
    """Word counts of the queries, one bin per whole number, shared by all views."""
    return stats.unit_histogram(table(spark, folder, "queries"), tx.token_count(F.col("query_text")), "source_view")


_CASE = "case " + " ".join(f"when regexp_matches(lower(trim(query_text)), '{p.replace(chr(39), chr(39) * 2)}') then {i}" for i, (p, _) in enumerate(tpl.TEMPLATES)) + " end"
_NAMES = "[" + ", ".join("'" + n.replace("'", "''") + "'" for _, n in tpl.TEMPLATES) + "]"
_RANKED = f"(select paper_id, qpos, query_text, {_CASE} as r from queries)"
NAMED_SQL = f"(select paper_id, qpos, query_text, r, coalesce({_NAMES}[r + 1], 'other') as template from {_RANKED})"


def _templates(spark: SparkSession, folder: str) -> DataFrame:
    q = table(spark, folder, "queries").withColumn("r", tpl.template_rank(F.col("query_text")))
    return q.withColumn("template", tpl.template_name(F.col("r")))


@query(f"select paper_id, qpos, length(query_text) as char_length, {QUERY_TOKENS_SQL} as token_length, template, r is not null as matched from {NAMED_SQL}")
def template_detect(spark, folder):
    """Every query with its lengths and question template."""
    return _templates(spark, folder).select("paper_id", "qpos", F.length("query_text").alias("char_length"), tx.token_count(F.col("query_text")).alias("token_length"), "template", F.col("r").isNotNull().alias("matched"))


@query(f"select template, count(*) as n, count(*) / (select count(*) from queries) as ratio from {NAMED_SQL} group by template")
def template_distribution(spark, folder):
    """Count and share of every template over all queries."""
    q = _templates(spark, folder)
    counts = q.groupBy("template").agg(F.count("*").alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))  # a window over the few templates


@query(f"select template, k, paper_id, qpos from (select *, row_number() over (partition by template order by paper_id, qpos) as k from {NAMED_SQL}) where k <= 3")
def template_top3_examples(spark, folder):
    """The first three queries of every template."""
    k = F.row_number().over(W.partitionBy("template").orderBy("paper_id", "qpos"))
    return _templates(spark, folder).withColumn("k", k).where("k <= 3").select("template", "k", "paper_id", "qpos")


@query(f"""with t as {NAMED_SQL}, b as (select template, min((paper_id, qpos)) as first from t group by template), per as (select greatest(1, 15 // count(*)) as m from b),
n as (select t.template, paper_id, qpos, first, row_number() over (partition by t.template order by paper_id, qpos) as k from t join b on b.template = t.template)
select template, paper_id, qpos from n, per where k <= m order by first, k limit 15""")
def representative_examples(spark, folder):
    """Fifteen queries over the templates in first-seen order, the same number of each."""
    q = _templates(spark, folder)
    first = q.groupBy("template").agg(F.min(F.struct("paper_id", "qpos")).alias("first"))
    per = first.agg(F.greatest(F.lit(1), F.floor(F.lit(15) / F.count("*"))).alias("m"))
    k = F.row_number().over(W.partitionBy("template").orderBy("paper_id", "qpos"))
    ranked = q.select("template", "paper_id", "qpos").withColumn("k", k).where("k <= 15").join(first, "template").join(F.broadcast(per), F.col("k") <= F.col("m"))
    return ranked.orderBy("first", "k").limit(15).select("template", "paper_id", "qpos")


@query("select venue, count(*) filter (where rating between 1 and 5) as n_scored, count(*) as n, avg(greatest(0.0, 1.0 - abs(rating - 3) / 2.0)) filter (where rating between 1 and 5) as fit from papers group by venue")
def centered_fit_summary(spark, folder):
    """How near the ratings of each venue are to the middle of the scale."""
    score = tx.score_1_to_5(F.col("rating"))
    return table(spark, folder, "papers").groupBy("venue").agg(F.count(score).alias("n_scored"), F.count("*").alias("n"), F.avg(tx.centered_fit(score.cast("double"))).alias("fit"))


@query("""with s as (select unnest(range(1, 6))::int as score), v as (select rating as score, count(*) as n from papers where rating between 1 and 5 group by 1)
select s.score, coalesce(n, 0) as n, coalesce(n, 0) / (select sum(n) from v) as share from s left join v on v.score = s.score""")
def score_histogram(spark, folder):
    """Ratings of one to five on a full spine."""
    score = tx.score_1_to_5(F.col("rating"))
    counts = table(spark, folder, "papers").where(score.isNotNull()).groupBy(score.alias("score")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    spine = spark.range(1, 6).select(F.col("id").cast("int").alias("score"))
    full = spine.join(counts, "score", "left").select("score", F.coalesce("n", F.lit(0)).alias("n"))
    return full.join(F.broadcast(total)).select("score", "n", (F.col("n") / F.col("t")).alias("share"))


@query("""select avg(rating * 1.0) as plain, sum(m * n) / sum(n) as merged from (select venue, avg(rating) as m, count(rating) as n from papers group by venue having count(rating) > 0), (select avg(rating) as rating from papers)""")
def weighted_mean_merge(spark, folder):
    """Means of groups merged by their sizes, beside the mean of all."""
    p = table(spark, folder, "papers")
    groups = p.groupBy("venue").agg(F.avg("rating").alias("m"), F.count("rating").alias("n"))
    merged = groups.agg(stats.weighted_mean(F.col("m"), F.col("n")).alias("merged"))
    return p.agg(F.avg("rating").alias("plain")).join(F.broadcast(merged))


_PAIR = ("contribution", "experiment/result")


@query(f"""with r as (select case source_view when '{_PAIR[0]}' then 0 else 1 end as s, {QUERY_TOKENS_SQL}::double as x from queries where source_view in {_PAIR} and query_text is not null),
c as (select x, count(*) filter (where s = 0) as na, count(*) filter (where s = 1) as nb from r group by x),
d as (select (sum(na) over (order by x)) / (sum(na) over ()) as fa, (sum(nb) over (order by x)) / (sum(nb) over ()) as fb, lead(x) over (order by x) - x as dx from c)
select coalesce(sum(abs(fa - fb) * dx), 0.0) as distance from d""")
def wasserstein_views(spark, folder):
    """Distance of the word counts of two views."""
    q = table(spark, folder, "queries").withColumn("x", tx.token_count(F.col("query_text")))
    return stats.wasserstein(q, "x", "source_view", *_PAIR)


@query(f"""with r as (select source_view as s, {QUERY_TOKENS_SQL}::double as x from queries where source_view in {_PAIR} and query_text is not null),
c as (select x, count(*) filter (where s = '{_PAIR[0]}') as na, count(*) filter (where s = '{_PAIR[1]}') as nb from r group by x),
d as (select (sum(na) over (order by x)) / (sum(na) over ()) as fa, (sum(nb) over (order by x)) / (sum(nb) over ()) as fb, lead(x) over (order by x) - x as dx from c),
w as (select sum(abs(fa - fb) * dx) as w from d), sd as (select stddev_pop(x) as s from r where s = '{_PAIR[0]}')
select w as distance, exp(-w / (s + 1e-8)) as closeness, least(1.0, greatest(0.0, 1.0 - w / 4.0)) as scale_closeness from w, sd""")
def human_closeness(spark, folder):
    """Closeness of one view's word counts to another's, from their distance."""
    q = table(spark, folder, "queries").withColumn("x", tx.token_count(F.col("query_text")))
    w = stats.wasserstein(q, "x", "source_view", *_PAIR)
    sd = q.where(F.col("source_view") == _PAIR[0]).agg(F.stddev_pop("x").alias("s"))
    d = F.col("distance")
    return w.join(F.broadcast(sd)).select("distance", F.exp(-d / (F.col("s") + 1e-8)).alias("closeness"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - d / 4.0)).alias("scale_closeness"))


@query(r"""select paper_id, pos, case when venueid is null then null when len(p) >= 3 and lower(p[1]) = 'aclweb.org' then array_to_string(p[1:3], '/')
 when len(p) >= 3 and regexp_matches(p[3], '^(19|20)\d{2}$') then array_to_string(p[1:3], '/') when len(p) >= 4 and regexp_matches(p[4], '^(19|20)\d{2}$') then array_to_string(p[1:4], '/')
 when len(p) >= 2 and lower(p[2]) in ('acl', 'emnlp', 'naacl', 'eacl', 'arr') then array_to_string(p[1:2], '/') when len(p) >= 1 then p[1] end as venue_path,
 try_cast(nullif(regexp_extract(venue, '\b((?:19|20)\d{2})\b', 1), '') as int) as venue_year, replace(trim(venue), ' ', '_') as venue_key
from (select *, list_filter(string_split(venueid, '/'), lambda x: x <> '') as p from papers)""")
def venue_year_extract(spark, folder):
    """Venue of a path, year in a venue, venue as a key."""
    return table(spark, folder, "papers").select("paper_id", "pos", tx.venue_of_path(F.col("venueid")).alias("venue_path"), tx.year_in(F.col("venue")).alias("venue_year"), tx.venue_id(F.col("venue")).alias("venue_key"))


@query(r"""select cand_id, coalesce(nullif(regexp_extract(pdf_url, '(?i)[\w.-]+/(?:abs|pdf)/([0-9]+\.[0-9]+)', 1), ''), nullif(regexp_extract(pdf_url, '\b([0-9]{4}\.[0-9]{4,5})(?:v\d+)?\b', 1), '')) as archive_id,
 coalesce(regexp_matches(pdf_url, '(?i)https?://\S+\.pdf(\?.*)?$'), false) as is_pdf from (select distinct cand_id, pdf_url from candidates)""")
def archive_pdf_extract(spark, folder):
    """Archive numbers and direct PDF links."""
    c = table(spark, folder, "candidates").select("cand_id", "pdf_url").distinct()
    return c.select("cand_id", tx.archive_id(F.col("pdf_url")).alias("archive_id"), tx.is_pdf_link(F.col("pdf_url")).alias("is_pdf"))


@query(r"""select paper_id, pos, substr(sha1(title), 1, 12) as short_id, coalesce(nullif(left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), ''), 'item') as slug from papers""")
def slug_and_sha1_ids(spark, folder):
    """Path-safe and hashed forms of the titles."""
    return table(spark, folder, "papers").select("paper_id", "pos", tx.short_hash(F.col("title")).alias("short_id"), tx.slug(F.col("title")).alias("slug"))


@query("""select paper_id, qpos, (coalesce(list_sum(list_transform(range(1, length(query_text) + 1), lambda i: i * unicode(substr(query_text, i, 1))::bigint)), 0) % 1000000007)::bigint::varchar as field_id
from queries where query_text is not null""")
def stable_field_id(spark, folder):
    """Position-weighted code point sums as ids."""
    return table(spark, folder, "queries").where("query_text is not null").select("paper_id", "qpos", tx.field_id(F.col("query_text")).alias("field_id"))


@query("""select id, try_cast(json_extract_string(nullif(regexp_extract('Answer: ' || feedback_raw_json || ' -- end', '\\{[\\s\\S]*\\}', 0), ''), '$.relevance') as varchar) as relevance from human_feedback where feedback_raw_json is not null""".replace("\\\\", "\\"))
def json_from_prose(spark, folder):
    """A field of a JSON object that stands in prose."""
    h = table(spark, folder, "human_feedback").where("feedback_raw_json is not null")
    prose = F.concat(F.lit("Answer: "), F.col("feedback_raw_json"), F.lit(" -- end"))
    return h.select("id", F.try_variant_get(tx.json_in_prose(prose), "$.relevance", "string").alias("relevance"))


@query("""select paper_id, pos, case when rating between 1 and 5 then rating end as score, greatest(0, coalesce(num_citations, 0)) as citations, greatest(0.0, 1.0 - abs(case when rating between 1 and 5 then rating end - 3) / 2.0) as fit_or_zero from papers where rating between 1 and 5
union all by name select paper_id, pos, null as score, greatest(0, coalesce(num_citations, 0)) as citations, null as fit_or_zero from papers where rating is null or rating not between 1 and 5""")
def score_parse(spark, folder):
    """Scores outside the scale as null, counts below zero as zero."""
    score = tx.score_1_to_5(F.col("rating").cast("string"))
    return table(spark, folder, "papers").select("paper_id", "pos", score.alias("score"), tx.non_negative(F.col("num_citations")).alias("citations"), F.when(score.isNotNull(), tx.centered_fit(score.cast("double"))).alias("fit_or_zero"))


@query("""select paper_id, pos, list_filter([case when trim(title) <> '' then trim(title) end, case when array_to_string(keywords[1:4], ' ') <> '' and lower(array_to_string(keywords[1:4], ' ')) <> lower(trim(coalesce(title, ''))) then array_to_string(keywords[1:4], ' ') end], lambda x: x is not null)[2] as second,
 len(list_filter([case when trim(title) <> '' then 1 end, case when array_to_string(keywords[1:4], ' ') <> '' then 1 end], lambda x: x is not null)) as n from papers where title is not null and keywords is not null""")
def search_variants(spark, folder):
    """Title and keywords as search queries."""
    v = tx.search_variants(F.col("title"), F.col("keywords"))
    return table(spark, folder, "papers").where("title is not null and keywords is not null").select("paper_id", "pos", F.get(v, F.lit(1)).alias("second"), F.size(v).alias("n"))


@query(r"""select doc_id, length(trim(regexp_replace(text, '[\s\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0b]+', ' ', 'g'), ' ')) as squeezed, length(text) as n_chars from documents""")
def squeezed_length(spark, folder):
    """Length with and without repeated white space."""
    return table(spark, folder, "documents").select("doc_id", F.length(tx.squeeze(F.col("text"))).alias("squeezed"), F.length("text").alias("n_chars"))


QUERIES, ORACLE = _C.queries, _C.oracle
