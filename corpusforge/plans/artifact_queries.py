"""Queries of the assembled artifact, text-model calls, forum source and event windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusforge.functions import text as tx
from corpusforge.operators import artifact, judging, mocks, textmodel
from corpusforge.plans.base import Catalog
from corpusforge.sources import forum
from corpusforge.sources.tables import table
from corpusforge.session import shared_dir
from corpusforge.streaming.resume import resumed, windowed_counts

_C = Catalog()
query = _C.query

_CAND = "(select distinct cand_id, paper_id, query_text, source_view, cand_pos, label, paper_title, url, reason from candidates where label in ('hard_negative', 'positive'))"


def _artifact(spark, folder):
    t = lambda n: table(spark, folder, n)
    return artifact.assembled(t("papers"), t("queries"), t("candidates"))


@query(f"""select q.paper_id, q.qpos, c.label, row_number() over (partition by q.paper_id, q.qpos, c.label order by c.cand_pos, c.cand_id) as k, c.cand_id
from queries q join {_CAND} c on c.paper_id = q.paper_id and c.query_text = q.query_text and c.source_view = q.source_view""")
def artifact_flattened(spark, folder):
    """The assembled artifact taken apart again."""
    return artifact.flattened(_artifact(spark, folder))


@query(f"""select (select count(distinct paper_id) from papers) as n_papers, (select count(*) from queries) as n_queries, count(*) filter (where label = 'hard_negative') as n_hard_negatives, count(*) filter (where label = 'positive') as n_positives
from queries q join {_CAND} c on c.paper_id = q.paper_id and c.query_text = q.query_text and c.source_view = q.source_view""")
def artifact_totals(spark, folder):
    """Counts of the assembled artifact."""
    return artifact.totals(_artifact(spark, folder))


@query("select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark, folder):
    """Events by hour and type (an extension)."""
    out = windowed_counts(table(spark, folder, "events"), "ts", "event_type")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""select cand_id, ['positive', 'hard_negative', 'ignored'][('0x' || substr(h, 1, 2))::int % 3 + 1] as label, (('0x' || substr(h, 3, 2))::int % 5 + 1)::int as score
from (select cand_id, sha1('Query: ' || coalesce(query_text, '') || chr(10) || 'Paper: ' || coalesce(paper_title, '') || chr(10) || 'Answer as JSON.') as h from (select distinct cand_id, query_text, paper_title from candidates))""")
def review_mock(spark, folder):
    """Candidates labelled by the mock model: one call per distinct prompt, answers read from JSON in prose."""
    c = table(spark, folder, "candidates").select("cand_id", "query_text", "paper_title").distinct()
    prompt = textmodel.rendered("Query: {{query}}\nPaper: {{paper}}\nAnswer as JSON.", {"query": F.col("query_text"), "paper": F.col("paper_title")})
    out = textmodel.answered(c.withColumn("prompt", prompt), "prompt", mocks.label_model)
    return out.select("cand_id", textmodel.in_answer(F.col("answer"), "$.label").alias("label"), textmodel.in_answer(F.col("answer"), "$.score", "int").alias("score"))


@query(r"""select paper_id, qpos, (('0x' || substr(sha1(place || '. ' || regexp_replace(coalesce(query_text, ''), '[\r\n]+', ' ', 'g')), 3, 2))::int % 5 + 1)::int as score
from (select paper_id, qpos, query_text, row_number() over (partition by paper_id, qpos // 50 order by qpos) - 1 as place from queries)""")
def style_judge_mock(spark, folder):
    """Queries judged in prompts of up to fifty of a paper, answers joined back by place."""
    asked = judging.paged_prompts(table(spark, folder, "queries"), first=0)
    out = textmodel.answered(asked, "prompt", mocks.list_model)
    items = judging.zipped_items(out, F.try_variant_get(tx.object_in_prose(F.col("answer")), "$.results", "array<variant>"))
    return items.select("paper_id", "qpos", F.coalesce(F.try_variant_get("item", "$.score", "int"), F.lit(0)).alias("score"))


@query("select 'paper_' || y || '_' || i as paper_id, 'Stub paper ' || i || ' of ' || y as title, '' as abstract, 'Stub' as venue, y::int as year, '' as authors, ((2024 - y) * 10 + i)::bigint as pos from range(2023, 2025) a(y), range(10) b(i) where (2024 - y) * 10 + i < 12")
def forum_stub(spark, folder):
    """Stub papers of the offline forum client."""
    return forum.fetched(spark, [2023, 2024], limit=12).withColumn("authors", F.array_join("authors", "|"))


@query("select source_view, count(*) as n, 0 as n_again from queries group by 1")
def stream_resume(spark, folder):
    """Queries worked off as a stream of files into the shared folder; a second run over the same input adds nothing."""
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = table(spark, folder, "queries")
    run = lambda: resumed(spark, f"{folder}/queries.parquet*", q.schema.simpleString()[7:-1].replace(":", " "), lambda d: d.groupBy("source_view").agg(F.count("*").alias("n")), f"{at}/out", f"{at}/done")
    run()
    again = run()
    return spark.read.parquet(f"{at}/out").groupBy("source_view").agg(F.sum("n").alias("n"), F.lit(again).alias("n_again"))


QUERIES, ORACLE = _C.queries, _C.oracle
