"""Stage plans: which stages of a run a specification names, in their order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import templates as tpl
from corpusforge.functions import text as tx
from corpusforge.operators import dedupe, judging, mining, mocks, rules, summaries, textmodel
from corpusforge.sources import files

#: Stages in running order.
STAGES = ("download", "filter", "summarize", "generate-queries", "query-analysis", "hard-negative-mining")


def stage_name(text: str, stages: tuple[str, ...] = STAGES) -> str:
    """A stage by name (underscores and case do not matter) or number."""
    plain = text.strip().lower().replace("_", "-")
    if plain.isdigit() and int(plain) < len(stages):
        return stages[int(plain)]
    if plain in stages:
        return plain
    raise ValueError(f"unknown stage: {text!r}")


def parse_spec(spec: str, stages: tuple[str, ...] = STAGES) -> list[str]:
    """'0-5', 'generate-queries', '1,2': the named stages in running order; they must follow on each other."""
    chosen: set[int] = set()
    for piece in filter(None, (p.strip() for p in spec.split(","))):
        try:
            chosen.add(stages.index(stage_name(piece, stages)))
            continue
        except ValueError:
            if "-" not in piece:
                raise
        first, last = (stages.index(stage_name(x, stages)) for x in piece.split("-", 1))
        if first > last:
            raise ValueError(f"descending range: {piece!r}")
        chosen |= set(range(first, last + 1))
    if not chosen:
        raise ValueError("no stage given")
    order = sorted(chosen)
    if order != list(range(order[0], order[-1] + 1)):
        raise ValueError(f"stages are not contiguous: {spec!r}")
    return [stages[i] for i in order]


def run(spec: str, work: dict[str, Callable], folder: str, given=None):
    """Run stages one after the other; each gets what the one before returned and the path of its own output."""
    out = given
    for name in parse_spec(spec):
        out = work[name](out, output_path(folder, name))
    return out


@dataclass
class Settings:
    """What the stages need besides their input. Models are callables from prompt to answer; the mocks answer by rule."""

    accept: list[str] = field(default_factory=lambda: ["accept"])
    literals: list[str] = field(default_factory=lambda: ["arxiv"])
    words: list[str] = field(default_factory=lambda: ["figure", "table"])
    most_density: float = 0.05
    least_mentions: int = 2
    skip_filter: bool = False
    limit: int | None = None
    most_results: int = 10
    summary_model: textmodel.Model = lambda prompt: mocks.summary_model(prompt, summaries.VIEWS)
    query_model: textmodel.Model = mocks.query_model
    retrieval_model: textmodel.Model = mocks.retrieval_model
    style_model: textmodel.Model = mocks.style_model
    keyword_model: textmodel.Model = mocks.keyword_model
    review_model: textmodel.Model = mocks.review_model


def output_path(folder: str, name: str) -> str:
    return str(PurePosixPath(folder) / f"{STAGES.index(name):02d}_{name}")


def resumed_stage(spark: SparkSession, targets: DataFrame, key: str, path: str, work: Callable[[DataFrame], DataFrame], pos: str = "pos") -> DataFrame:
    """The results for the targets (key, pos, ...): those kept from earlier runs that are still wanted, and work(rest) for the rest.

    Only what is missing is done; a run writes its own part folder, so one that fails leaves earlier parts
    as they are. Results are in the order of the targets.
    """
    done = spark.read.parquet(f"{path}/part=*") if files.exists(spark, path) else None
    todo = targets if done is None else dedupe.missing_from(targets, done, [key])
    if todo.limit(1).count():
        parts = files.count_folders(spark, path)
        work(todo).write.mode("errorifexists").parquet(f"{path}/part={parts:06d}")
    return dedupe.in_first_order(dedupe.still_wanted(spark.read.parquet(f"{path}/part=*"), targets, [key]), targets, key, pos) if files.exists(spark, path) else work(targets.limit(0))


def filtered(papers: DataFrame, s: Settings) -> DataFrame:
    """papers (paper_id, title, abstract, pos) with the flags of the rules and passed."""
    if s.skip_filter:
        return papers.withColumns({"has_accept": F.lit(True), "is_similar": F.lit(False), "has_mentions": F.lit(True), "passed": F.lit(True)})
    text = F.concat_ws(" ", "title", "abstract")
    return rules.rule_flags(papers.withColumn("_t", text), "_t", s.accept, s.literals, s.most_density, s.words, s.least_mentions).drop("_t")


def summarised(passed: DataFrame, s: Settings) -> DataFrame:
    """(paper_id, title, abstract, pos, views) of papers."""
    prompt = textmodel.rendered("Title: {{title}}\nAbstract: {{abstract}}", {"title": F.col("title"), "abstract": F.col("abstract")})
    out = textmodel.answered(passed.select("paper_id", "title", "abstract", "pos", prompt.alias("_prompt")), "_prompt", s.summary_model)
    return out.select("paper_id", "title", "abstract", "pos", summaries.parsed_views(F.col("answer")).alias("views"))


def queried(summarised_papers: DataFrame, s: Settings) -> DataFrame:
    """(paper_id, pos, qpos, query_text, ...) made from summaries."""
    prompt = textmodel.rendered("Title: {{title}}\n{{summary}}", {"title": F.col("title"), "summary": summaries.summary_text(F.col("views"))})
    out = textmodel.answered(summarised_papers.select("paper_id", "pos", prompt.alias("_prompt")), "_prompt", s.query_model)
    return summaries.queries_in(out, "answer", ["paper_id", "pos"])


def analysed(queries: DataFrame, s: Settings) -> DataFrame:
    """queries with lengths, template, verdict, decision and scores."""
    on = ["paper_id", "qpos"]
    rule = queries.withColumns({"char_length": F.length("query_text"), "token_length": tx.token_count(F.col("query_text")), "question_template": tpl.template_name(tpl.template_rank(F.col("query_text")))})
    verdicts = judging.retrieval_judged(queries, s.retrieval_model).withColumn("decision", textmodel.relied_on(F.col("full_paper_reliance")))
    return rule.join(verdicts, on, "left").join(judging.style_judged(queries, s.style_model), on, "left")


def mined(analysed_queries: DataFrame, index: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """mining.mined for the queries that are kept."""
    keep = analysed_queries.where("decision = 'Keep'").select("paper_id", "qpos", "query_text", "source_view")
    return mining.mined(keep, index, ["paper_id", "qpos"], "query_text", s.keyword_model, s.review_model, s.most_results)


def default_work(spark: SparkSession, papers: DataFrame, index: DataFrame, s: Settings) -> dict[str, Callable]:
    """The work of every stage for run(): each resumes from its own folder, takes what the one before wrote and gives what it wrote."""
    def stage(make: Callable[[DataFrame], DataFrame], pick: Callable[[DataFrame], DataFrame] = lambda d: d) -> Callable:
        return lambda given, path: resumed_stage(spark, pick(given), "paper_id", path, make)

    first = lambda given, path: resumed_stage(spark, papers if given is None else given, "paper_id", path, lambda d: d)
    passed = lambda d: rules.first_passed(d, ["pos"], s.limit)
    return {
        "download": first, "filter": stage(lambda d: filtered(d, s)), "summarize": stage(lambda d: summarised(d, s), passed), "generate-queries": stage(lambda d: queried(d, s)),
        "query-analysis": stage(lambda d: analysed(d, s)), "hard-negative-mining": stage(lambda d: mined(d, index, s)[1].join(d.select("paper_id", "pos").distinct(), "paper_id")),
    }
