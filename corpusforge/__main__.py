"""Command line: `python -m corpusforge run --stages 0-5 --data DIR --out DIR`, `... queries`, `... query NAME --data DIR`."""

from __future__ import annotations

import argparse
import sys

from corpusforge.plans import registry, stages
from corpusforge.session import local_session
from corpusforge.sources import files
from corpusforge.sources.tables import table

SETTINGS = ("accept", "literals", "words", "most_density", "least_mentions", "skip_filter", "limit", "most_results")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusforge")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run stages one after the other, each resuming from its own output")
    run.add_argument("--stages", default="0-5")
    run.add_argument("--data", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--config", help="settings as JSON or YAML")
    run.add_argument("--skip-filter", action="store_true")
    run.add_argument("--limit", type=int)
    commands.add_parser("queries", help="list the named queries")
    one = commands.add_parser("query", help="show one named query")
    one.add_argument("name")
    one.add_argument("--data", required=True)
    one.add_argument("--rows", type=int, default=20)
    args = parser.parse_args(argv)
    if args.command == "queries":
        print("\n".join(registry.queries()))
        return 0
    spark = local_session()
    if args.command == "query":
        registry.queries()[args.name](spark, args.data).show(args.rows, truncate=60)
        return 0
    given = files.settings(args.config, {})
    settings = stages.Settings(**{k: v for k, v in given.items() if k in SETTINGS})
    settings.skip_filter = settings.skip_filter or args.skip_filter
    settings.limit = args.limit if args.limit is not None else settings.limit
    papers = table(spark, args.data, "papers").select("paper_id", "title", "abstract", "pos")
    index = table(spark, args.data, "candidates").selectExpr("query_text as search_query", "struct(cand_pos, cand_id) as rank", "cand_id", "paper_title", "arxiv_id", "abstract", "venue", "year", "authors", "url", "pdf_url").distinct()
    out = stages.run(args.stages, stages.default_work(spark, papers, index, settings), args.out)
    print(f"{stages.parse_spec(args.stages)[-1]}: {out.count()} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
