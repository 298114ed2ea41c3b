"""Batch job around ``rank_documents``.

    python -m quillrank.plans.job --queries queries.txt --articles news.jsonl --out results/run1

The session's settings (master, memory, ``spark.checkpoint.dir``) come from spark-submit.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quillrank.plans.rank import search
from quillrank.schema import MAX_PARAGRAPHS, MIN_TITLE_DISTANCE, TOP_K
from quillrank.sources.articles import RANKING_FIELDS, checked_articles, read_articles
from quillrank.sources.queries import read_queries
from quillrank.sources.rankings import write_ranking_files, write_ranking_table
from quillrank.sources.workspace import Workspace


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quillrank", description=__doc__)
    parser.add_argument("--queries", required=True, help="text file, one query per line")
    parser.add_argument("--articles", required=True, help="JSON lines, one article per line")
    parser.add_argument("--out", required=True, help="output folder of this run")
    parser.add_argument("--format", choices=("text", "parquet"), default="text")
    parser.add_argument("--results", type=int, default=TOP_K)
    parser.add_argument("--min-distance", type=float, default=MIN_TITLE_DISTANCE)
    parser.add_argument("--max-paragraphs", type=int, default=MAX_PARAGRAPHS)
    parser.add_argument("--work-dir", help="shared folder for the tables of the run")
    parser.add_argument(
        "--quarantine",
        help="folder for corrupt lines (file, line); without it such a line fails the job",
    )
    parser.add_argument("--cf-mode", choices=("per_query", "corpus"), default="per_query")
    parser.add_argument("--ratio", choices=("floor", "exact"), default="floor")
    return parser.parse_args(argv)


def _articles(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.quarantine is None:
        return read_articles(spark, args.articles, RANKING_FIELDS)
    articles, corrupt = checked_articles(spark, args.articles, RANKING_FIELDS)
    corrupt.write.parquet(args.quarantine)
    return articles


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    with Workspace(spark, args.work_dir) as space:
        rankings = search(
            space,
            read_queries(spark, args.queries),
            _articles(spark, args),
            k=args.results,
            min_distance=args.min_distance,
            max_paragraphs=args.max_paragraphs,
            cf_mode=args.cf_mode,
            ratio=args.ratio,
        )
        write = write_ranking_files if args.format == "text" else write_ranking_table
        write(rankings, args.out)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    running = SparkSession.getActiveSession()
    spark = running or SparkSession.builder.appName("quillrank").getOrCreate()
    try:
        run(spark, args)
    finally:
        if running is None:
            spark.stop()


if __name__ == "__main__":
    main()
