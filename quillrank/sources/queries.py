"""Queries: one per line of a text file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.functions.text import STOPWORDS, TOKEN_PATTERN, terms


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``(original_query)``, one row per line."""
    return spark.read.text(path).select(F.col("value").alias("original_query"))


def distinct_queries(queries: DataFrame) -> DataFrame:
    """``(query_id, original_query, n_lines)``: equal lines are one query, identified by its
    text, which remembers how many lines it came from."""
    return (
        queries.groupBy("original_query")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .select(F.col("original_query").alias("query_id"), "original_query", "n_lines")
    )


def parse_queries(
    queries: DataFrame,
    token_pattern: str = TOKEN_PATTERN,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """Adds ``query_terms`` (order and repeats kept) and ``query_term_counts`` (all 1)."""
    parsed = queries.withColumn(
        "query_terms", terms(F.col("original_query"), token_pattern, stopwords)
    )
    return parsed.withColumn(
        "query_term_counts",
        F.array_repeat(F.lit(1).cast("smallint"), F.size("query_terms")),
    )
