"""Rankings as nested rows, as text, and as one file per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranking_nested(rankings: DataFrame) -> DataFrame:
    """``(query_id, original_query, results)``, results in rank order. At most ``k`` rows meet
    in a group: the ranking is cut before it is nested."""
    row = F.struct("rank", "doc_id", "score", "title")
    return rankings.groupBy("query_id", "original_query").agg(
        F.sort_array(F.collect_list(row)).alias("results")
    )


def _score_text(score: Column, decimals: int | None) -> Column:
    if decimals is None:
        return score.cast("string")
    return F.format_string(f"%.{decimals}f", score)


def ranking_text(rankings: DataFrame, decimals: int | None = None) -> DataFrame:
    """``(original_query, query_file, ranking)``: the query on the first line, then two spaces
    and ``rank:docid score title`` per result, every line ended by a newline. Scores are
    written in full unless ``decimals`` is given. ``query_file`` is the query with every
    space replaced by an underscore; queries that would share a name (``a b`` and ``a_b``) get
    a hash of the query behind it."""
    lines = F.transform(
        "results",
        lambda r: F.concat(
            F.lit("  "), r["rank"].cast("string"), F.lit(":"), r["doc_id"], F.lit(" "),
            _score_text(r["score"], decimals), F.lit(" "), r["title"], F.lit("\n"),
        ),
    )
    named = ranking_nested(rankings).withColumn(
        "query_file", F.replace("original_query", F.lit(" "), F.lit("_"))
    )
    shared = F.count(F.lit(1)).over(Window.partitionBy("query_file")) > 1
    suffix = F.concat(F.lit("_"), F.lower(F.hex(F.xxhash64("original_query"))))
    return named.select(
        "original_query",
        F.concat("query_file", F.when(shared, suffix).otherwise("")).alias("query_file"),
        F.concat("original_query", F.lit("\n"), F.array_join(lines, "")).alias("ranking"),
    )


def write_ranking_files(
    rankings: DataFrame, path: str, decimals: int | None = None, mode: str = "errorifexists"
) -> None:
    """One text file per query, in a folder ``query_file=<name>``. A ranking is one row, so it
    is one file; the text sink ends it with the newline that is cut here."""
    text = ranking_text(rankings, decimals).select(
        "query_file", F.expr("left(ranking, length(ranking) - 1)").alias("value")
    )
    text.write.mode(mode).partitionBy("query_file").text(path)


def write_ranking_table(rankings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The flat rows as Parquet."""
    rankings.write.mode(mode).parquet(path)
