"""Order and cut within a query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scores are compared to nine decimals, so that the order in which an engine happens to add
# up terms cannot reorder documents; ties go to the lower document id.
SCORE_DIGITS = 9


# A query's rows are cut in this many parts before they meet.
PARTS = 64


def _ranked(scores: DataFrame, groups: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    order = [F.desc("ordering"), *[F.asc(name) for name in tie_break]]
    return (
        scores.withColumn("ordering", F.round("score", SCORE_DIGITS))
        .withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
        .drop("ordering")
    )


def rank_in_query(scores: DataFrame, tie_break: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Adds ``rank``, 1 for the highest score."""
    return _ranked(scores, ["query_id"], tie_break)


def part_of(row_id: Column) -> Column:
    """One of ``PARTS`` about equal parts of the rows."""
    return F.pmod(F.xxhash64(row_id), F.lit(PARTS)).cast("int")


def top_ranked(
    scores: DataFrame, n: int, tie_break: Sequence[str] = ("doc_id",), in_parts: bool = False
) -> DataFrame:
    """The first ``n`` per query. Spark cuts every partition to ``n`` rows per query before
    the exchange (WindowGroupLimit), so a query matched by a third of the corpus still sends
    only ``n`` rows per task. ``in_parts``: what tasks have sent meets by query and a ``PARTS``-th of the
    tasks first, and each such part is cut to ``n`` again, so the task that sees a whole query reads
    ``PARTS`` times ``n`` rows, however many tasks have sent some."""
    if in_parts:
        parts = scores.withColumn("part", F.spark_partition_id() % PARTS)
        scores = _ranked(parts, ["query_id", "part"], tie_break).where(
            F.col("rank") <= n
        ).drop("rank", "part")
    return rank_in_query(scores, tie_break).where(F.col("rank") <= n)
