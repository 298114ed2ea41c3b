"""Shards from a two-pass external shuffle. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.shared import Scratch

SHARDS = 8
SEED = 20_240_229
#: What a bucket holds on average: it is shuffled in the memory of one task.
BUCKET_BYTES = 16 << 20
_BLOCK = 4096  # buckets whose counts are added up in one place


def utf8_size(text: Column) -> Column:
    """Bytes of a text (null: none) plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def stored_record(docs: DataFrame) -> DataFrame:
    """``docs``, read from files, with the column ``record``: a number that follows from the name of
    the file and the row's place in it. It is the same in every scan and every retry, and says nothing about
    the row, so that repeated rows and null keys are told apart."""
    where = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return docs.select("*", where.alias("record"))


def bucket_of(record: Column, buckets: int, seed: int = SEED) -> Column:
    """The bucket a record is scattered into: uniform and seeded."""
    return F.pmod(F.xxhash64(F.lit(seed), record), F.lit(buckets)).cast("int")


def bucket_starts(counts: DataFrame) -> DataFrame:
    """``(bucket, start)`` from ``counts(bucket, n)``: how many rows stand in the buckets before.
    Summed in two levels, so that one task sees one number per block of buckets at most."""
    block = F.floor(F.col("bucket") / _BLOCK).alias("block")
    of_block = counts.groupBy(block).agg(F.sum("n").alias("n_block"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block_start = of_block.select(
        "block", F.coalesce(F.sum("n_block").over(before), F.lit(0)).alias("block_start")
    )
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return counts.withColumn("block", block).join(block_start, "block").select(
        "bucket",
        (F.col("block_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"),
    )


def shuffled(rows: DataFrame, buckets: int, seed: int = SEED) -> DataFrame:
    """``(bucket, rows)`` from ``rows(record, row)``: each bucket gathered in one task, put into the order
    of its records, and shuffled by Fisher-Yates (``shuffle`` is that). A bucket is of a fixed expected size
    whatever the rows hold, so the group is bounded."""
    gathered = (
        rows.withColumn("bucket", bucket_of(F.col("record"), buckets, seed))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "record")
        .groupBy("bucket")
        .agg(F.collect_list("row").alias("rows"))
    )
    return gathered.select("bucket", F.shuffle("rows", seed).alias("rows"))


def write_shards(
    docs: DataFrame,
    folder: str,
    shards: int = SHARDS,
    text: str = "text",
    record: str = "record",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Writes all of ``docs`` into ``folder/shard=0 ...`` in one random order and returns what was written: ``(row,
    place, shard, slot)``. ``row`` holds the columns of ``docs`` without ``record``; ``place`` is the position in the
    whole order, of which shard *s* of *S* is the stretch from floor(s n / S) on, so the counts are at most
    one apart; ``slot`` runs from 0 without gaps.

    ``record`` is a number per row that does not change between scans (``stored_record``); it alone decides where a row
    goes, so null keys, null texts, repeated rows and a text or key that a third of the rows share spread like any
    others. Very long texts make a bucket longer by their own length. An empty table gives empty
    shards. First pass: the records are scattered over buckets, by one exchange. Second: each is shuffled and
    written. How many rows a bucket has is counted beforehand from the record numbers alone; that count meets the
    buckets by a join on the bucket, broadcast only where its size is below Spark's limit, and co-located
    otherwise.
    """
    scratch = Scratch(docs.sparkSession)
    total = docs.agg(F.sum(utf8_size(F.col(text))).alias("bytes"), F.count("*").alias("n")).first()
    n, buckets = total["n"], max(shards, -(-(total["bytes"] or 0) // bucket_bytes))
    counts = docs.select(bucket_of(F.col(record), buckets, seed).alias("bucket")).groupBy(
        "bucket"
    ).agg(F.count(F.lit(1)).alias("n"))
    starts = scratch.table("starts", bucket_starts(counts))
    columns = [name for name in docs.columns if name != record]
    rows = docs.select(F.col(record).alias("record"), F.struct(*columns).alias("row"))
    placed = shuffled(rows, buckets, seed).join(starts, "bucket").select(
        "start", F.posexplode("rows").alias("at", "row")
    ).select((F.col("start") + F.col("at")).alias("place"), "row")
    last = F.lit(max(n, 1)).cast("long")
    shard = F.call_function("div", (F.col("place") + 1) * shards - 1, last)
    slot = F.col("place") - F.call_function("div", shard * last, F.lit(shards).cast("long"))
    out = placed.select("row", "place", slot.alias("slot"), shard.cast("int").alias("shard"))
    out.write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(out.schema).parquet(folder)
