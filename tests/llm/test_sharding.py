from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.llm import sharding
from quillrank.llm.shared import Scratch
from tests.llm.helpers import docs_of, odd_docs


def written(spark, docs, record=None, **options):
    docs = docs.withColumn("record", F.monotonically_increasing_id() if record is None else record)
    stored = Scratch(spark).table("in", docs)
    return sharding.write_shards(stored, f"{Scratch(spark).folder}/out", **options)


def test_shards_hold_every_row_once_and_differ_by_one_at_most(spark):
    texts = [f"text {i} " * (1 + i % 7) for i in range(203)]
    rows = written(spark, docs_of(spark, texts), shards=8, bucket_bytes=1024).collect()
    assert sorted(r.row.doc_id for r in rows) == list(range(203))
    assert sorted(r.place for r in rows) == list(range(203))
    sizes = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(slots == list(range(len(slots))) for slots in sizes.values())
    assert {len(slots) for slots in sizes.values()} == {25, 26}
    order = [r.shard for r in sorted(rows, key=lambda r: r.place)]
    assert order == sorted(order)


def test_order_is_random_but_the_same_in_every_run(spark):
    docs = docs_of(spark, ["x"] * 400)
    first, again = (
        [r.row.doc_id for r in sorted(written(spark, docs, bucket_bytes=64, seed=seed).collect(),
                                      key=lambda r: r.place)]
        for seed in (1, 1)
    )
    other = [r.row.doc_id for r in sorted(
        written(spark, docs, bucket_bytes=64, seed=2).collect(), key=lambda r: r.place
    )]
    assert first == again != other != sorted(other)
    steps = sum(b == a + 1 for a, b in zip(first, first[1:], strict=False))
    assert steps < 12
    halves = sum(first.index(i) < 200 for i in range(200))
    assert 75 < halves < 125


def test_fisher_yates_reaches_every_order_alike(spark):
    """600 buckets of three rows: each of the six orders about 100 times."""
    rows = spark.range(1800).select(F.col("id").alias("record"), F.struct("id").alias("row"))
    orders = (
        rows.withColumn("bucket", F.floor(F.col("record") / 3)).groupBy("bucket")
        .agg(F.sort_array(F.collect_list("record")).alias("rows"))
        .select(F.transform(F.shuffle("rows", 7), lambda r: r % 3).alias("order"))
        .groupBy("order").count().collect()
    )
    assert len(orders) == 6 and all(60 < r["count"] < 145 for r in orders)


def test_hot_rows_spread_over_buckets(spark):
    docs = docs_of(spark, ["same text"] * 3000).withColumn("doc_id", F.lit(None).cast("long"))
    stored = docs.withColumn("record", F.monotonically_increasing_id())
    buckets = stored.select(sharding.bucket_of(F.col("record"), 30).alias("bucket"))
    counts = buckets.groupBy("bucket").count()
    found = [r["count"] for r in counts.collect()]
    assert len(found) == 30 and max(found) < 160


def test_bucket_starts_over_many_blocks(spark):
    counts = spark.range(10_000).select(
        F.col("id").cast("int").alias("bucket"), (F.col("id") % 3).alias("n")
    )
    starts = {r.bucket: r.start for r in sharding.bucket_starts(counts).collect()}
    total = 0
    for bucket in range(10_000):
        assert starts[bucket] == total
        total += bucket % 3


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    rows = written(spark, docs)
    assert rows.select("row.*").columns == docs.columns
    assert sorted(map(str, rows.select("row.*").collect())) == sorted(map(str, docs.collect()))
    assert written(spark, docs.where("false")).count() == 0
    assert written(spark, docs_of(spark, ["one"])).select("shard", "slot").first() is not None


def test_record_numbers_come_from_the_files(spark):
    path = f"{Scratch(spark).folder}/docs"
    docs_of(spark, ["a"] * 50).repartition(3).write.parquet(path)
    read = sharding.stored_record(spark.read.parquet(path))
    assert read.select("record").distinct().count() == 50
    told = {(r.doc_id, r.record) for r in read.repartition(7).collect()}
    assert told == {(r.doc_id, r.record) for r in read.select("doc_id", "record").collect()}
