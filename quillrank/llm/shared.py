"""Helpers of the corpus operators: tables in the shared folder, held-out splits, text pieces."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contracts: what separates words, and what is stripped from lines.
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where none is set (tests), one below the
    session's warehouse. Never a folder that only one machine sees."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/llm-work").rstrip("/")


class Scratch:
    """Tables written once and read often. A written table cuts lineage, so the loss of an
    executor costs its running tasks and never the steps before; random decisions are made
    once. The tables stay until ``drop()``, as results are read from them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def table(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def bucketed(self, name: str, rows: DataFrame, key: str, buckets: int) -> DataFrame:
        """A table whose rows stand by the hash of ``key``, so that a join on it moves the other side alone.
        The catalog knows it only while it is opened."""
        table = f"llm_{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}"
        rows.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
        opened = self.spark.table(table)
        opened.schema  # noqa: B018 (resolved while the catalog has it)
        self.spark.sql(f"DROP TABLE {table}")
        return opened

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(key: Column, n: int) -> Column:
    """``crc32`` of the key as text, modulo ``n``; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def bounded_share(key: Column, share: Column) -> Column:
    """True for about ``share`` of the keys, picked by hash, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < share * float(1 << 30)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def chunks(texts: list[str], limit: int = 4_000_000):
    """Index ranges of consecutive texts with at most ``limit`` characters together (or one
    text that is longer), so that working memory does not follow the size of a batch."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def give_back() -> None:
    """Freed memory goes back to the system. A Python worker is kept for later tasks, and what its
    allocators hold on to counts beside what the tasks of the next stage need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, and ``give_back`` when its frame is gone."""
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidied
