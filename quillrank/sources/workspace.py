"""Tables written once and read many times, in a folder every executor can reach.

A table in the shared folder cuts lineage and survives the loss of an executor, and its file
sizes give Catalyst exact statistics: whether a side is small enough to broadcast is decided
by its size, not by a hint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"

def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where none is named, a folder
    below the session's warehouse, which all executors share as well. Never a folder that
    only one machine sees."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/quillrank-work"
    return folder.rstrip("/")


class Workspace:
    """The tables of one run, deleted with their catalog entries when the run is closed:

        with Workspace(spark) as space:
            ...
            return space.result(rows)

    A result is written to a folder of its own and outlives the run; whoever asked for it deletes
    it when it has been used.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.run = f"quillrank_{uuid.uuid4().hex}"
        self.shared = (folder or shared_folder(spark)).rstrip("/")
        self.folder = f"{self.shared}/{self.run}"
        self.tables: dict[str, DataFrame] = {}
        self._bucketed: list[str] = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *raised) -> None:
        self.close()

    def _write(self, path: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def table(self, name: str, rows: DataFrame) -> DataFrame:
        self.tables[name] = self._write(f"{self.folder}/{name}", rows)
        return self.tables[name]

    def result(self, rows: DataFrame) -> DataFrame:
        """Rows that stay when the run is closed."""
        return self._write(f"{self.shared}/quillrank_result_{uuid.uuid4().hex}", rows)

    def bucketed_table(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Rows placed by hash of ``keys``: a later grouping or join on the keys (or on them
        and more) finds them in place and needs no exchange. There are as many buckets as
        the session has shuffle partitions; rows that an aggregate by ``keys`` has just placed are
        written where they are."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        identifier = f"{self.run}_{name}"
        (
            rows.write.format("parquet")
            .bucketBy(buckets, *keys)
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(identifier)
        )
        self._bucketed.append(identifier)
        self.tables[name] = self.spark.table(identifier)
        return self.tables[name]

    def drop(self, name: str) -> None:
        """Delete the files of one table that nothing reads any more."""
        self._delete(f"{self.folder}/{name}")
        del self.tables[name]

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Delete every table of the run, files and catalog entries."""
        for identifier in self._bucketed:
            self.spark.sql(f"DROP TABLE IF EXISTS {identifier}")
        self._bucketed.clear()
        self.tables.clear()
        self._delete(self.folder)
