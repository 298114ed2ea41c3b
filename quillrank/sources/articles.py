"""News articles: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.schema import ARTICLE, PARAGRAPH

# What ranking reads of an article. A JSON reader prunes whole columns but not the fields
# inside an array of structs, so the narrow form is a read schema of its own.
RANKING_FIELDS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("contents", T.ArrayType(T.StructType([
        T.StructField("content", T.StringType()),
        T.StructField("subtype", T.StringType()),
    ]))),
])


def read_articles(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ARTICLE,
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Typed articles from JSON lines. A line that is no JSON fails the job; with
    ``mode="PERMISSIVE"`` and a ``corrupt_column`` it is kept there as text instead."""
    reader = spark.read.option("mode", mode)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def parse_articles(lines: DataFrame, column: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """The same for JSON text that already sits in a table column."""
    parsed = F.from_json(F.col(column), ARTICLE, {"mode": mode})
    return lines.select(parsed.alias("article")).select("article.*")


def checked_articles(
    spark: SparkSession, path: str, schema: T.StructType = ARTICLE
) -> tuple[DataFrame, DataFrame]:
    """``(articles, corrupt)`` from JSON lines: every line that can be read as an article of ``schema``, and ``(file,
    line)`` of every line that is no JSON or has a field of another type. Blank lines are neither."""
    corrupt = "_corrupt_line"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("line"),
        F.from_json("value", wide, options).alias("article"),
    )
    fields = [F.col("article")[name].alias(name) for name in schema.names]
    good = lines.where(F.col("article")[corrupt].isNull()).select(*fields)
    return good, lines.where(F.col("article")[corrupt].isNotNull()).select("file", "line")


def corrupt_counts(corrupt: DataFrame) -> DataFrame:
    """``(file, n_lines)``: how many corrupt lines a file has."""
    return corrupt.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"))


def write_articles(articles: DataFrame, path: str) -> None:
    """Articles as JSON lines, null fields left out."""
    articles.write.json(path)


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Plain documents ``(doc_id, text, source)`` in article shape: the first line is the
    title, every further line with something on it is a paragraph."""
    lines = F.split("text", "\n")
    items = F.transform(
        F.slice(lines, F.lit(2), F.size(lines)),
        lambda line: F.struct(*[
            line.alias("content") if field.name == "content"
            else F.when(F.trim(line) != "", F.lit(PARAGRAPH)).alias("subtype")
            if field.name == "subtype"
            else F.lit(None).cast("string").alias(field.name)
            for field in ARTICLE["contents"].dataType.elementType
        ]),
    )
    empty = F.lit(None).cast("string")
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        empty.alias("article_url"),
        F.get(lines, F.lit(0)).alias("title"),
        empty.alias("author"),
        F.lit(None).cast("long").alias("published_date"),
        items.alias("contents"),
        empty.alias("type"),
        F.col("source"),
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores, where the scan has fewer tasks than there are cores: a file with one
    row group is one task however many cores wait for it. A table with tasks enough is left alone."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = rows._jdf.queryExecution().toRdd().getNumPartitions()
    return rows.repartition(cores) if tasks < cores else rows
