"""The registered corpus queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import TABLES, rows_of
from quillrank.llm import registry
from tests.llm.helpers import odd_docs

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    frame = registry.queries()[name](spark, SF_DIR)
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, cursor.fetchall())


def test_every_operator_has_one_query():
    names = list(registry.queries())
    assert names[-1] == "pipeline"
    assert [name.split("_")[0] for name in names[:-1]] == [f"op{n}" for n in range(1, 14)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR)
        if name != "encode_pieces":
            assert docs.columns == before.columns
        if name == "language_id":
            assert docs.count() == before.where(F.col("text").rlike(r"\p{L}")).count()
        if name == "line_dedup":
            assert docs.count() == before.count()
            assert docs.where("n_chars <> length(text)").isEmpty()
        if name == "near_dedup":
            assert 0 < docs.count() < before.count()
    assert docs.where("n_tokens = 0 or ids is null").isEmpty() and not docs.isEmpty()


def test_pipeline_stages_on_odd_rows(spark):
    for docs in (odd_docs(spark), odd_docs(spark).where("false")):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()
