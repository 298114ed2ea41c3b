from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from quillrank.plans import job
from quillrank.schema import ARTICLE, CONTENT_FIELDS
from quillrank.sources import articles, queries, rankings
from quillrank.sources.workspace import Workspace, shared_folder

from helpers import queries_frame

LINES = [
    '{"id":"a1","article_url":"http://x/a1","title":"Harbour bonds rise","author":"N. N.",'
    '"published_date":1325376562000,"contents":[{"content":"News","type":"kicker",'
    '"mime":"text/plain","unknown":1},{"content":"Bonds of the harbour rose.",'
    '"subtype":"paragraph","type":"sanitized_html","mime":"text/html"},null,{"content":132}],'
    '"type":"article","source":"Example","extra":{"x":1}}',
    '',
    '{"id":"a2","title":null,"contents":null}',
]

RANKED = [("marta bond", 1, "d1", 4.123456789012345, "Bond, Marta"),
          ("marta bond", 2, "d2", 5.0, "Café"), ("finance", 1, "d9", float("-inf"), "")]


@pytest.fixture
def news(tmp_path):
    path = tmp_path / "news.jsonl"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


@pytest.fixture
def ranked(spark):
    rows = spark.createDataFrame(
        RANKED, "query_id string, rank int, doc_id string, score double, title string")
    return rows.withColumn("original_query", F.col("query_id"))


def test_articles(spark, news):
    frame = articles.read_articles(spark, news)
    assert frame.schema == ARTICLE and len(CONTENT_FIELDS) == 13
    first, second = sorted(frame.collect(), key=lambda r: r.id)
    assert first.published_date == 1325376562000
    assert first.contents[2] is None and first.contents[3].content == "132"
    assert (second.title, second.contents, second.published_date) == (None, None, None)
    lines = spark.read.text(news).where("value <> ''")
    assert sorted(articles.parse_articles(lines).collect()) == sorted(frame.collect())
    narrow = articles.read_articles(spark, news, articles.RANKING_FIELDS)
    assert narrow.columns == ["id", "title", "contents"] and narrow.count() == 2


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"id":"a"}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        articles.read_articles(spark, str(path)).collect()
    kept = articles.read_articles(spark, str(path), mode="PERMISSIVE", corrupt_column="_corrupt")
    assert {r.id: r["_corrupt"] for r in kept.collect()} == {"a": None, None: "{oops"}


def test_queries(spark, tmp_path):
    path = tmp_path / "queries.list"
    path.write_text("finance\nmarta bond\non Lakeside IPO\nfinance\n")
    parsed = queries.parse_queries(queries.distinct_queries(queries.read_queries(spark, str(path))))
    rows = {r.query_id: r for r in parsed.collect()}
    assert rows["finance"].n_lines == 2 and rows["finance"].query_terms == ["financ"]
    assert rows["on Lakeside IPO"].query_terms == ["lakesid", "ipo"]
    assert rows["marta bond"].query_term_counts == [1, 1]
    assert dict(parsed.dtypes)["query_term_counts"] == "array<smallint>"


def test_ranking_text(ranked):
    texts = {r.query_file: r.ranking for r in rankings.ranking_text(ranked).collect()}
    assert texts == {
        "marta_bond": "marta bond\n  1:d1 4.123456789012345 Bond, Marta\n  2:d2 5.0 Café\n",
        "finance": "finance\n  1:d9 -Infinity \n",
    }


def test_one_file_per_query(spark, ranked, tmp_path):
    out = str(tmp_path / "run")
    rankings.write_ranking_files(ranked, out)
    files = glob.glob(f"{out}/query_file=marta_bond/*.txt")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as file:
        text = file.read()
    assert text == "marta bond\n  1:d1 4.123456789012345 Bond, Marta\n  2:d2 5.0 Café\n"
    rankings.write_ranking_table(ranked, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3


def test_a_slash_in_a_query_is_escaped(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a/b c", "a/b c", 1, "d", 1.0, "t")],
        "query_id string, original_query string, rank int, doc_id string, score double, title string")
    rankings.write_ranking_files(rows, str(tmp_path / "run"))
    back = spark.read.schema("value string, query_file string").text(str(tmp_path / "run"))
    assert {r.query_file for r in back.collect()} == {"a/b_c"}


@pytest.mark.parametrize("form", ["text", "parquet"])
def test_job(spark, news, tmp_path, form):
    path = tmp_path / "queries.list"
    path.write_text("harbour bonds\nnothing of it\n")
    out = str(tmp_path / "out")
    job.main(["--queries", str(path), "--articles", news, "--out", out, "--format", form])
    if form == "parquet":
        rows = spark.read.parquet(out).collect()
        assert [(r.original_query, r.doc_id, r.title) for r in rows] == [
            ("harbour bonds", "a1", "Harbour bonds rise")]
    else:
        lines = [r.value for r in spark.read.text(f"{out}/query_file=harbour_bonds").collect()]
        assert lines[0] == "harbour bonds" and lines[1].startswith("  1:a1 ")


def test_documents_as_articles(spark):
    rows = spark.createDataFrame([(7, "Title\n\nline one\nline two", "s")],
                                 "doc_id bigint, text string, source string")
    article = articles.articles_from_documents(articles.spread(rows)).first()
    assert (article.id, article.title, article.source) == ("7", "Title", "s")
    assert [(c.content, c.subtype) for c in article.contents] == [
        ("", None), ("line one", "paragraph"), ("line two", "paragraph")]


def test_workspace(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as space:
        table = space.table("q", queries_frame(spark, ["a", "b"]))
        assert table.count() == 2
        rows = spark.range(10).groupBy("id").count()
        bucketed = space.bucketed_table("b", rows, ["id"])
        grouped = bucketed.groupBy("id").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        assert set(space.tables) == {"q", "b"}
        result = space.result(bucketed.where("id < 4"))
    assert result.count() == 4 and space.tables == {}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(space.run)]
    assert [name[:17] for name in os.listdir(tmp_path)] == ["quillrank_result_"]
    assert shared_folder(spark)


def test_workspace_is_cleared_after_an_error(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), Workspace(spark, str(tmp_path)) as space:
        space.table("q", queries_frame(spark, ["a"]))
        space.bucketed_table("b", spark.range(3).toDF("id"), ["id"])
        raise ZeroDivisionError
    assert os.listdir(tmp_path) == []
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(space.run)]


def test_quarantine(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text(
        '{"id":"a","contents":[{"content":"x","subtype":"paragraph"}]}\n{oops\n\n'
        '{"id":"b","contents":"no list"}\n{"id":"c","other":1}\n{"id":"d"\n')
    for schema in (ARTICLE, articles.RANKING_FIELDS):
        good, corrupt = articles.checked_articles(spark, str(path), schema)
        assert good.schema == schema
        assert sorted(r.id for r in good.collect()) == ["a", "c"]
        lines = {r.line: r.file for r in corrupt.collect()}
        assert set(lines) == {"{oops", '{"id":"b","contents":"no list"}', '{"id":"d"'}
        assert all(file.endswith("bad.jsonl") for file in lines.values())
        assert [r.n_lines for r in articles.corrupt_counts(corrupt).collect()] == [3]


def test_job_with_corrupt_lines(spark, tmp_path):
    (tmp_path / "news").write_text("\n".join([*LINES, "{broken", '{"id":5,"title":[']) + "\n")
    (tmp_path / "queries").write_text("harbour bonds\n")
    options = ["--queries", str(tmp_path / "queries"), "--articles", str(tmp_path / "news"),
               "--format", "parquet", "--work-dir", str(tmp_path / "work")]
    with pytest.raises(Exception, match="(?i)malformed"):
        job.main([*options, "--out", str(tmp_path / "none")])
    job.main([*options, "--out", str(tmp_path / "out"), "--quarantine", str(tmp_path / "bad")])
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a1"]
    lines = {r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert lines == {"{broken", '{"id":5,"title":['}
    assert os.listdir(tmp_path / "work") == []


def test_spread_leaves_tables_with_tasks_enough(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(10).coalesce(1), spark.range(0, 10, 1, cores + 1)
    assert articles.spread(few).rdd.getNumPartitions() == cores
    assert articles.spread(many) is many


def test_queries_with_one_file_name_keep_apart(spark):
    rows = [("a b", 1, "d1", 1.0, "t"), ("a_b", 1, "d2", 2.0, "u"), ("c d", 1, "d3", 3.0, "v")]
    ranked = spark.createDataFrame(
        rows, "original_query string, rank int, doc_id string, score double, title string"
    ).selectExpr("original_query as query_id", "*")
    files = {r.original_query: r.query_file for r in rankings.ranking_text(ranked).collect()}
    assert files["c d"] == "c_d" and len(set(files.values())) == 3
    assert all(name.startswith("a_b_") for query, name in files.items() if query != "c d")
