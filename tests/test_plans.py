"""The plans we want at scale, read from the physical plan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quillrank.operators.dedup import ITEM, TIE_BREAK, survivors
from quillrank.operators.documents import document_matches
from quillrank.operators.matching import query_postings
from quillrank.operators.ranking import top_ranked
from quillrank.operators.scoring import document_scores
from quillrank.operators.sieve import TermSieve
from quillrank.operators.stats import scoring_terms
from quillrank.plans.rank import PLACE, collapse_copies, match_documents, match_table_rows
from quillrank.sources.articles import RANKING_FIELDS, read_articles, write_articles
from quillrank.sources.queries import distinct_queries, parse_queries
from quillrank.sources.workspace import Workspace

from helpers import articles_frame, queries_frame
from test_rank import QUERIES, corpus


KEYS = (*PLACE, "row_id", "doc_id")


def ipo(spark):
    return TermSieve.of(spark.createDataFrame([("ipo",)], "term string"))


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    space = Workspace(spark, str(tmp_path_factory.mktemp("plans")))
    parsed = parse_queries(distinct_queries(queries_frame(spark, QUERIES)))
    postings = space.table("postings", query_postings(parsed))
    matches = match_documents(space, postings, articles_frame(spark, corpus()))
    terms = space.table("terms", scoring_terms(matches, postings))
    yield postings, matches, terms
    space.close()


def test_the_pass_over_the_articles_has_no_exchange(spark, tmp_path):
    path = str(tmp_path / "news")
    write_articles(articles_frame(spark, corpus()), path)
    found = match_table_rows(document_matches(
        read_articles(spark, path, RANKING_FIELDS), ipo(spark)
    ))
    text = plan(found)
    assert "Exchange" not in text and "Python" not in text
    assert "struct<id:string,title:string,contents:array<struct<content:string,subtype:string>>>" in text


def test_the_text_chain_is_not_pushed_into_a_filter(spark):
    found = document_matches(articles_frame(spark, corpus()), ipo(spark))
    from quillrank.operators.matching import document_postings

    text = document_postings(found)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Filter[^\n]*regexp_extract_all", text)
    assert text.count("regexp_extract_all") == 2  # title and body


def test_scores_are_summed_where_the_rows_are(tables):
    _, matches, terms = tables
    text = plan(document_scores(matches, terms, "floor", KEYS))
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastHashJoin" in text and "Bucketed: true" in text


def test_only_the_top_of_each_partition_is_exchanged(tables):
    _, matches, terms = tables
    text = plan(top_ranked(document_scores(matches, terms, "floor", KEYS), 200, TIE_BREAK))
    assert text.count("Exchange hashpartitioning") == 1
    assert re.search(r"Final.*Exchange hashpartitioning\(query_id.*Partial", text, re.S)
    assert text.count("WindowGroupLimit") == 2


def test_a_query_is_cut_in_parts_before_it_meets(tables):
    """In the tasks that scored, in the parts of a query, and in its whole."""
    _, matches, terms = tables
    scores = document_scores(matches, terms, "floor", KEYS)
    text = plan(top_ranked(scores, 200, TIE_BREAK, in_parts=True))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (?:(\w+)#)?", text)
    assert exchanges == [("query_id", ""), ("query_id", "part")]
    assert text.count("WindowGroupLimit") >= 3


def test_later_rounds_spread_a_hot_query(tables, no_broadcast):
    """Between the join that filters a stretch and the window that ranks what is left stands an exchange by
    more than the query; the join itself is by query and part."""
    _, matches, terms = tables
    scores = document_scores(matches, terms, "floor", KEYS)
    open_queries = terms.select("query_id").distinct().select(
        "query_id", F.array().cast(f"array<{ITEM}>").alias("kept"),
        F.array(F.lit(0.0)).alias("bounds"), F.lit(0).alias("stretch"),
    )
    left = survivors(scores, open_queries, lambda rows: rows.join(
        matches.select(*PLACE, "row_id", "title"), [*PLACE, "row_id"]
    ))
    text = plan(top_ranked(left, 200, TIE_BREAK, in_parts=True))
    joins = re.findall(r"SortMergeJoin \[(.*?)\], \[", text)
    assert sum("query_id" in keys and "part" in keys for keys in joins) == 2
    assert "BroadcastExchange" not in text
    window = text.index("WindowGroupLimit")
    assert re.search(r"Exchange hashpartitioning\(query_id#\d+L?, part#\d+", text[window:])
    # titles are read once, for the stretch alone
    assert text.count("title:string") <= 2


def test_one_exchange_between_the_pass_and_the_matches(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as space:
        found = space.table("found", match_table_rows(
            document_matches(articles_frame(spark, corpus()), ipo(spark))
        ))
        text = plan(collapse_copies(found))
        assert text.count("Exchange hashpartitioning") == 1
        grouped = re.findall(r"hashpartitioning\((.*?), \d+\)", text)
        assert [re.sub(r"#\d+L?", "", keys) for keys in grouped] == ["mark, mark_2"]
        again = space.bucketed_table("matches", collapse_copies(found), PLACE)
        assert "Exchange" not in plan(again.groupBy(*PLACE).count())


def test_statistics_read_only_their_columns(tables):
    postings, matches, _ = tables
    text = plan(scoring_terms(matches, postings))
    assert "ReadSchema: struct<dl:bigint>" in text
    assert "ReadSchema: struct<matches:array<struct<term:string,tf:bigint>>>" in text
    assert "CartesianProduct" not in text


def test_untitled_rows_are_cut_in_the_scan(tables):
    _, matches, terms = tables
    text = plan(document_scores(matches, terms).select(F.count("score")))
    assert "PushedFilters: [IsNotNull(title)" in text
