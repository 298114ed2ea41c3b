
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import duck_oracle  # noqa: E402
from quillrank.functions.porter import stem_word  # noqa: E402
from quillrank.functions.text import content_tokens, tokenise  # noqa: E402
from quillrank.functions.titles import title_distance  # noqa: E402
from quillrank.operators import documents as docs  # noqa: E402
from quillrank.operators import matching, ranking, scoring, stats  # noqa: E402
from quillrank.operators.dedup import ruled_out  # noqa: E402
from quillrank.plans import job  # noqa: E402
from quillrank.plans.rank import PLACE, match_documents, rank_documents, search  # noqa: E402
from quillrank.schema import CONTENT_FIELDS  # noqa: E402
from quillrank.sources import articles as art  # noqa: E402
from quillrank.sources import queries as qry  # noqa: E402
from quillrank.sources import rankings as out  # noqa: E402
from quillrank.sources.workspace import Workspace, shared_folder  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = ("th", "enlich enheit", "hetion estion")


# --- inputs ---------------------------------------------------------------------------------

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return art.spread(table.select("doc_id", "text", "source"))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.articles_from_documents(_documents(spark, sf_dir))


def _query_list(spark: SparkSession, lines=duck_oracle.QUERY_LIST) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "original_query string")


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every benchmark text is a query."""
    table = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return table.select(F.explode(F.split("text", "\n")).alias("original_query"))


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/check-{uuid.uuid4().hex}/{name}"


def _matched(spark: SparkSession, sf_dir: str, build: Callable[..., DataFrame]) -> DataFrame:
    """What ``build`` makes of the counted query terms per document and the postings of the query
    list; their tables are gone when it is returned."""
    with Workspace(spark) as space:
        parsed = qry.parse_queries(qry.distinct_queries(_query_list(spark)))
        postings = space.table("postings", matching.query_postings(parsed))
        matches = match_documents(space, postings, _articles(spark, sf_dir))
        return space.result(build(matches, postings))


def _scored(spark: SparkSession, sf_dir: str, build: Callable[..., DataFrame]) -> DataFrame:
    """The same with the scores beside."""
    def scores(matches: DataFrame, postings: DataFrame) -> DataFrame:
        terms = stats.scoring_terms(matches, postings)
        keys = (*PLACE, "row_id", "doc_id")
        return build(scoring.document_scores(matches, terms, keys=keys), matches)

    return _matched(spark, sf_dir, scores)


def _rankings(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return rank_documents(_query_list(spark), _articles(spark, sf_dir), **options)


def _rank() -> Column:
    return F.col("rank").cast("long").alias("rank")


def _finite(name: str) -> list[Column]:
    """Rounded for the comparison; minus infinity, which not every comparison takes, is null and
    has a column that says so."""
    value, none = F.col(name), F.lit(float("-inf"))
    return [
        F.when(value > none, F.round(value, 6)).alias(name),
        (value == none).alias(f"{name}_unbounded"),
    ]


def _item_text(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda item: item["content"]), "\n")


def _size(items: Column | str) -> Column:
    return F.size(items).cast("long")


# --- queries --------------------------------------------------------------------------------

def src_queries(spark, sf_dir):
    path = _new_path(spark, "queries.txt")
    _benchmark_queries(spark, sf_dir).write.text(path)
    return qry.distinct_queries(qry.read_queries(spark, path))


def query_parse(spark, sf_dir):
    lines = qry.distinct_queries(_benchmark_queries(spark, sf_dir))
    return qry.parse_queries(lines).select(
        "original_query",
        F.array_join("query_terms", " ").alias("query_terms"),
        _size("query_term_counts").alias("n_counts"),
    )


def _article_columns(articles: DataFrame) -> DataFrame:
    return articles.select(
        "id", "title", "source",
        _size("contents").alias("n_items"), _item_text(F.col("contents")).alias("items_text"),
    )


def src_articles(spark, sf_dir):
    path = _new_path(spark, "articles.jsonl")
    art.write_articles(_articles(spark, sf_dir), path)
    return _article_columns(art.read_articles(spark, path))


def article_parse(spark, sf_dir):
    lines = _articles(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    return _article_columns(art.parse_articles(lines))


def paragraph_filter(spark, sf_dir):
    kept = docs.paragraphs(F.col("contents"))
    return _articles(spark, sf_dir).select(
        F.col("id").alias("doc_id"),
        _size("contents").alias("n_items"),
        _size(kept).alias("n_paragraphs"),
        _item_text(kept).alias("paragraphs_text"),
    )


def first_paragraphs(spark, sf_dir):
    first = docs.first_paragraphs(F.col("contents"))
    return _articles(spark, sf_dir).select(
        F.col("id").alias("doc_id"),
        _size(first).alias("n_first"),
        F.array_join(first, "\n").alias("first_text"),
    )


def body_text(spark, sf_dir):
    return _articles(spark, sf_dir).select(
        F.col("id").alias("doc_id"), docs.body_text(F.col("contents")).alias("body")
    )


def _token_columns(spark, sf_dir, tokens: Column) -> DataFrame:
    return _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("doc_id"), tokens.alias("tokens")
    ).select(
        "doc_id", _size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def tokenise_text(spark, sf_dir):
    return _token_columns(spark, sf_dir, tokenise(F.col("text")))


def remove_stopwords(spark, sf_dir):
    return _token_columns(spark, sf_dir, content_tokens(F.col("text")))


def porter_stem(spark, sf_dir):
    tokens = _documents(spark, sf_dir).select(
        F.explode(content_tokens(F.col("text"))).alias("token")
    )
    return tokens.distinct().select("token", stem_word(F.col("token")).alias("stem"))


def doc_terms(spark, sf_dir):
    return docs.document_terms(_articles(spark, sf_dir)).select(
        "doc_id", F.array_join("terms", " ").alias("terms")
    )


def doc_length(spark, sf_dir):
    return docs.document_length(_articles(spark, sf_dir))


def corpus_stats(spark, sf_dir):
    return stats.corpus_stats(docs.document_length(_articles(spark, sf_dir))).select(
        "n_docs", "total_len", F.round("avgdl", 6).alias("avgdl")
    )


def query_doc_match(spark, sf_dir):
    return _matched(spark, sf_dir, matching.query_doc_match)


def term_freq(spark, sf_dir):
    return _matched(spark, sf_dir, lambda matches, postings: matching.term_freq(
        matches, postings
    ).select("query_id", "doc_id", "term", "tf"))


def term_freq_map(spark, sf_dir):
    maps = _matched(spark, sf_dir, lambda matches, postings: matching.term_freq_map(
        matching.term_freq(matches, postings)
    ))
    pairs = F.transform(
        F.map_entries("term_freq"), lambda e: F.concat_ws("=", e["key"], e["value"])
    )
    return maps.select("query_id", "doc_id", F.array_join(pairs, " ").alias("term_freq"))


def corpus_term_freq(spark, sf_dir):
    def both(matches, postings):
        per_query = stats.corpus_term_freq(matches, postings, "per_query")
        corpus = stats.corpus_term_freq(matches, postings, "corpus")
        return per_query.withColumnRenamed("cf", "cf_per_query").join(
            corpus.withColumnRenamed("cf", "cf_corpus"), "term"
        )

    return _matched(spark, sf_dir, both)


def candidates(spark, sf_dir):
    return _matched(spark, sf_dir, matching.candidates)


def term_stats_join(spark, sf_dir):
    return _matched(spark, sf_dir, lambda matches, postings: stats.term_stats(
        matching.candidates(matches, postings), stats.corpus_term_freq(matches, postings)
    ))


def dph_term_score(spark, sf_dir):
    return _matched(spark, sf_dir, lambda matches, postings: scoring.term_scores(
        matches, stats.scoring_terms(matches, postings)
    ).select("query_id", "doc_id", "term", "tf", *_finite("dph")))


def dph_scores(spark, sf_dir):
    return _scored(spark, sf_dir, lambda scores, _: scores.select(
        "query_id", "doc_id", *_finite("score")
    ))


def rank_in_query(spark, sf_dir):
    return _scored(spark, sf_dir, lambda scores, _: ranking.rank_in_query(scores).select(
        "query_id", _rank(), "doc_id", *_finite("score")
    ))


def topk_before_dedup(spark, sf_dir):
    def top(scores, matches):
        first = ranking.top_ranked(scores, 10, in_parts=True)
        titles = matches.select(*PLACE, "row_id", "title")
        return first.join(titles, [*PLACE, "row_id"]).select(
            "query_id", _rank(), "doc_id", *_finite("score"), "title"
        )

    return _scored(spark, sf_dir, top)


def title_distance_query(spark, sf_dir):
    first = F.coalesce(
        F.get(docs.first_paragraphs(F.col("contents")), F.lit(0)), F.lit("")
    )
    return _articles(spark, sf_dir).select(
        F.col("id").alias("doc_id"), "title", first.alias("first")
    ).select(
        "doc_id", F.round(title_distance(F.col("title"), F.col("first")), 6).alias("distance")
    )


def ranked_title_distance(spark, sf_dir):
    """How far apart the titles of any two results (at most ten) of a query are."""
    rows = _rankings(spark, sf_dir).select("query_id", _rank(), "title")
    other = rows.select(
        "query_id", F.col("rank").alias("other_rank"), F.col("title").alias("other")
    )
    return rows.join(other, "query_id").where("rank < other_rank").select(
        "query_id", "rank", "other_rank",
        F.round(title_distance(F.col("title"), F.col("other")), 6).alias("distance"),
    )


def near_title_pairs(spark, sf_dir):
    """For every candidate, the kept results (at most ten) whose titles rule it out."""
    with Workspace(spark) as space:
        found = search(space, _query_list(spark), _articles(spark, sf_dir), fold_copies=False)
        kept = space.table("kept", found.select(
            F.col("original_query").alias("query_id"), F.col("doc_id").alias("kept_doc_id"),
            F.col("title").alias("kept_title"),
        ))
        names = space.tables["queries"].select("query_id", "original_query")
        scored = scoring.document_scores(
            space.tables["matches"], space.tables["terms"], keys=(*PLACE, "row_id", "doc_id", "title")
        ).join(names, "query_id").select(
            F.col("original_query").alias("query_id"), "doc_id", "title"
        )
        return space.result(ruled_out(scored, kept).select("query_id", "doc_id", "kept_doc_id"))


def dedup_topk(spark, sf_dir):
    return _rankings(spark, sf_dir).select("query_id", _rank(), "doc_id")


def _ranked_columns(rankings: DataFrame) -> DataFrame:
    return rankings.select("query_id", _rank(), "doc_id", *_finite("score"), "title")


def rank_documents_query(spark, sf_dir):
    return _rankings(spark, sf_dir).select(
        "query_id", "original_query", _rank(), "doc_id", *_finite("score"), "title"
    )


def rank_benchmark(spark, sf_dir):
    return _ranked_columns(rank_documents(
        _benchmark_queries(spark, sf_dir), _articles(spark, sf_dir),
        cf_mode="corpus", ratio="exact",
    ))


def rank_deep(spark, sf_dir):
    """Windows of two rows, so that most of every walk is done in later rounds."""
    return _ranked_columns(_rankings(spark, sf_dir, window=2))


def rank_many_queries(spark, sf_dir):
    """The first line of every document is a query."""
    lines = _articles(spark, sf_dir).select(F.col("title").alias("original_query"))
    return _ranked_columns(rank_documents(
        lines, _articles(spark, sf_dir), cf_mode="corpus", ratio="exact", k=3
    ))


def rank_untitled(spark, sf_dir):
    """Articles whose first line is short have no title: they count and are never returned."""
    short = F.length("title") < duck_oracle.SHORT_TITLE
    articles = _articles(spark, sf_dir).withColumn(
        "title", F.when(~short, F.col("title"))
    )
    return _ranked_columns(rank_documents(_query_list(spark), articles))


def rank_job(spark, sf_dir):
    """The batch job from files to files, read back; some article lines are broken off."""
    folder = _new_path(spark, "job")
    _query_list(spark).write.text(f"{folder}/queries")
    _article_lines(spark, sf_dir).write.text(f"{folder}/articles")
    job.run(spark, job.arguments([
        "--queries", f"{folder}/queries", "--articles", f"{folder}/articles",
        "--quarantine", f"{folder}/corrupt", "--work-dir", f"{folder}/work",
        "--format", "parquet", "--out", f"{folder}/rankings",
    ]))
    return _ranked_columns(spark.read.parquet(f"{folder}/rankings"))


def _article_lines(spark, sf_dir) -> DataFrame:
    """Articles as JSON lines; that of an article with a short title lacks its end."""
    line = F.to_json(F.struct("*"))
    short = F.length("title") < duck_oracle.SHORT_TITLE
    return _articles(spark, sf_dir).select(
        F.when(short, F.left(line, F.length(line) - 1)).otherwise(line).alias("value")
    )


def article_quarantine(spark, sf_dir):
    """Which lines are articles and which are corrupt, told by the id that every line begins with."""
    path = _new_path(spark, "articles")
    _article_lines(spark, sf_dir).write.text(path)
    good, corrupt = art.checked_articles(spark, path)
    in_files = F.sum("n_lines").over(Window.partitionBy(F.lit(0)))
    total = art.corrupt_counts(corrupt).select(in_files.alias("n_corrupt")).limit(1)
    return good.select(
        F.col("id").alias("doc_id"), F.lit("article").alias("kind"), "title"
    ).unionByName(corrupt.select(
        F.regexp_extract("line", '"id":"([^"]*)"', 1).alias("doc_id"),
        F.lit("corrupt").alias("kind"), F.lit(None).cast("string").alias("title"),
    )).join(F.broadcast(total))


def article_fields(spark, sf_dir):
    """Articles with every field filled, written as JSON lines and read again."""
    path = _new_path(spark, "articles.jsonl")
    facts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("id"), "lang", "n_chars"
    )
    named = _articles(spark, sf_dir).join(facts, "id")
    filled = {
        name: F.concat(F.lit(f"{name} of "), F.col("id"))
        for name in CONTENT_FIELDS if name not in ("content", "subtype")
    }
    items = F.transform("contents", lambda item: F.struct(*[
        filled.get(name, item[name]).alias(name) for name in CONTENT_FIELDS
    ]))
    art.write_articles(named.select(
        "id", F.concat(F.lit("http://site/"), F.col("id")).alias("article_url"), "title",
        F.col("lang").alias("author"), (F.col("n_chars") * 1000).alias("published_date"),
        items.alias("contents"), F.lit("article").alias("type"), "source",
    ), path)
    told = F.transform("contents", lambda item: F.concat_ws(
        "|", *[F.coalesce(item[name], F.lit("-")) for name in CONTENT_FIELDS]
    ))
    return art.read_articles(spark, path).select(
        "id", "article_url", "title", "author", "published_date", "type", "source",
        F.array_join(told, "\n").alias("items"),
    )


def ranking_nested(spark, sf_dir):
    def joined(field: str, separator: str) -> Column:
        return F.array_join(F.transform("results", lambda r: r[field]), separator)

    return out.ranking_nested(_rankings(spark, sf_dir)).select(
        "query_id",
        _size("results").alias("n_results"),
        joined("doc_id", " ").alias("doc_ids"),
        joined("title", "\n").alias("titles"),
    )


def ranking_text(spark, sf_dir):
    return out.ranking_text(_rankings(spark, sf_dir), decimals=6)


def ranking_files(spark, sf_dir):
    path = _new_path(spark, "rankings")
    out.write_ranking_files(_rankings(spark, sf_dir), path, decimals=6)
    files = spark.read.schema("value string, query_file string").text(path)
    return files.select("query_file", F.col("value").alias("line"))


def entry(spark: SparkSession) -> DataFrame:
    """``rank_documents`` over the small documents table."""
    sf_dir = "/root/testdata/sf0.001"
    return rank_documents(_query_list(spark, FLAGSHIP), _articles(spark, sf_dir))


def _corpus_queries():
    """The registry of the corpus operators, or ``None`` where their subpackage (or the pipeline
    beside it) has been taken away; any other import error is one."""
    try:
        from quillrank.llm import registry
    except ModuleNotFoundError as error:
        if (error.name or "").split(".")[:2] in (["quillrank", "llm"], ["corpus_pipeline"]):
            return None
        raise
    return registry


def queries() -> dict[str, Query]:
    corpus = _corpus_queries()
    return _ranking_queries() | (corpus.queries() if corpus else {})


def _ranking_queries() -> dict[str, Query]:
    return {
        "src_queries": src_queries,
        "query_parse": query_parse,
        "src_articles": src_articles,
        "article_parse": article_parse,
        "article_fields": article_fields,
        "article_quarantine": article_quarantine,
        "paragraph_filter": paragraph_filter,
        "first_paragraphs": first_paragraphs,
        "body_text": body_text,
        "tokenise": tokenise_text,
        "remove_stopwords": remove_stopwords,
        "porter_stem": porter_stem,
        "doc_terms": doc_terms,
        "doc_length": doc_length,
        "corpus_stats": corpus_stats,
        "query_doc_match": query_doc_match,
        "term_freq": term_freq,
        "term_freq_map": term_freq_map,
        "corpus_term_freq": corpus_term_freq,
        "candidates": candidates,
        "term_stats_join": term_stats_join,
        "dph_term_score": dph_term_score,
        "dph_scores": dph_scores,
        "rank_in_query": rank_in_query,
        "topk_before_dedup": topk_before_dedup,
        "title_distance": title_distance_query,
        "ranked_title_distance": ranked_title_distance,
        "near_title_pairs": near_title_pairs,
        "dedup_topk": dedup_topk,
        "rank_documents": rank_documents_query,
        "rank_benchmark": rank_benchmark,
        "rank_deep": rank_deep,
        "rank_many_queries": rank_many_queries,
        "rank_untitled": rank_untitled,
        "rank_job": rank_job,
        "ranking_nested": ranking_nested,
        "ranking_text": ranking_text,
        "ranking_files": ranking_files,
    }


def oracle_sql() -> dict[str, str]:
    corpus = _corpus_queries()
    return duck_oracle.oracle_sql() | (corpus.oracle_sql() if corpus else {})
