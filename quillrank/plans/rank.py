"""The whole search: many queries against a document collection, ten results per query."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.functions.text import STOPWORDS, TOKEN_PATTERN
from quillrank.operators.blocks import Blocks
from quillrank.operators.dedup import WINDOW, distinct_top, kept_rows
from quillrank.operators.documents import document_matches
from quillrank.operators.matching import query_postings
from quillrank.operators.scoring import document_scores
from quillrank.operators.sieve import TermSieve
from quillrank.operators.stats import scoring_terms
from quillrank.schema import MAX_PARAGRAPHS, MIN_TITLE_DISTANCE, TOP_K
from quillrank.sources.queries import distinct_queries, parse_queries
from quillrank.sources.workspace import Workspace


# What tells documents apart that differ in anything a score or a title shows, and where they are
# placed. 128 bits: among 10 billion documents two unlike ones share it with a chance of 10 ** -19.
PLACE = ["mark", "mark_2"]


# From so many queries on, they meet the documents in blocks.
BLOCK_QUERIES = 64

# There, rows of one title are folded before the walk, so that most queries find their results in so many rows a result.
FIRST_TITLES = 4


def match_table_rows(matches: DataFrame) -> DataFrame:
    """``document_matches`` reduced to what later steps read: every document keeps its length
    (it counts in the statistics), only those with a match keep id and title. ``row_id``
    tells apart articles that share an id.

    ``mark`` and ``mark_2`` are equal for documents with equal title, length and matches. Empty
    titles are never copies of each other and have marks of their own.
    """
    matched = F.size("matches") > 0
    rows = matches.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.when(matched, F.col("doc_id")).alias("doc_id"),
        F.when(matched, F.col("title")).alias("title"),
        "dl",
        "matches",
    )
    shown = [
        F.coalesce("title", F.lit("")), F.col("title").isNull(), F.col("dl"), F.col("matches"),
        F.when(F.col("title") == "", F.col("row_id")).otherwise(-1),
    ]
    marks = [F.xxhash64(F.lit(seed), *shown).alias(name) for seed, name in enumerate(PLACE)]
    return rows.select(*marks, "*")


def collapse_copies(found: DataFrame) -> DataFrame:
    """One row per group of documents with equal title, length and matches, and the number of
    ``copies`` it stands for.

    Such documents have the same score for every query, so all but the one with the lowest
    id fall to its title, whatever else is ranked: collapsing them changes no result. All
    documents without a match fold into one row per length. Each task folds its own copies
    before the exchange, so a title that a third of the corpus shares makes no hot partition.
    """
    # no two rows have one row_id, so the least is told before anything behind it is compared
    first = F.min(F.struct("doc_id", "row_id", "title", "dl", "matches")).alias("first")
    return (
        found.groupBy(*PLACE)
        .agg(first, F.count(F.lit(1)).alias("copies"))
        .select(*PLACE, "first.row_id", "first.doc_id", "first.title", "first.dl", "copies",
                "first.matches")
    )


def match_documents(
    space: Workspace,
    postings: DataFrame,
    articles: DataFrame,
    *,
    max_paragraphs: int = MAX_PARAGRAPHS,
    token_pattern: str = TOKEN_PATTERN,
    stopwords: Iterable[str] = STOPWORDS,
    collapse: bool = False,
) -> DataFrame:
    """The one pass over the articles: ``match_table_rows`` as a table of ``space``, bucketed
    by ``PLACE``; with ``collapse``, ``collapse_copies`` of it.

    The pass itself has no exchange: every task commits what it found to the shared folder,
    so a lost executor costs its running tasks only, and row ids are fixed before anything is
    placed by them. Then the narrow rows move once, folded by their tasks before; what the
    pass has written is deleted after that. Query sets of any size take this way: a larger one lets more
    terms through the sieve, and the join with the postings selects.
    """
    found = document_matches(
        articles,
        TermSieve.of(postings),
        max_paragraphs=max_paragraphs,
        token_pattern=token_pattern,
        stopwords=tuple(stopwords),
    )
    found = space.table("found", match_table_rows(found))
    rows = collapse_copies(found) if collapse else found.repartition(*PLACE)
    matches = space.bucketed_table("matches", rows, PLACE)
    space.drop("found")
    return matches


def rank_documents(
    queries: DataFrame,
    articles: DataFrame,
    *,
    work_dir: str | None = None,
    **options,
) -> DataFrame:
    """``(query_id, original_query, rank, doc_id, score, title)``, at most ``k`` rows per query, as a
    table in the shared folder (or ``work_dir``); every other table of the run is gone by then.
    Options as in ``search``."""
    with Workspace(articles.sparkSession, work_dir) as space:
        return space.result(search(space, queries, articles, **options))


def search(
    space: Workspace,
    queries: DataFrame,
    articles: DataFrame,
    *,
    k: int = TOP_K,
    min_distance: float = MIN_TITLE_DISTANCE,
    cf_mode: str = "per_query",
    ratio: str = "floor",
    max_paragraphs: int = MAX_PARAGRAPHS,
    token_pattern: str = TOKEN_PATTERN,
    stopwords: Iterable[str] = STOPWORDS,
    window: int | None = None,
    fold_copies: bool = True,
) -> DataFrame:
    """The rankings as rows that are read from the tables of ``space``.

    ``queries`` has one ``original_query`` per row, ``articles`` the columns ``id, title,
    contents``. The articles are read once. That pass leaves a narrow table of matches,
    bucketed by row; statistics, scores, ranks and titles all come from it. Inside, a query is
    a number (fixed by writing the query table), so that long queries do not make wide keys. ``window`` is twenty
    rows a result, 200 at most, where none is given. ``fold_copies``
    changes no ranking; without it the table of matches has a row for every document.
    """
    stopwords = tuple(stopwords)
    window = window or min(WINDOW, 20 * k)
    parsed = parse_queries(distinct_queries(queries), token_pattern, stopwords)
    parsed = space.table(
        "queries", parsed.withColumn("query_id", F.monotonically_increasing_id())
    )
    postings = query_postings(parsed)
    matches = match_documents(
        space,
        postings,
        articles,
        max_paragraphs=max_paragraphs,
        token_pattern=token_pattern,
        stopwords=stopwords,
        collapse=fold_copies and min_distance > 0,
    )
    terms = space.table("terms", scoring_terms(matches, postings, cf_mode))
    keys = [*PLACE, "row_id", "doc_id"]

    def with_titles(rows: DataFrame) -> DataFrame:
        titles = matches.select(*PLACE, "row_id", "title")
        return rows.join(titles, [*PLACE, "row_id"])

    def scores_of(open_queries: DataFrame) -> DataFrame:
        open_terms = terms.join(open_queries.select("query_id"), "query_id", "left_semi")
        return document_scores(matches, open_terms, ratio, keys)

    if parsed.limit(BLOCK_QUERIES).count() >= BLOCK_QUERIES:
        blocks = Blocks(matches, terms, space.table, ratio, keys, fold=min_distance > 0)
        first = min(window, FIRST_TITLES * k)
        kept = distinct_top(
            blocks.best(first), with_titles, blocks.stretch, space.table, k, min_distance, window,
            first=first, bounds_of=blocks.bounds, many=True,
        )
    else:
        kept = distinct_top(
            document_scores(matches, terms, ratio, keys),
            with_titles,
            scores_of,
            space.table,
            k,
            min_distance,
            window,
        )
    named = kept_rows(kept).join(parsed.select("query_id", "original_query"), "query_id")
    return named.select(
        F.col("original_query").alias("query_id"),
        "original_query", "rank", "doc_id", "score", "title",
    )
