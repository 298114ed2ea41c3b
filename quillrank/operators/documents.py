"""From articles to counted terms, one row per article all the way."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.porter import may_change, stem_words
from quillrank.functions.sqltext import keep_items
from quillrank.functions.text import STOPWORDS, TOKEN_PATTERN, content_tokens, count_runs
from quillrank.operators.sieve import TermSieve
from quillrank.schema import MAX_PARAGRAPHS, PARAGRAPH


def paragraphs(contents: Column) -> Column:
    """Items that have text and are marked as paragraphs; null items fall out."""
    return F.filter(
        contents, lambda item: item["content"].isNotNull() & (item["subtype"] == PARAGRAPH)
    )


def first_paragraphs(contents: Column, n: int = MAX_PARAGRAPHS) -> Column:
    """The text of the first ``n`` paragraphs: the limit counts paragraphs, not items."""
    return F.transform(F.slice(paragraphs(contents), 1, n), lambda item: item["content"])


def body_text(contents: Column, n: int = MAX_PARAGRAPHS) -> Column:
    return F.coalesce(F.array_join(first_paragraphs(contents, n), " "), F.lit(""))


def document_tokens(
    articles: DataFrame,
    max_paragraphs: int = MAX_PARAGRAPHS,
    token_pattern: str = TOKEN_PATTERN,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """``(doc_id, title, tokens)``: title tokens, then body tokens, tokenised apart so that
    no token spans the seam; without stopwords, not stemmed."""
    body = body_text(F.col("contents"), max_paragraphs)
    return articles.select(
        F.col("id").alias("doc_id"),
        "title",
        F.concat(
            content_tokens(F.col("title"), token_pattern, stopwords),
            content_tokens(body, token_pattern, stopwords),
        ).alias("tokens"),
    )


def document_terms(articles: DataFrame, **options) -> DataFrame:
    """``(doc_id, title, terms)``: all stemmed terms in order, repeats kept."""
    return document_tokens(articles, **options).select(
        "doc_id", "title", stem_words(F.col("tokens")).alias("terms")
    )


def document_length(articles: DataFrame, **options) -> DataFrame:
    """``(doc_id, dl)``. Needs no stems: stemming keeps every token."""
    return document_tokens(articles, **options).select(
        "doc_id", F.size("tokens").cast("long").alias("dl")
    )


def document_matches(
    articles: DataFrame, sieve: TermSieve | None = None, **options
) -> DataFrame:
    """``(doc_id, title, dl, matches)``, ``matches`` being ``array<struct<term, tf>>``.

    With a ``sieve``, tokens that cannot stem to one of its terms are dropped before stemming,
    and most other terms after it; what is left besides the terms of the sieve does no harm, as
    terms are selected by a join. Without one, every term is there. Tokens that are their own stems meet the
    sieve as terms and pass no rule; where they stand among the others does not matter, as terms are sorted.
    """
    own = keep_items(F.col("tokens"), f"NOT ({may_change('x')})")
    other = keep_items(F.col("tokens"), may_change("x"))
    stems = F.concat(own, stem_words(F.filter(other, sieve.may_stem_to_term) if sieve else other))
    counted = document_tokens(articles, **options).select(
        "doc_id",
        "title",
        F.size("tokens").cast("long").alias("dl"),
        F.sort_array(F.filter(stems, sieve.may_be_term) if sieve else stems).alias("hits"),
    )
    return counted.select("doc_id", "title", "dl", count_runs(F.col("hits")).alias("matches"))
