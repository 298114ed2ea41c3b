"""Text to terms: tokenise, drop stopwords, stem. All JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrank.functions.porter import stem_words
from quillrank.functions.sqltext import is_one_of, keep_items

TOKEN_PATTERN = "[A-Za-z0-9]+"

# The English stopword list that ships with Spark ML's StopWordsRemover.
# Entries with an apostrophe never equal a token of the default pattern; they are kept so
# that the list can be checked against Spark's own and used with other patterns.
STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's
where's who's why's would
""".split())


def tokenise(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-cased runs of token characters, in text order; null text gives no tokens."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return F.transform(runs, F.lower)


def remove_stopwords(tokens: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """The tokens that are not stopwords."""
    words = list(stopwords)
    return keep_items(tokens, f"NOT {is_one_of('x', words)}") if words else tokens


def content_tokens(
    text: Column, pattern: str = TOKEN_PATTERN, stopwords: Iterable[str] = STOPWORDS
) -> Column:
    """Tokens without stopwords, not stemmed. Stemming never drops a token, so the size of
    this array is already the number of terms."""
    return remove_stopwords(tokenise(text, pattern), stopwords)


def terms(
    text: Column, pattern: str = TOKEN_PATTERN, stopwords: Iterable[str] = STOPWORDS
) -> Column:
    """The full chain: ordered list of stemmed terms, repeats kept."""
    return stem_words(content_tokens(text, pattern, stopwords))


def count_runs(sorted_items: Column) -> Column:
    """``array<struct<term, tf>>`` from a sorted array: one entry per distinct item.

    The array is cut where neighbours differ, so a document is counted inside its own row,
    in one pass and without a shuffle. Pass a plain column (not an expression): the lambdas
    read it by position.
    """
    n = F.size(sorted_items)
    positions = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    ends = F.filter(
        positions,
        lambda i: (i == n) | (F.get(sorted_items, i) != F.get(sorted_items, i - 1)),
    )
    starts = F.concat(F.array(F.lit(0)), ends)
    return F.zip_with(
        ends,
        F.slice(starts, F.lit(1), F.size(ends)),
        lambda end, start: F.struct(
            F.get(sorted_items, end - 1).alias("term"),
            (end - start).cast("long").alias("tf"),
        ),
    )
