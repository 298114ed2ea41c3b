"""Queries meet documents on equal terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def query_postings(parsed: DataFrame) -> DataFrame:
    """``(query_id, term, n_terms, n_lines)``, one row per distinct term of a query;
    ``n_terms`` counts repeated terms too. ``parsed`` comes from ``parse_queries`` over
    ``distinct_queries``."""
    return parsed.select(
        "query_id",
        F.size("query_terms").cast("long").alias("n_terms"),
        "n_lines",
        F.explode(F.array_distinct("query_terms")).alias("term"),
    ).select("query_id", "term", "n_terms", "n_lines")


def document_postings(matches: DataFrame) -> DataFrame:
    """``document_matches`` with one row per document and term: every column but ``matches``,
    then ``term, tf``.

    The plain explode would let the optimizer derive ``size(matches) > 0`` and push it below
    the projections, where the whole text chain would run again just to be counted; the outer
    form leaves that alone, and its null rows are dropped in the same stage.
    """
    keep = [name for name in matches.columns if name != "matches"]
    exploded = matches.select(*keep, F.explode_outer("matches").alias("m"))
    return exploded.where(F.col("m").isNotNull()).select(
        *keep, F.col("m.term").alias("term"), F.col("m.tf").alias("tf")
    )


def term_freq(matches: DataFrame, postings: DataFrame) -> DataFrame:
    """Every column of ``document_postings`` plus ``query_id, n_terms``: an equi-join on the
    term. It is broadcast when the query side is small by its statistics, sort-merge (with
    adaptive skew splitting for hot terms) otherwise."""
    return document_postings(matches).join(
        postings.select("query_id", "term", "n_terms"), "term"
    )


def query_doc_match(matches: DataFrame, postings: DataFrame) -> DataFrame:
    """``(query_id, doc_id)``: the documents that hold at least one term of the query."""
    return term_freq(matches, postings).select("query_id", "doc_id").distinct()


def candidates(matches: DataFrame, postings: DataFrame) -> DataFrame:
    """``(query_id, doc_id, term, tf, dl)`` of the documents that may be returned: at least
    one query term, and a title that is not null. The article itself stays behind."""
    titled = matches.where(F.col("title").isNotNull())
    return term_freq(titled, postings).select("query_id", "doc_id", "term", "tf", "dl")


def term_freq_map(rows: DataFrame) -> DataFrame:
    """``(query_id, doc_id, term_freq)``: the counts of one document for one query as a map.
    Bounded by the number of terms of the query."""
    entries = F.sort_array(F.collect_list(F.struct("term", "tf")))
    return rows.groupBy("query_id", "doc_id").agg(F.map_from_entries(entries).alias("term_freq"))
