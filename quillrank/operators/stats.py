"""Corpus statistics as plain aggregates over all documents, matched or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators.matching import document_postings


def _copies(rows: DataFrame) -> Column:
    """How many documents a row stands for: 1, unless copies were collapsed."""
    return F.col("copies") if "copies" in rows.columns else F.lit(1)


def corpus_stats(documents: DataFrame) -> DataFrame:
    """``(n_docs, total_len, avgdl)``, one row, from any frame with one ``dl`` per document
    (or per group of ``copies``)."""
    copies = _copies(documents)
    return documents.agg(
        F.coalesce(F.sum(copies), F.lit(0)).cast("long").alias("n_docs"),
        F.coalesce(F.sum(F.col("dl") * copies), F.lit(0)).alias("total_len"),
    ).withColumn("avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs")))


def corpus_term_freq(
    matches: DataFrame, postings: DataFrame, cf_mode: str = "per_query"
) -> DataFrame:
    """``(term, cf)`` for every query term that occurs. Untitled documents count too.

    ``per_query`` counts an occurrence once per query line that holds the term, ``corpus``
    once. Either way each task first sums its own documents, so the exchange carries at most
    one row per term and task, however frequent the term.
    """
    lines = postings.groupBy("term").agg(F.sum("n_lines").alias("n_lines"))
    counted = [name for name in ("copies", "matches") if name in matches.columns]
    occurrences = document_postings(matches.select(*counted))
    totals = occurrences.groupBy("term").agg(
        F.sum(F.col("tf") * _copies(matches)).alias("cf")
    ).join(lines, "term")
    if cf_mode == "per_query":
        return totals.select("term", (F.col("cf") * F.col("n_lines")).alias("cf"))
    if cf_mode == "corpus":
        return totals.select("term", "cf")
    raise ValueError(f"cf_mode must be 'per_query' or 'corpus', not {cf_mode!r}")


def scoring_terms(
    matches: DataFrame, postings: DataFrame, cf_mode: str = "per_query"
) -> DataFrame:
    """``(query_id, term, n_terms, cf, n_docs, avgdl)``: all a term's score needs besides the
    document. As large as the query set; the corpus scalars are one broadcast row."""
    lengths = [name for name in ("copies", "dl") if name in matches.columns]
    scalars = corpus_stats(matches.select(*lengths)).select("n_docs", "avgdl")
    return (
        postings.join(corpus_term_freq(matches, postings, cf_mode), "term")
        .crossJoin(F.broadcast(scalars))
        .select("query_id", "term", "n_terms", "cf", "n_docs", "avgdl")
    )


def term_stats(candidate_rows: DataFrame, cf: DataFrame) -> DataFrame:
    """Candidates with the corpus frequency of their term."""
    return candidate_rows.join(cf, "term").select(*candidate_rows.columns, "cf")
