"""DPH scores per term and per query and document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.functions.dph import dph_term_score
from quillrank.operators.matching import document_postings


def term_scores(matches: DataFrame, terms: DataFrame, ratio: str = "floor") -> DataFrame:
    """Titled documents only: ``document_postings`` plus ``query_id, n_terms, dph``.
    ``terms`` comes from ``scoring_terms``."""
    titled = matches.where(F.col("title").isNotNull())
    columns = [name for name in titled.columns if name != "matches"]
    dph = dph_term_score(
        F.col("tf"), F.col("cf"), F.col("dl"), F.col("avgdl"), F.col("n_docs"), ratio
    )
    return document_postings(titled).join(terms, "term").select(
        "query_id", *columns, "term", "tf", "n_terms", dph.alias("dph")
    )


def document_scores(
    matches: DataFrame,
    terms: DataFrame,
    ratio: str = "floor",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``(query_id, *keys, score)``: the sum over the matched distinct terms, divided by the
    number of terms of the query (unmatched and repeated ones included).

    ``keys`` identify a document. On a frame bucketed by one of them the sum is complete
    where it is made, and no score row crosses the network.
    """
    return (
        term_scores(matches, terms, ratio)
        .groupBy("query_id", *keys, "n_terms")
        .agg(F.sum("dph").alias("total"))
        .select("query_id", *keys, (F.col("total") / F.col("n_terms")).alias("score"))
    )
