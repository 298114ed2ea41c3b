"""The DPH weighting model (hypergeometric divergence from randomness, parameter-free)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the relative frequency of a term that is all of its document. It keeps
# 1 - f above zero, so that the score stays finite.
MAX_RELATIVE_FREQUENCY = 0.99999


def log2(x: Column) -> Column:
    """Base-2 logarithm; zero gives minus infinity (the built-in gives null)."""
    return F.when(x > 0, F.log2(x)).otherwise(F.lit(float("-inf")))


def relative_frequency(tf: Column, dl: Column) -> Column:
    return F.when(tf < dl, tf / dl).otherwise(F.lit(MAX_RELATIVE_FREQUENCY))


def corpus_ratio(n_docs: Column, cf: Column, ratio: str = "floor") -> Column:
    """Documents per occurrence of the term. ``floor`` divides whole numbers, so a term seen
    more often than there are documents gets 0 (and a score of minus infinity); ``exact``
    keeps the fraction."""
    if ratio == "floor":
        return F.call_function("div", n_docs, cf)
    if ratio == "exact":
        return n_docs / cf
    raise ValueError(f"ratio must be 'floor' or 'exact', not {ratio!r}")


def dph_term_score(
    tf: Column, cf: Column, dl: Column, avgdl: Column, n_docs: Column, ratio: str = "floor"
) -> Column:
    """Score of one term in one document."""
    f = relative_frequency(tf, dl)
    norm = (1.0 - f) * (1.0 - f) / (tf + 1.0)
    gain = log2((tf * avgdl / dl) * corpus_ratio(n_docs, cf, ratio))
    return norm * (tf * gain + 0.5 * log2(2.0 * math.pi * tf * (1.0 - f)))


def dph_parts(tf: Column, dl: Column, avgdl: Column) -> tuple[Column, Column]:
    """``(slope, rest)`` with ``dph_term_score = slope * ratio_gain + rest`` (but for the last bits): what the
    document says of it, without the corpus frequency of the term."""
    f = relative_frequency(tf, dl)
    norm = (1.0 - f) * (1.0 - f) / (tf + 1.0)
    own = tf * log2(tf * avgdl / dl)
    return norm * tf, norm * (own + 0.5 * log2(2.0 * math.pi * tf * (1.0 - f)))


def ratio_gain(n_docs: Column, cf: Column, ratio: str = "floor") -> Column:
    """What the term says of it: minus infinity for a term with a ``corpus_ratio`` of 0."""
    return log2(corpus_ratio(n_docs, cf, ratio))
