from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quillrank.functions.dph import dph_term_score
from quillrank.functions.titles import near_title, title_distance
from quillrank.operators.ranking import rank_in_query, top_ranked

from helpers import edit_distance


def formula(tf, cf, dl, avgdl, n, ratio):
    f = tf / dl if tf < dl else 0.99999
    x = tf * avgdl / dl * (n // cf if ratio == "floor" else n / cf)
    gain = math.log2(x) if x > 0 else -math.inf
    return (1 - f) ** 2 / (tf + 1) * (tf * gain + 0.5 * math.log2(2 * math.pi * tf * (1 - f)))


@pytest.mark.parametrize("ratio", ["floor", "exact"])
def test_dph(spark, ratio):
    cases = [(1, 3, 10, 7.5, 100), (4, 90, 50, 20.0, 100), (2, 150, 40, 20.0, 100),
             (3, 3, 3, 9.0, 8), (1, 1, 1, 1.0, 1), (40000, 70000, 90000, 50.0, 10**10)]
    rows = spark.createDataFrame(
        cases, "tf bigint, cf bigint, dl bigint, avgdl double, n bigint"
    ).select("*", dph_term_score(*[F.col(c) for c in ("tf", "cf", "dl", "avgdl", "n")],
                                 ratio).alias("s"))
    for r in rows.collect():
        expected = formula(r.tf, r.cf, r.dl, r.avgdl, r.n, ratio)
        assert r.s == expected or abs(r.s - expected) < 1e-9 * max(1, abs(expected))
        if ratio == "floor" and r.cf > r.n:
            assert r.s == -math.inf
        assert not math.isnan(r.s)


def test_unknown_ratio():
    with pytest.raises(ValueError):
        dph_term_score(*[F.lit(1)] * 5, ratio="round")


def test_title_distance_and_near(spark):
    pairs = [("abcd", "abxx"), ("abcd", "abcx"), ("", ""), ("", "a"), ("same", "same"),
             ("café olé", "cafe ole"), ("short", "a much longer title than that"),
             ("kitten", "sitting"), ("abcdefgh", "abcd"), ("abcdefghi", "abcde"),
             ("flaw", "lawn"), ("x" * 40, "x" * 21 + "y" * 19), ("x" * 40, "x" * 20 + "y" * 20)]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b",
        title_distance(F.col("a"), F.col("b")).alias("d"),
        near_title(F.col("a"), F.col("b")).alias("near"),
        near_title(F.col("b"), F.col("a"), 0.3).alias("near3"),
        near_title(F.col("a"), F.col("b"), 0.0).alias("never"),
        near_title(F.col("a"), F.col("b"), 1.5).alias("always"),
    )
    for r in rows.collect():
        longer = max(len(r.a), len(r.b))
        if longer == 0:
            assert r.d is None and not (r.near or r.near3 or r.never or r.always)
            continue
        expected = edit_distance(r.a, r.b) / longer
        assert r.d == expected
        assert r.near == (expected < 0.5) and r.near3 == (expected < 0.3), (r.a, r.b)
        assert r.always and not r.never


def test_order_within_a_query(spark):
    scores = spark.createDataFrame(
        [("q", "b", 1.0), ("q", "a", 1.0), ("q", "c", -math.inf), ("q", "d", math.nan),
         ("q", "e", 1.0 + 1e-12), ("r", "z", -math.inf)], "query_id string, doc_id string, score double")
    ranks = {(r.query_id, r.doc_id): r["rank"] for r in rank_in_query(scores).collect()}
    assert ranks == {("q", "d"): 1, ("q", "a"): 2, ("q", "b"): 3, ("q", "e"): 4,
                     ("q", "c"): 5, ("r", "z"): 1}
    assert top_ranked(scores, 2).count() == 3


def test_cuts_in_parts_change_nothing(spark):
    scores = spark.range(0, 3000, 1, 150).select(
        (F.col("id") % 7).cast("string").alias("query_id"), F.col("id").cast("string").alias("doc_id"),
        (F.xxhash64("id") % 40).cast("double").alias("score"),
    )
    whole = sorted(map(tuple, top_ranked(scores, 9).collect()))
    assert sorted(map(tuple, top_ranked(scores, 9, in_parts=True).collect())) == whole
    assert len(whole) == 63


def test_near_at_every_threshold(spark):
    """The bound on the number of edits agrees with the division at any share."""
    a = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrst"
    pairs = [(a[:n], a[:n - m] + "#" * m) for n in (1, 3, 7, 10, 30, 46) for m in range(n + 1)]
    rows = spark.createDataFrame(pairs, "a string, b string")
    for share in (0.1, 0.2, 0.3, 1 / 3, 0.7, 0.9, 1.0):
        found = rows.select("a", "b", near_title(F.col("a"), F.col("b"), share).alias("near"))
        for r in found.collect():
            assert r.near == (r.b.count("#") / len(r.a) < share), (r, share)
