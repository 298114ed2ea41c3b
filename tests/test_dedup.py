from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillrank.functions.titles import LONG_TITLE, edits_within, near_any, near_pairs, walked
from quillrank.operators.dedup import distinct_top, kept_rows, ruled_out

from helpers import edit_distance, greedy, near

SCHEMA = "query_id string, row_id bigint, doc_id string, score double, title string"


def run(spark, rows, folder, k=10, size=200, min_distance=0.5):
    table = spark.createDataFrame(rows, SCHEMA)
    rounds = []

    def save(name, frame):
        rounds.append(name)
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    kept = distinct_top(
        table.drop("title"),
        lambda top: top.join(table.select("row_id", "title"), "row_id"),
        lambda open_queries: table.drop("title").join(
            open_queries.select("query_id"), "query_id", "left_semi"
        ),
        save, k, min_distance, size,
    )
    found = {}
    for r in sorted(kept_rows(kept).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.doc_id, r.title))
    return found, sum(name.startswith("kept_") for name in rounds)


def expected(rows, k=10, min_distance=0.5):
    by_query = {}
    for query_id, _, doc_id, score, title in rows:
        by_query.setdefault(query_id, []).append((score, doc_id, title))
    return {q: [(d, t) for _, d, t in greedy(rs, k, min_distance)] for q, rs in by_query.items()}


def rows_of(query_id, titles, start=0):
    return [(query_id, start + i, f"d{start + i:04}", 100.0 - i, t) for i, t in enumerate(titles)]


def test_a_dropped_row_blocks_nothing(spark, tmp_path):
    rows = rows_of("q", ["aaaaaaaaaa", "aaaaaabbbb", "aabbbbbbbb"])
    found, _ = run(spark, rows, tmp_path)
    assert [t for _, t in found["q"]] == ["aaaaaaaaaa", "aabbbbbbbb"]


def test_exactly_half_is_kept(spark, tmp_path):
    found, _ = run(spark, rows_of("q", ["abcd", "abxx", "abcx"]), tmp_path)
    assert [t for _, t in found["q"]] == ["abcd", "abxx"]


def test_copies_shrink_to_one_and_empty_titles_stay(spark, tmp_path):
    rows = rows_of("copies", ["one title"] * 12) + rows_of("empty", [""] * 12, 100)
    found, _ = run(spark, rows, tmp_path)
    assert len(found["copies"]) == 1
    assert [d for d, _ in found["empty"]] == [f"d{100 + i:04}" for i in range(10)]


def test_empty_titles_over_several_rounds(spark, tmp_path):
    rows = rows_of("empty", [""] * 12)
    found, rounds = run(spark, rows, tmp_path, size=3)
    assert [d for d, _ in found["empty"]] == [f"d{i:04}" for i in range(10)]
    assert rounds == 4


def test_a_third_of_all_rows_is_one_title(spark, tmp_path):
    """More copies at the top than any window holds: later rounds reach what lies below."""
    near_copies = [f"breaking news about the harbour {i % 7}" for i in range(300)]
    below = ["quiet river", "tall mountain peaks", "x" * 30, "0123456789" * 4, "breaking news"]
    rows = rows_of("hot", near_copies + below) + rows_of("cold", below + near_copies[:2], 1000)
    found, rounds = run(spark, rows, tmp_path, size=20)
    assert found == expected(rows)
    assert len(found["hot"]) == 6 and rounds == 2


@pytest.mark.parametrize("size", [1, 2, 5, 200])
def test_any_window_gives_the_greedy_result(spark, tmp_path, size):
    rng = random.Random(size)
    rows = []
    for q in range(6):
        for i in range(rng.randint(1, 40)):
            base = rng.choice(["harbour bonds rise", "quiet town", "abcdefgh", ""])
            title = "".join(c if rng.random() < 0.7 else rng.choice("abcxyz ") for c in base)
            rows.append((f"q{q}", len(rows), f"d{len(rows):04}", float(rng.randint(0, 6)), title))
    found, rounds = run(spark, rows, tmp_path, k=4, size=size)
    assert found == expected(rows, k=4)
    assert rounds <= 4 + 5


def test_stretches_reach_the_whole_ranking(spark, tmp_path):
    """Far more candidates than windows: the walk goes down stretch by stretch."""
    rng = random.Random(5)
    titles = [f"{'daily weather bulletin number'}{rng.randint(0, 99):>3}" for _ in range(3000)]
    for place, title in ((900, "quiet river"), (2500, "x" * 30), (2999, "0123456789" * 4)):
        titles[place] = title
    found, rounds = run(spark, rows_of("deep", titles), tmp_path, size=2)
    assert [t for _, t in found["deep"]] == [
        titles[0], "quiet river", "x" * 30, "0123456789" * 4]
    assert 4 <= rounds <= 10


def test_a_stretch_does_not_split_equal_places(spark, tmp_path):
    """Scores that differ beyond the ninth decimal are ties, also at the end of a stretch."""
    rng = random.Random(11)
    rows = [("q", i, f"d{rng.randint(0, 10**6):07}", 5.0 + rng.random() * 1e-11,
             f"daily bulletin {rng.randint(0, 9)}") for i in range(400)]
    rows += [("q", 1000 + i, f"d{rng.randint(0, 10**6):07}", 5.0 + rng.random() * 1e-11,
              chr(97 + i) * 20) for i in range(12)]
    found, _ = run(spark, rows, tmp_path, size=2)
    assert found == expected(rows)


def test_no_candidates(spark, tmp_path):
    found, rounds = run(spark, [], tmp_path)
    assert found == {} and rounds == 1


def test_long_titles_are_compared_with_the_same_answer(spark):
    rng = random.Random(3)
    rows = []
    for size in (1, 40, LONG_TITLE, LONG_TITLE + 1, 700):
        a = "".join(rng.choice("abcdé ") for _ in range(size))
        for share in (0.0, 0.45, 0.55, 1.0):
            b = "".join(c for c in a if rng.random() >= share) + "x" * rng.randint(0, size // 4)
            rows += [(f"a{len(rows)}", a, b), (f"b{len(rows)}", b, a)]
    for _, a, b in rows:
        d = edit_distance(a, b)
        assert [edits_within(a, b, most) for most in (d - 1, d, d + 1)] == [False, True, True]
    queries = [(str(i), doc_id, a, b) for i, (doc_id, a, b) in enumerate(rows)]
    frame = spark.createDataFrame(queries, "query_id string, doc_id string, title string, other string")
    candidates = frame.select("query_id", "doc_id", "title")
    kept = frame.select("query_id", F.lit("kept").alias("kept_doc_id"), F.col("other").alias("kept_title"))
    found = {r.doc_id for r in ruled_out(candidates, kept).collect()}
    assert found == {doc_id for doc_id, a, b in rows if near(a, b)}
    assert 0 < len(found) < len(rows)


def test_one_query_is_ruled_out_in_many_tasks(spark):
    candidates = spark.range(3000).select(
        F.lit("q").alias("query_id"), F.col("id").cast("string").alias("doc_id"),
        F.lit("one title").alias("title"),
    )
    kept = spark.createDataFrame(
        [("q", "0", "one title")], "query_id string, kept_doc_id string, kept_title string"
    )
    sizes = ruled_out(candidates, kept).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 10 and sum(r["count"] for r in sizes) == 2999


def test_titles_side_by_side_have_the_same_answer(spark):
    """Around the ends of 64-bit numbers, in pairs of every kind, and the walks of many queries."""
    rng = random.Random(8)
    titles = [""]
    for size in (1, 2, 40, 63, 64, 65, 127, 128, 129, 300):
        a = "".join(rng.choice("abcdé 漢") for _ in range(size))
        titles += [a, *(
            "".join(c if rng.random() > share else rng.choice(["", "x", c + "y"]) for c in a)
            for share in (0.2, 0.5, 0.6)
        )]
    titles += ["z" * 1100, "z" * 1000 + "q" * 300]
    pairs = [(a, b) for i, a in enumerate(titles) for b in titles[max(0, i - 5):i + 6]]
    for least in (0.5, 1.0):
        assert near_pairs(pairs, least).tolist() == [near(a, b, least) for a, b in pairs]
    ranked = [[rng.choice(titles) for _ in range(rng.randint(0, 12))] for _ in range(40)]
    kept = [[rng.choice(titles)] if i % 3 == 0 else [] for i in range(40)]
    frame = spark.createDataFrame(list(zip(range(40), ranked, kept)), "q int, ranked array<string>, kept array<string>")
    found = {r.q: r.places for r in frame.select("q", walked(F.col("ranked"), F.col("kept"), 3).alias("places")).collect()}
    for q, (items, before) in enumerate(zip(ranked, kept)):
        stay, places = list(before), []
        for place, title in enumerate(items):
            if len(stay) < 3 and not any(near(title, other) for other in stay):
                stay.append(title)
                places.append(place)
        assert found[q] == places
    rows = frame.select("q", F.explode("ranked").alias("title"), "kept")
    out = rows.select("title", "kept", near_any(F.col("title"), F.col("kept")).alias("near")).collect()
    assert [r.near for r in out] == [any(near(r.title, other) for other in r.kept) for r in out]
    assert any(r.near for r in out)
