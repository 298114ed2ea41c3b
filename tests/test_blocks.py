from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillrank.functions.dph import dph_parts, dph_term_score, ratio_gain
from quillrank.operators.blocks import Blocks, _coded, _pieces, best_in_blocks
from quillrank.operators.ranking import SCORE_DIGITS
from quillrank.operators.scoring import document_scores
from quillrank.plans import rank

from helpers import article, articles_frame, as_lists, assert_same, brute_force, queries_frame


def collection(n=120):
    rng = random.Random(5)
    words = ["".join(rng.choice("bdklmnorstu") for _ in range(4)) for _ in range(60)]

    def some(least, most):
        return " ".join(rng.choice(words[:rng.choice([5, 60])]) for _ in range(rng.randint(least, most)))

    rows = [article(f"d{i:03}", some(1, 4), some(0, 12), some(0, 3)) for i in range(n)]
    rows += [article(f"e{i}", rows[i][1], *[text for text, _ in rows[i][2]]) for i in range(20)]
    rows += [article("f0", None, words[0]), article("f1", "", words[0]), article("f2", "", words[1])]
    return rows, [some(1, 5) for _ in range(80)] + ["", words[0], words[0], "nowhere"]


def test_blocks_give_every_first_row(spark, tmp_path):
    rng, saved = random.Random(2), []
    docs = [
        (i, f"d{i}", None if i % 17 == 0 else "t", 10 + i % 7,
         [(t, rng.randint(1, 3)) for t in rng.sample("abcdefgh", rng.randint(0, 5))])
        for i in range(200)
    ]
    matches = spark.createDataFrame(
        docs, "row_id long, doc_id string, title string, dl long, matches array<struct<term:string,tf:long>>"
    )
    terms = spark.createDataFrame(
        [(q, t, 4, 300 if t == "a" else 20 + ord(t), 200, 13.0) for q in range(30)
         for t in rng.sample("abcdefgh", q % 4 + 1)] + [(99, "zz", 1, 1, 200, 13.0)],
        "query_id long, term string, n_terms long, cf long, n_docs long, avgdl double",
    )

    def save(name, rows):
        path = f"{tmp_path}/{len(saved)}-{name}"
        saved.append(name)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    keys = ["row_id", "doc_id"]
    for ratio in ("floor", "exact"):     # floor: minus infinity for the term that stands 300 times
        rounded = F.round("score", SCORE_DIGITS).alias("score")
        every = document_scores(matches, terms, ratio, keys).select("query_id", *keys, rounded)
        blocks = best_in_blocks(matches, terms, save, 4, ratio, keys, block_rows=64, part_queries=7)
        found = {tuple(r) for r in blocks.select("query_id", *keys, rounded).collect()}
        by_query: dict = {}
        for row in every.collect():
            by_query.setdefault(row[0], []).append(tuple(row))
        assert found <= {row for rows in by_query.values() for row in rows}
        for rows in by_query.values():
            bar = sorted((row[3] for row in rows), reverse=True)[:4][-1]
            assert {row for row in rows if row[3] >= bar} <= found
        assert len(found) < sum(map(len, by_query.values()))


def test_many_queries_rank_like_brute_force(spark):
    rows, lines = collection()
    assert len(set(lines)) > rank.BLOCK_QUERIES
    for options in ({}, {"cf_mode": "corpus", "ratio": "exact", "k": 3}):
        found = rank.rank_documents(queries_frame(spark, lines), articles_frame(spark, rows), **options)
        assert_same(as_lists(found), brute_force(spark, lines, rows, **options))


def scored_tables(spark, n=400, n_queries=60):
    rng = random.Random(4)
    docs = [
        (i, f"d{i:03}", rng.choice(["", "hot", f"t{i}"]), 20 + i % 89,
         [(t, rng.randint(1, 6)) for t in rng.sample("abcdefgh", 5)])
        for i in range(n)
    ]
    matches = spark.createDataFrame(
        docs, "row_id long, doc_id string, title string, dl long, matches array<struct<term:string,tf:long>>"
    )
    terms = spark.createDataFrame(
        [(q, t, 3, 20 + ord(t), n, 40.0) for q in range(n_queries) for t in rng.sample("abcdefgh", 3)],
        "query_id long, term string, n_terms long, cf long, n_docs long, avgdl double",
    )
    return matches, terms


def saver(spark, tmp_path):
    def save(name, rows):
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}")

    return save


def test_what_is_given_out_does_not_grow_with_the_blocks(spark, tmp_path):
    """A task gives out a window of a query, not one for every block, and exchanges queries alone."""
    matches, terms = scored_tables(spark)
    best = best_in_blocks(
        matches, terms, saver(spark, tmp_path), 3, "exact", ["row_id", "doc_id"], block_rows=20, part_queries=3
    )
    text = best._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning(part" in text
    assert best.rdd.getNumPartitions() <= 20 * 2   # 20 parts or so beside one partition of blocks
    rows = best.groupBy("query_id").count().collect()
    assert len(rows) == 60
    assert max(r["count"] for r in rows) <= 2 * 3 + 2


def test_folded_titles_stand_once(spark, tmp_path):
    matches, terms = scored_tables(spark)
    keys = ["row_id", "doc_id"]
    blocks = Blocks(
        matches, terms, saver(spark, tmp_path), "exact", keys, block_rows=150, part_queries=30, fold=True
    )
    every = document_scores(matches, terms, "exact", [*keys, "title"]).select(
        "query_id", *keys, F.round("score", SCORE_DIGITS).alias("score"), "title"
    ).collect()
    first: dict = {}
    for r in sorted(every, key=lambda r: (-r.score, r.doc_id, r.row_id)):
        title = r.title or r.row_id
        first.setdefault(r.query_id, {}).setdefault(title, r.row_id)
    found: dict = {}
    for r in blocks.best(5).collect():
        found.setdefault(r.query_id, set()).add(r.row_id)
    open_queries = terms.select("query_id").distinct().select(
        "query_id", F.array(F.lit(float("-inf"))).alias("bounds"), F.lit(0).alias("stretch")
    )
    whole: dict = {}
    for r in blocks.stretch(open_queries).collect():
        whole.setdefault(r.query_id, set()).add(r.row_id)
    for query, rows in first.items():
        assert set(list(rows.values())[:5]) <= found[query]
        assert set(rows.values()) <= whole[query]
    assert max(map(len, found.values())) < 20
    bounds = {r.query_id: r.bounds for r in blocks.bounds(open_queries, 5).collect()}
    scores = sorted((r.score for r in every if r.query_id == 0), reverse=True)
    assert bounds.keys() == first.keys() and all(b[-1] == float("-inf") for b in bounds.values())
    assert len(bounds[0]) > 1 and scores[0] > bounds[0][0] > scores[len(scores) // 3]


def test_parts_of_a_score_add_up(spark):
    rows = spark.createDataFrame(
        [(tf, dl, cf) for tf in (1, 2, 7) for dl in (7, 8, 500) for cf in (1, 30, 900)], "tf long, dl long, cf long"
    )
    avgdl, n_docs = F.lit(31.5), F.lit(800).cast("long")
    slope, rest = dph_parts(F.col("tf"), F.col("dl"), avgdl)
    for ratio in ("floor", "exact"):
        whole = dph_term_score(F.col("tf"), F.col("cf"), F.col("dl"), avgdl, n_docs, ratio)
        for r in rows.select(whole, slope * ratio_gain(n_docs, F.col("cf"), ratio) + rest).collect():
            assert r[0] == r[1] or abs(r[0] - r[1]) < 1e-12


def test_many_queries_go_on_below_the_first_window(spark):
    """Near-copies at the top of most queries, so that most walks go on in later rounds."""
    rows, lines = collection()
    words = rows[3][1].split()[0]
    rows += [article(f"g{i:03}", f"{words} title of near copies {i:03}", words, "t " * (i % 9)) for i in range(150)]
    lines += [words, f"{words} copies"]
    for options in ({"k": 3, "window": 2}, {"cf_mode": "corpus", "ratio": "exact", "k": 4, "window": 3}):
        window = options.pop("window")
        found = rank.rank_documents(
            queries_frame(spark, lines), articles_frame(spark, rows), window=window, **options
        )
        assert_same(as_lists(found), brute_force(spark, lines, rows, **options))


def test_pieces_hold_all_rows_and_few_bytes():
    batch = pa.RecordBatch.from_pydict({"n": list(range(1000)), "text": ["x" * 100] * 1000})
    for rows, size in ((100, 1 << 20), (10_000, 5_000), (1, 1)):
        pieces = list(_pieces(iter([batch, batch.slice(0, 0), batch]), rows, size))
        assert [n for piece in pieces for n in piece["n"].to_pylist()] == [*range(1000)] * 2
        assert all(4 * p.num_rows <= 6 * rows + 4 and p.nbytes <= 2 * size + 300 for p in pieces)


def test_pairs_with_one_slope_are_told_apart():
    slope, rest = np.array([1.0, 2.0, 1.0, 1.0]), np.array([5.0, 5.0, 6.0, 5.0])
    slopes, rests, code = _coded(slope, rest)
    assert slopes[code].tolist() == slope.tolist() and rests[code].tolist() == rest.tolist()
