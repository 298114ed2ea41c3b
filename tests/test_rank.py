from __future__ import annotations

import os
import random

import pytest

from quillrank import rank_documents
from quillrank.plans.rank import search
from quillrank.sources.workspace import Workspace

from helpers import (
    article, articles_frame, as_lists, assert_same, brute_force, near, queries_frame,
)

QUERIES = ["bond", "marta bond", "on Lakeside IPO", "on the", "", "zzzz", "bond", "bond bonds"]


def corpus(n=80, seed=3):
    rng = random.Random(seed)
    words = ("bond bonds marta lakeside ipo shares market harbour river running the of and "
             "finance financial rises rose town quiet report").split()

    def text(low, high):
        return " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))

    rows = []
    for i in range(n):
        title = rng.choice([None, "", text(1, 3), text(4, 8), text(4, 8), "A bond for the harbour"])
        items = [(text(3, 30), rng.choice(["paragraph", "paragraph", "image", None]))
                 for _ in range(rng.randint(0, 9))]
        if rng.random() < 0.2:
            items.append(None)
        rows.append(article(f"a{i:03}", title, items=items))
    rows += [
        article("sixth", "late term", "a1", "a2", "a3", "a4", "a5", "ipo ipo ipo"),
        article("single", "ipo"),
        article("null", None, "ipo ipo"),
    ]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("options", [
    {}, {"cf_mode": "corpus"}, {"ratio": "exact"}, {"cf_mode": "corpus", "ratio": "exact", "k": 3},
    {"max_paragraphs": 1, "min_distance": 0.8},
])
def test_against_brute_force(spark, rows, tmp_path, options):
    found = rank_documents(
        queries_frame(spark, QUERIES), articles_frame(spark, rows), work_dir=str(tmp_path), **options
    )
    expected = brute_force(spark, QUERIES, rows, **options)
    assert_same(as_lists(found), expected)
    assert set(expected) == {"bond", "marta bond", "on Lakeside IPO", "bond bonds"}
    ids = {r.doc_id for r in found.collect()}
    assert "null" not in ids and "sixth" not in ids


def test_properties(spark, rows, tmp_path):
    found = as_lists(rank_documents(
        queries_frame(spark, QUERIES), articles_frame(spark, rows), work_dir=str(tmp_path),
        ratio="exact",
    ))
    for results in found.values():
        scores = [round(s, 9) for _, s, _ in results]
        assert len(results) <= 10 and scores == sorted(scores, reverse=True)
        titles = [t for *_, t in results]
        assert not any(near(a, b) for i, a in enumerate(titles) for b in titles[:i])


def test_partitioning_and_window_do_not_matter(spark, rows, tmp_path):
    expected = None
    for n, window in ((1, 200), (7, 200), (3, 2)):
        shuffled = random.Random(n).sample(rows, len(rows))
        found = as_lists(rank_documents(
            queries_frame(spark, QUERIES), articles_frame(spark, shuffled).repartition(n),
            work_dir=str(tmp_path), window=window,
        ))
        rounded = {q: [(d, round(s, 9), t) for d, s, t in rs] for q, rs in found.items()}
        expected = expected or rounded
        assert rounded == expected


def test_a_full_sieve_changes_nothing(spark, rows, tmp_path, monkeypatch):
    """With more query terms than the sieve has places, every word passes it."""
    monkeypatch.setattr("quillrank.operators.sieve.SLOTS", 1)
    found = rank_documents(
        queries_frame(spark, QUERIES), articles_frame(spark, rows), work_dir=str(tmp_path)
    )
    assert_same(as_lists(found), brute_force(spark, QUERIES, rows))


def test_as_many_queries_as_articles(spark, rows, tmp_path):
    lines = [" ".join(c[0] for c in contents if c and c[0])[:60] for _, _, contents in rows]
    options = {"cf_mode": "corpus", "ratio": "exact", "k": 4}
    found = rank_documents(
        queries_frame(spark, lines), articles_frame(spark, rows), work_dir=str(tmp_path), **options
    )
    assert_same(as_lists(found), brute_force(spark, lines, rows, **options))


def test_later_rounds_and_nothing_left_behind(spark, rows, tmp_path):
    with Workspace(spark, str(tmp_path)) as space:
        found = as_lists(search(
            space, queries_frame(spark, QUERIES), articles_frame(spark, rows), window=2
        ))
        rounds = [name for name in space.tables if name.startswith("kept_")]
        assert len(rounds) >= 3 and "found" not in space.tables
    assert_same(found, brute_force(spark, QUERIES, rows))
    assert os.listdir(tmp_path) == []


def test_nothing_broadcast_gives_the_same(spark, rows, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = as_lists(rank_documents(
            queries_frame(spark, QUERIES), articles_frame(spark, rows),
            work_dir=str(tmp_path), window=2,
        ))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert_same(found, brute_force(spark, QUERIES, rows))


def test_articles_sharing_an_id_stay_apart(spark, tmp_path):
    rows = [article("same", "ipo day", "ipo"), article("same", "quiet river bank", "ipo x y z"),
            *[article(f"f{i}", f"filler {i}", "nothing here") for i in range(9)]]
    found = as_lists(rank_documents(
        queries_frame(spark, ["ipo"]), articles_frame(spark, rows), work_dir=str(tmp_path)
    ))
    assert_same(found, brute_force(spark, ["ipo"], rows))
    assert len(found["ipo"]) == 2


def test_copies_of_whole_documents(spark, tmp_path):
    """Collapsing copies changes neither the statistics nor the order among documents."""
    rng = random.Random(9)
    rows = corpus(20) + [article(f"e{i}", "", "ipo news") for i in range(4)]
    rows = [(f"{doc_id}-{rng.randint(0, 9999):04}", title, contents)
            for doc_id, title, contents in rows for _ in range(rng.choice([1, 2, 9]))]
    for options in ({}, {"ratio": "exact", "cf_mode": "corpus"}, {"min_distance": 0.0}):
        found = as_lists(rank_documents(
            queries_frame(spark, QUERIES), articles_frame(spark, rows), work_dir=str(tmp_path),
            window=5, **options,
        ))
        assert_same(found, brute_force(spark, QUERIES, rows, **options))


def test_no_query_matches(spark, tmp_path):
    for lines in (["zzzz"], ["on the", ""]):
        found = rank_documents(
            queries_frame(spark, lines), articles_frame(spark, corpus(5)), work_dir=str(tmp_path)
        )
        assert found.collect() == []
        assert found.columns == ["query_id", "original_query", "rank", "doc_id", "score", "title"]
