from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from quillrank.llm import periodic
from tests.llm.helpers import ODD_TEXTS, odd_docs


def runs_by_definition(items, least_length=6, least_periods=4):
    n, found = len(items), []
    for period in range(1, n // 2 + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and items[end] == items[end + period]:
                end += 1
            size = end - start + period
            smallest = all(
                items[start:start + size - q] != items[start + q:start + size]
                for q in range(1, period)
            )
            if end > start and size >= max(least_length, least_periods * period) and smallest:
                found.append((start, size, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def texts_with_runs(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        items = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 30))]
        part = items[:rng.randint(1, 6)]
        yield items + (part * 12)[:rng.randint(0, 40)] + items[::-1]


def test_grouping_gives_the_lyndon_array():
    for items in texts_with_runs(300, 1):
        for order in (items, [-item for item in items]):
            longest = []
            for at in range(len(order)):
                end = at + 1
                while end < len(order) and order[end:] > order[at:]:
                    end += 1
                longest.append(end - at)
            assert periodic.lyndon_array(order) == longest


def test_runs_equal_their_definition():
    for items in texts_with_runs(300, 2):
        assert periodic.find_runs(items) == runs_by_definition(items)
        assert periodic.find_runs(items, 2, 2) == runs_by_definition(items, 2, 2)
        assert periodic.text_runs([b"%d" % item for item in items]) == runs_by_definition(items)


def test_no_run_stands_outside_the_possible_parts():
    for items in texts_with_runs(300, 3):
        for least in ((6, 4), (2, 2), (9, 3)):
            parts = periodic.possible_parts(np.array(items, dtype=np.int64), *least)
            for start, size, _ in runs_by_definition(items, *least):
                assert sum(a <= start and start + size <= b for a, b in parts) == 1


def test_common_length():
    items = [1, 2, 3] * 50 + [9]
    assert periodic.common_length(items, 0, 3) == 147
    assert periodic.common_length(items, 0, 1) == 0
    assert periodic.common_length([5] * 100, 0, 1) == 99


def test_column_on_odd_rows(spark):
    docs = odd_docs(spark).withColumn("runs", F.lit("mine"))
    rows = docs.select("*", periodic.periodic_runs(F.col("text")).alias("found")).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    by_text = {r.text: r.found for r in rows}
    long = by_text["long text of words " * 3000]
    assert [tuple(r) for r in long.runs] == [(0, 12_000, 4)]
    assert long.collapsed == "long text of words"
    for text in (None, "", " \n\t "):
        assert by_text[text].runs == [] and by_text[text].collapsed == ""
    assert by_text["ünïcödé ▁ \x00 \U0001f600 end"].collapsed == "ünïcödé ▁ \x00 \U0001f600 end"
    empty = docs.where("false").select(periodic.periodic_runs(F.col("text")))
    assert empty.count() == 0


def test_white_space_is_ascii_only(spark):
    frame = spark.createDataFrame([("a b\x1c c " * 4 + "d\x0be\x0cf",)], "text string")
    found = frame.select(periodic.periodic_runs(F.col("text")).alias("x")).first().x
    assert [tuple(r) for r in found.runs] == [(0, 8, 2)]
    assert found.collapsed == "a b\x1c c d e f"


def test_strongest_run_is_compared_exactly(spark):
    runs = [(50, 8, 2), (0, 12, 3), (20, 4_000_000_001, 1_000_000_000), (90, 8, 2), (9, 4, 1)]
    told = [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs]
    schema = f"runs {periodic.RUNS}"
    frame = spark.createDataFrame([(told,), ([],), (told[:2],)], schema)
    best = [r.b for r in frame.select(periodic.strongest(F.col("runs")).alias("b")).collect()]
    assert tuple(best[0]) == runs[2] and best[1] is None and tuple(best[2]) == runs[1]
