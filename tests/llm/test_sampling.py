from __future__ import annotations

import math
import random
import struct

import xxhash
from pyspark.sql import functions as F

from quillrank.llm import cws

_MASK = (1 << 64) - 1


def _hash(*values):
    """What ``xxhash64`` gives for columns of these kinds (``q`` long, ``i`` int), unsigned."""
    seed = 42
    for kind, value in values:
        seed = xxhash.xxh64_intdigest(struct.pack(f"<{kind}", value), seed)
    return seed


def _signed(number):
    return number - (1 << 64) if number >> 63 else number


def _uniform(bits, shift, width=26):
    return (((bits >> shift) & ((1 << width) - 1)) + 0.5) / (1 << width)


def _plain_sample(term, weight, number):
    """``(a on its scale, mark)`` of one sample of a term, by the definition."""
    first, second = (_hash(("q", term), ("i", 2 * number + i)) for i in (0, 1))
    r = -math.log(_uniform(first, 0) * _uniform(first, 26))
    ln_c = math.log(-math.log(_uniform(second, 0) * _uniform(second, 26)))
    b = _uniform(((first >> 52) << 12) + (second >> 52), 0, 24)
    t = math.floor(math.log(weight) / r + b)
    ln_a = ln_c - r * (t - b + 1)
    mark = _hash(("q", _signed(first)), ("q", t)) & ((1 << 32) - 1)
    return int((max(ln_a, -60.0) + 60.0) * (1 << 25)), mark


def _parts(key):
    return key >> 32, key & ((1 << 32) - 1)


def test_samples_of_a_term_are_the_plain_ones(spark):
    draw = random.Random(3)
    rows = [(draw.randrange(-1 << 63, 1 << 63), w) for w in (1, 1, 1, 2, 3, 7, 40, 100_000)]
    frame = spark.createDataFrame(rows, "term long, weight long")
    found = frame.select("term", "weight", cws.term_samples(F.col("term"), F.col("weight"), 64)
                         .alias("samples")).collect()
    assert len(found) == len(rows)
    for row in found:
        for i, key in enumerate(row.samples):
            scaled, mark = _parts(key)
            plain, plain_mark = _plain_sample(row.term, row.weight, i)
            # one step of 2 ** -25 for the last digit of a logarithm
            assert abs(scaled - plain) <= 1 and mark == plain_mark


def test_a_signature_is_the_least_of_its_terms(spark):
    draw = random.Random(4)
    vocabulary = [draw.randrange(-1 << 63, 1 << 63) for _ in range(30)]
    texts = {
        key: {term: draw.choice([1, 1, 2, 5]) for term in draw.sample(vocabulary, 12)}
        for key in range(9)
    }
    rows = [(k % 2, k, t, w) for k, terms in texts.items() for t, w in terms.items()]
    # null terms and weights that are null or not above zero take no part, alone or beside others
    rows += [(0, 0, None, 9), (1, 1, vocabulary[0] ^ 1, 0), (1, 3, vocabulary[1] ^ 1, None),
             (0, 100, None, 1), (1, 101, 5, 0), (1, 101, 6, None)]
    frame = spark.createDataFrame(rows, "part int, name int, term long, weight long")
    found = {r.name: r.samples for r in cws.sampled(frame, "part", "name", 20).collect()}
    assert set(found) == {*texts, 100, 101}
    assert found[100] == found[101] == [None] * 20
    for name, terms in texts.items():
        for i, key in enumerate(found[name]):
            best = min(_plain_sample(t, w, i) for t, w in terms.items())
            assert abs(_parts(key)[0] - best[0]) <= 1 and _parts(key)[1] == best[1]
    assert cws.sampled(frame.where("false"), "part", "name").count() == 0


def test_shares_do_not_change_signatures(spark):
    rows = [(k, t, 1 + (k + t) % 3) for k in range(12) for t in range(k, k + 8)]
    frame = spark.createDataFrame(rows, "name int, term long, weight long")
    one, many = (
        {r.name: r.samples for r in cws.sampled(
            frame.withColumn("part", F.col("name") % parts), "part", "name", 16
        ).collect()} for parts in (1, 5)
    )
    assert one == many and len(one) == 12


def test_lists_are_sorted_by_term_first(spark):
    """The sort behind the lists compares a prefix of the first column, which a share does not tell apart."""
    frame = spark.createDataFrame([(0, 1, 5, 2)], "part int, name int, term long, weight long")
    plan = cws.sampled(frame, "part", "name", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [term" in plan
