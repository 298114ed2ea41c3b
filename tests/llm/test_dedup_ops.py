"""SimHash near-duplicates and line deduplication against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quillrank.llm import components, linededup, simhash
from quillrank.llm.shared import Scratch
from tests.llm.helpers import ODD_TEXTS, docs_of, odd_docs


def _plain_fingerprint(text):
    words = [w for w in _ascii_words((text or "").translate(_LOWER))]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64)
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _ascii_words(text):
    for char in "\t\n\x0b\x0c\r":
        text = text.replace(char, " ")
    return [word for word in text.split(" ") if word]


def _groups(prints):
    """Smallest index reachable over links of two or fewer bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [*ODD_TEXTS, "One", "one TWO", "Ein ÄPFEL und Ein äpfel"])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.text_fingerprint(text) == _plain_fingerprint(text)


def test_links_are_all_pairs_within_two_bits(spark):
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    values = set(centres)
    for centre in centres:
        for _ in range(25):
            value = centre
            for _ in range(draw.choice([1, 1, 2, 2, 3, 5])):
                value ^= 1 << draw.randrange(64)
            values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    pairs = Counter(tuple(sorted((r.a, r.b))) for r in found)
    mask = (1 << 64) - 1
    expected = {
        tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i]
        if ((a ^ b) & mask).bit_count() <= 2
    }
    assert set(pairs) == expected and set(pairs.values()) == {1}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(7, 7)]
    rows = components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark))
    roots = {r.node: r.root for r in rows.collect()}
    assert len({roots[i] for i in range(201)}) == 1
    assert len({roots[i] for i in range(1000, 1300)}) == 1
    assert roots[0] != roots[1000] and len(roots) == 501


def test_near_duplicates_on_small_texts(spark):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [base, base + " x", base, "other words", base.replace("w7 ", "v7 "), "", None]
    rows = simhash.near_duplicates(docs_of(spark, texts)).collect()
    prints = [_plain_fingerprint(t) for t in texts]
    assert {r.doc_id: r.fp & ((1 << 64) - 1) for r in rows} == dict(enumerate(prints))
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(_groups(prints)))


def test_near_duplicates_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[0] == 0 and by_id[3] == by_id[4] == 3
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    kept_ids = Counter(r.doc_id for r in kept.collect())
    assert kept_ids[0] == 1 and kept_ids[3] == 1 and not kept_ids[1] and not kept_ids[4]
    empty = docs.where("false")
    assert simhash.near_duplicates(empty).count() == simhash.representatives(empty).count() == 0


def _plain_line_dedup(texts, min_docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(_LOWER)

    lines = [(text or "").split("\n") for text in texts]
    counts = Counter(k for ls in lines for k in {key(x) for x in ls})
    out = []
    for ls in lines:
        kept = [x for x in ls if not key(x) or counts[key(x)] < min_docs]
        out.append(("\n".join(kept), len(ls), len(ls) - len(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_line_dedup_is_the_plain_one(spark, batches):
    draw = random.Random(5)
    pool = [f" Line {i} " for i in range(6)] + ["", "rare", "ÄB", "äB", "line 1"]
    texts = ["\n".join(draw.choices(pool, k=draw.randrange(1, 9))) for _ in range(40)]
    texts += [None, "", "\n\n", "only here"]
    rows = linededup.drop_frequent_lines(docs_of(spark, texts), min_docs=12, batches=batches)
    found = {r.row.doc_id: (r.kept_text, r.n_lines, r.n_dropped) for r in rows.collect()}
    assert found == dict(enumerate(_plain_line_dedup(texts, 12)))


def test_line_dedup_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = linededup.drop_frequent_lines(docs, min_docs=2).collect()
    assert len(rows) == docs.count()
    by_id = {r.row.doc_id: r for r in rows}
    assert by_id[0].kept_text == "" and by_id[0].n_lines == 1 and by_id[0].n_dropped == 0
    assert by_id[3].n_dropped == 1 and by_id[3].kept_text == ""
    assert linededup.drop_frequent_lines(docs.where("false")).count() == 0


def test_line_counts_settle_across_levels(spark):
    runs = linededup.LineRuns(Scratch(spark), min_docs=4, fanout=2)
    for n in [1, 2, 2, 5, 1]:
        keys = spark.range(n).select(F.lit(7).cast("long").alias("h1"), F.lit(8).cast("long")
                                     .alias("h2"))
        lone = spark.createDataFrame([(n, 100 * n)], "h1 long, h2 long")
        runs.add(keys.union(lone))
    assert [(r.h1, r.h2) for r in runs.finish().collect()] == [(7, 8)]


def _edited_texts():
    """Families of texts with some words exchanged, chains of them, and others."""
    draw = random.Random(8)
    texts = ["", None, "a b", "A  b", "a b c", " \n"]
    for size in (30, 80, 200, 600):
        for _ in range(4):
            base = [f"w{draw.randrange(500)}" for _ in range(size)]
            for edits in (0, 0, 1, size // 60, size // 50, size // 45, size // 20):
                words = list(base)
                for _ in range(edits):
                    words[draw.randrange(size)] = f"v{draw.randrange(10_000)}"
                texts.append(" ".join(words))
    chain = [f"c{i}" for i in range(300)]
    for step in range(8):
        texts.append(" ".join(chain[20 * step:] + [f"d{i}" for i in range(20 * step)]))
    draw.shuffle(texts)
    return texts


def test_pipeline_near_dedup_keeps_one_of_each_brute_force_group(spark):
    texts = _edited_texts()
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "").collect()
    groups = _groups([_plain_fingerprint(text) for text in texts])
    assert sorted(r.doc_id for r in kept) == sorted(set(groups))
    assert len(set(groups)) < len(set(texts))  # other texts than exact copies were linked
    assert all(r.text == texts[r.doc_id] for r in kept)
