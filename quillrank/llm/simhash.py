"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.components import components
from quillrank.llm.shared import Scratch

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_DISTANCE = 2
_SEGMENTS = 4
_SEGMENT_BITS = 64 // _SEGMENTS
_BLOCK = 1 << 17  # shingles whose bits are counted at once


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words; a shorter text is one run, one without words none.

    bytes.lower() and bytes.split() act on A-Z and on ASCII white space alone, which is what
    the contract asks.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[width - 1:].tolist() if len(words) >= width else [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(starts.tolist(), last, strict=False)],
        dtype=np.uint64,
    )


def text_fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint: a bit is set if it is set in more than half of the shingle hashes.
    A text without words has the fingerprint zero."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        octets = hashes[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprint(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """``text_fingerprint`` as a signed 64-bit column. Texts are hashed in Arrow batches, one
    row at a time; nothing is kept between rows."""

    @F.pandas_udf("long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = [text_fingerprint(text, width) for text in texts]
            yield pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return udf(text)


def _without(value: Column, segment: int) -> Column:
    mask = ((1 << _SEGMENT_BITS) - 1) << (segment * _SEGMENT_BITS)
    keep = ~mask & ((1 << 64) - 1)
    return value.bitwiseAND(F.lit(keep - (1 << 64) if keep >> 63 else keep))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: every pair of different fingerprints (column ``fp``, one row each) at two or
    fewer differing bits, once.

    The fingerprint has four segments, and table *j* indexes it without segment *j* (48 bits).
    Two fingerprints within two bits either differ in one segment only: then table *j* holds
    both under the same key. Or they differ by one bit in segment *i* and by one in *j* > *i*:
    then the radius-1 ball of segment *i* is enumerated, by setting each of its zero bits, and
    looked up in table *j* (only the side with the zero bit probes, so each pair is met
    once). Full distances are verified on what is found.

    A key fixes 48 of 64 bits, so a large group of near copies does not fall into one bucket:
    what shares a bucket differs within 16 bits. Rows are 56 short ones per fingerprint.
    """
    table = prints.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(j).alias("j"), _without(F.col("fp"), j).alias("key"))
            for j in range(_SEGMENTS)
        ])).alias("t"),
    ).select("fp", "t.j", "t.key")
    exact = F.array(*[
        F.struct(F.lit(j).alias("j"), F.lit(0).cast("long").alias("bit"))
        for j in range(_SEGMENTS)
    ])
    ball = F.array(*[
        F.struct(F.lit(j).alias("j"), F.lit(_signed(1 << bit)).cast("long").alias("bit"))
        for j in range(1, _SEGMENTS)
        for bit in range(j * _SEGMENT_BITS)
    ])
    probes = prints.select("fp", F.explode(F.concat(exact, ball)).alias("p")).where(
        F.col("fp").bitwiseAND(F.col("p.bit")) == 0
    )
    moved = F.col("fp").bitwiseOR(F.col("p.bit"))
    key = F.coalesce(*[F.when(F.col("p.j") == j, _without(moved, j)) for j in range(_SEGMENTS)])
    probes = probes.select(
        F.col("fp").alias("a"), F.col("p.j").alias("j"), F.col("p.bit").alias("bit"),
        key.alias("key"),
    )
    found = probes.join(table.withColumnRenamed("fp", "b"), ["j", "key"])
    apart = F.col("a").bitwiseXOR(F.col("b"))
    segment = F.coalesce(*[
        F.when(F.col("j") == j, apart != _without(apart, j)) for j in range(_SEGMENTS)
    ])
    once = F.when(F.col("bit") == 0, F.col("a") < F.col("b")).otherwise(segment)
    return found.where(once & (F.bit_count(apart) <= MAX_DISTANCE)).select("a", "b")


def groups(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``(fp, component)`` for every fingerprint of ``rows(key, fp)``: the smallest key of all
    rows reachable over links. Equal fingerprints are one node, so copies are never paired;
    rows with a null key belong to a group and never name it (a group of null keys alone has a
    null name)."""
    prints = scratch.table("prints", rows.groupBy("fp").agg(F.min(key).alias("least")))
    return name_groups(prints, links(prints.select("fp")), scratch)


def name_groups(prints: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """``(fp, component)`` for ``prints(fp, least)``: the smallest ``least`` reachable over
    ``found(a, b)``."""
    linked = components(found, scratch)
    linked = linked.join(prints.withColumnRenamed("fp", "node"), "node")
    first = linked.groupBy("root").agg(F.min("least").alias("first"))
    named = scratch.table("named", linked.join(first, "root").select("node", "first"))
    return scratch.table(
        "groups",
        prints.join(named.withColumnRenamed("node", "fp").withColumn("linked", F.lit(True)), "fp",
                    "left")
        .select("fp", F.when(F.col("linked"), F.col("first")).otherwise(F.col("least"))
                .alias("component")),
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, fp, component_id)``, one row per row of ``docs``: the SimHash of the whole text
    (signed) and the smallest key among the documents it is linked with, directly or over
    others, itself included.

    Null and empty texts have the fingerprint zero and link like any other; repeated rows are
    kept, each with the same answer; other columns are not read, so their names do not matter.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(
        "fingerprints",
        docs.select(F.col(key).alias("member"), fingerprint(F.col(text)).alias("fp")),
    )
    named = groups(rows, "member", scratch)
    return rows.join(named, "fp").select(
        F.col("member").alias(key), "fp", F.col("component").alias("component_id")
    )


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays per group: the one with the
    smallest key; among repeated rows with that key, one with the smallest text hash (equal
    rows stand for each other). Rows with a null key stay only where their whole group has
    none: then one of them."""
    scratch = Scratch(docs.sparkSession)
    mark = F.struct(F.xxhash64(F.lit("row"), F.col(text)), F.monotonically_increasing_id())
    rows = scratch.table(
        "kept-rows",
        docs.select(F.struct("*").alias("row"), F.col(key).alias("member"),
                    fingerprint(F.col(text)).alias("fp"), mark.alias("mark")),
    )
    return one_of_each(rows, groups(rows.select("member", "fp"), "member", scratch))


def one_of_each(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The ``row`` column of ``rows(row, member, fp, mark)``, one row per component of
    ``named(fp, component)``."""
    chosen = (
        rows.select("member", "fp", "mark").join(named, "fp")
        .where(F.col("member").eqNullSafe(F.col("component")))
        .groupBy(F.when(F.col("component").isNull(), F.col("fp")).alias("unnamed"), "component")
        .agg(F.min("mark").alias("mark"))
    )
    return rows.join(chosen.select("mark"), "mark", "left_semi").select("row.*")
