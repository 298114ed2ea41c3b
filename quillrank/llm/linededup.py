"""Line deduplication over levelled sorted runs of line hashes. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.shared import ASCII_SPACE, Scratch, lower_ascii

MIN_CHARS = 1
MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
_HASH = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(ASCII_SPACE))


def _hash(line: Column) -> list[Column]:
    """128 bits, so that two keys of a very large corpus do not share a count."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


class LineRuns:
    """How many documents hold each line, kept the way a log-structured store keeps it.

    A *run* is a table of ``(h1, h2, n)``, sorted by hash within its files, one row per line
    hash. Every batch of documents adds a run to level 0. ``fanout`` runs of a level are
    compacted into one run of the next. A line that has reached ``min_docs`` moves to the
    *settled* keys, and the batches that follow merge-anti-join those, so lines that are known
    to be frequent are neither stored nor counted again. Per document a line counts once.
    """

    def __init__(self, scratch: Scratch, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.scratch, self.min_docs, self.fanout = scratch, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []
        self._written = 0

    def _write(self, name: str, rows: DataFrame) -> DataFrame:
        self._written += 1
        return self.scratch.table(f"{name}-{self._written}", rows.sortWithinPartitions(*_HASH))

    def known(self) -> DataFrame | None:
        """``(h1, h2)`` of the settled lines; every key is settled once."""
        return reduce(DataFrame.union, self.settled) if self.settled else None

    def add(self, keys: DataFrame) -> None:
        """``keys(h1, h2)``: one row per document of the batch and line key."""
        counted = keys.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("n"))
        known = self.known()
        if known is not None:
            counted = counted.join(known, _HASH, "left_anti")
        self._place(0, self._write("run", counted))

    def _place(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._place(level + 1, self._compact(runs))

    def _compact(self, runs: list[DataFrame]) -> DataFrame:
        """One run from several; what is frequent by now moves to the settled keys."""
        total = reduce(DataFrame.union, runs).groupBy(*_HASH).agg(F.sum("n").alias("n"))
        known = self.known()
        if known is not None:  # a line may have settled after one of the runs was written
            total = total.join(known, _HASH, "left_anti")
        merged = self._write("compacted", total)
        self.settled.append(merged.where(F.col("n") >= self.min_docs).select(*_HASH))
        return merged.where(F.col("n") < self.min_docs)

    def finish(self) -> DataFrame:
        """Compact all that is left; ``(h1, h2)`` of the lines of at least ``min_docs``
        documents."""
        runs = [run for level in self.levels for run in level]
        self.levels = []
        if runs:
            self._compact(runs)
        return self.known()


def _batches(docs: DataFrame, text: str, n: int) -> list[DataFrame]:
    part = F.pmod(F.xxhash64(F.lit("batch"), F.col(text), F.col("id")), F.lit(n))
    return [docs.where(part == i) for i in range(n)] if n > 1 else [docs]


def _row_key(key: str, text: str) -> list[Column]:
    """Tells rows apart that share a key, null keys too; equal rows have equal lines."""
    return [F.col(key).alias("id"), F.xxhash64(F.lit("text"), F.col(text)).alias("text_hash")]


def frequent_lines(
    rows: DataFrame, scratch: Scratch, min_chars: int, min_docs: int, batches: int
) -> DataFrame:
    """``(h1, h2)`` of the line keys in at least ``min_docs`` rows of ``rows(id, text)``. The
    keys of a row are made distinct within the row, and each task counts its own before the
    exchange, so a line that a third of the corpus shares makes no hot partition."""
    runs = LineRuns(scratch, min_docs)
    for batch in _batches(rows, "text", batches):
        lines = F.transform(split_lines(lower_ascii(F.col("text"))), _trimmed)
        keys = batch.select(F.explode(F.array_distinct(lines)).alias("line"))
        runs.add(keys.where(F.length("line") >= max(min_chars, 1)).select(*_hash(F.col("line"))))
    return runs.finish()


def drop_frequent_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """All columns of ``docs`` in the struct ``row``, with ``kept_text, n_lines, n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Lines
    whose key has at least ``min_chars`` code points (never the empty one) and stands in at
    least ``min_docs`` rows are dropped wherever they stand; the others stay as they are,
    joined by a line feed. A null or empty text is one empty line, and its kept text is
    empty; a text that loses all lines is empty too. Every row counts as a document, repeated
    rows and rows with a null key included.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    frequent = scratch.table("frequent", frequent_lines(rows, scratch, min_chars, min_docs, batches))
    lines = docs.select(
        *_row_key(key, text), F.posexplode(split_lines(lower_ascii(F.col(text))))
    ).select("id", "text_hash", "pos", _trimmed(F.col("col")).alias("line"))
    lines = lines.where(F.length("line") >= max(min_chars, 1))
    hits = (
        lines.select("id", "text_hash", "pos", *_hash(F.col("line")))
        .join(frequent, _HASH)
        .groupBy("id", "text_hash")
        .agg(F.collect_list("pos").alias("dropped"))
    )
    whole = docs.select(F.struct("*").alias("row"), *_row_key(key, text))
    same = whole["id"].eqNullSafe(hits["id"]) & whole["text_hash"].eqNullSafe(hits["text_hash"])
    joined = whole.join(hits, same, "left").select(
        "row",
        split_lines(F.col("row")[text]).alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = joined.select("row", "lines", F.array_except(places, F.col("dropped")).alias("kept"))
    return kept.select(
        "row",
        F.array_join(
            F.transform("kept", lambda at: F.get(F.col("lines"), at)), "\n"
        ).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )
