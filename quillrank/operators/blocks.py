"""Scores of many queries, block by block: a task holds a part of the queries and reads one block of documents
after the other.

A row for every query, document and term is what a join on the term makes, and with many queries
there are far more of them than of anything that is read or returned. Here the documents of a block stand by
term, and a query adds up the columns of its terms. Every query meets every block, so nothing is left out.
A task keeps of each query what may still be among its first rows and gives that out at its end, so what is
written grows with the queries and not with the queries times the blocks. Blocks and parts are read
from their files by each task that needs them and are not exchanged.
"""

from __future__ import annotations

import ctypes
import pickle
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.functions.dph import dph_parts, ratio_gain
from quillrank.operators.dedup import bounds_from_cuts, shares

# Functions of this module travel with the tasks, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 14      # documents of a block
_BLOCK_BYTES = 24 << 20   # and their terms and numbers, before they are packed
PART_QUERIES = 1 << 14    # queries of a part, at most
_FEW_QUERIES = 1 << 8     # a part has no fewer, where that leaves enough tasks
_TASKS_PER_CORE = 4
_ROWS_OUT = 200_000
_ROWS_HELD = 4_000_000    # what a task keeps at most before it gives out what it has
_DENSE_TERMS = 1 << 8     # columns that a cell keeps as one number for each document, at most
_MARGIN = 2e-9            # scores are ranked as rounded to nine decimals


def _bytes(told: object) -> pa.Array:
    return pa.array([zstandard.compress(pickle.dumps(told, protocol=5))], pa.binary())


def _give_back() -> None:
    """Freed memory goes back to the system: a Python worker lives on when its task has ended."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc has it
    if trim:
        trim(0)


def _told(packed: pa.Scalar):
    return pickle.loads(zstandard.decompress(packed.as_py()))


def _pieces(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[pa.Table]:
    """The rows of a task in pieces of so many rows and bytes at most, about."""
    waiting: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        step = max(1, min(most_rows // 4, batch.num_rows * most_bytes // (4 * max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            waiting.append(batch.slice(at, step))
            rows, size = rows + waiting[-1].num_rows, size + waiting[-1].nbytes
            if 4 * rows >= 5 * most_rows or size >= most_bytes:
                yield pa.Table.from_batches(waiting)
                waiting.clear()
                rows = size = 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _coded(slope: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of two columns, and for each row the number of its pair."""
    slopes, first, code = np.unique(slope, return_index=True, return_inverse=True)
    rests = rest[first]
    if not np.array_equal(rests[code], rest):   # two pairs with one slope
        pairs, code = np.unique(slope + 1j * rest, return_inverse=True)
        slopes, rests = pairs.real.copy(), pairs.imag.copy()
    return slopes, rests, code.astype(np.uint16 if len(slopes) < 1 << 16 else np.uint32)


def _pack_documents(keys: Sequence[str], block_rows: int):
    """Blocks whose documents stand in the order of ``doc_id`` and ``row_id``, which breaks ties."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, rows in enumerate(_pieces(batches, block_rows, _BLOCK_BYTES)):
            block = rows["block"][0].as_py() << 20 | n
            held = rows["held"].combine_chunks()
            counts = np.diff(held.offsets.to_numpy())
            held, rows = held.flatten(), rows.drop_columns(["held"])
            order = pc.sort_indices(
                rows, [("doc_id", "ascending"), ("row_id", "ascending")], null_placement="at_start"
            )
            rows = rows.take(order).combine_chunks()
            at = np.empty(len(counts), np.uint32)
            at[order.to_numpy()] = np.arange(len(counts), dtype=np.uint32)
            terms = held.field("term").dictionary_encode()
            numbers = terms.indices.to_numpy()
            starts = np.concatenate([[0], np.cumsum(np.bincount(numbers, minlength=len(terms.dictionary)))])
            by_term = np.argsort(numbers, kind="stable").astype(np.uint32)
            place = np.repeat(at, counts)[by_term]
            slopes, rests, code = _coded(held.field("slope").to_numpy(), held.field("rest").to_numpy())
            del held, numbers
            _give_back()
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()),
                _bytes((
                    [rows[name].combine_chunks() for name in keys], rows["title_code"].to_numpy(),
                    terms.dictionary, starts, place, code[by_term], slopes, rests,
                )),
            ], ["block", "documents"])

    return pack


def _pack_queries(part_queries: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not sum(batch.num_rows for batch in tables):
            return
        rows = pa.Table.from_batches(tables)
        part = rows["part"][0].as_py() << 20
        rows = rows.take(pc.sort_indices(rows, [("query_id", "ascending")]))
        names, firsts = np.unique(rows["query_id"].to_numpy(), return_index=True)
        firsts = np.append(firsts, rows.num_rows)
        for n, at in enumerate(range(0, len(names), part_queries)):
            to = min(len(names), at + part_queries)
            some = rows.slice(firsts[at], firsts[to] - firsts[at])
            terms = some["term"].combine_chunks().dictionary_encode()
            numbers = terms.indices.to_numpy()
            gains = np.zeros(len(terms.dictionary))
            gains[numbers] = some["gain"].to_numpy()
            first = firsts[at:to] - firsts[at]
            yield pa.RecordBatch.from_arrays([
                pa.array([part | n], pa.int64()),
                _bytes((
                    names[at:to], some["n_terms"].to_numpy()[first],
                    np.append(first, some.num_rows), numbers, terms.dictionary, gains,
                    some["bound"].to_numpy()[first],
                )),
            ], ["part", "queries"])

    return pack


class _Cell:
    """The sums of the queries of a part over the documents of a block."""

    def __init__(self, block, queries):
        columns, _, terms, starts, place, code, slope, rest = block
        _, _, firsts, numbers, wanted, gains, _ = queries
        at = pc.index_in(wanted, value_set=terms).fill_null(-1).to_numpy()
        gain = np.zeros(len(terms))
        gain[at[at >= 0]] = gains[at >= 0]
        self.place = place.astype(np.intp)
        self.scores = slope[code] * np.repeat(gain, np.diff(starts)) + rest[code]
        self.starts, self.firsts, self.numbers = starts.tolist(), firsts.tolist(), at[numbers].tolist()
        self.hit = np.zeros(len(columns[0]), bool)
        lengths = np.diff(starts)
        often = np.argsort(-lengths, kind="stable")[:_DENSE_TERMS]
        self.dense = dict.fromkeys(often[16 * lengths[often] > len(self.hit)].tolist())

    def _terms(self, q: int) -> list[int]:
        return [t for t in self.numbers[self.firsts[q]:self.firsts[q + 1]] if t >= 0]

    def sums(self, q: int) -> np.ndarray | None:
        """Of all documents, 0 for those without a term."""
        terms = self._terms(q)
        if not terms:
            return None
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in terms if t not in self.dense]
        if spans:
            places, scores = (np.concatenate([column[some] for some in spans]) for column in (self.place, self.scores))
            total = np.bincount(places, scores, len(self.hit))
        else:
            total = np.zeros(len(self.hit))
        for t in terms:
            if t in self.dense:
                if self.dense[t] is None:
                    some = slice(self.starts[t], self.starts[t + 1])
                    self.dense[t] = np.zeros(len(total))
                    self.dense[t][self.place[some]] = self.scores[some]
                total += self.dense[t]
        return total

    def matched(self, q: int) -> np.ndarray:
        for t in self._terms(q):
            self.hit[self.place[self.starts[t]:self.starts[t + 1]]] = True
        matched = np.flatnonzero(self.hit)
        self.hit[matched] = False
        return matched

    def reaching(self, q: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """The documents with a term whose sum reaches ``bound``, and these sums."""
        total = self.sums(q)
        if total is None:
            return np.zeros(0, np.intp), np.zeros(0)
        if bound > 0:
            matched = np.flatnonzero(total >= bound)
        else:
            matched = self.matched(q)
            matched = matched[total[matched] >= bound]
        return matched, total[matched]


def _narrowed(places: np.ndarray, sums: np.ndarray, titles: np.ndarray | None, n: int, margin: float):
    """Fewer of them, with all that may be among the first ``n``, or the first rows of the first ``n`` titles."""
    size = n if titles is None else 4 * n
    while size < len(sums):
        enough = sums >= np.partition(sums, len(sums) - size)[len(sums) - size] - margin
        if titles is None or len(np.unique(titles[places[enough]])) >= n:
            return places[enough], sums[enough]
        size *= 8
    return places, sums


def _by_title(scores: np.ndarray, titles: np.ndarray, refs: np.ndarray):
    """The rows that may be the first of their title, best first within it, and the best score of each
    title. Of rows of one block with one title and score the first alone stands, as it comes first."""
    order = np.lexsort((refs, -scores, titles))
    t, s, block = titles[order], scores[order], refs[order] >> 32
    same = t[1:] == t[:-1]
    head = np.concatenate([[True], ~same])
    best = s[head]
    stays = s >= best[np.cumsum(head) - 1] - _MARGIN
    stays[1:] &= ~(same & (s[1:] == s[:-1]) & (block[1:] == block[:-1]))
    return order[stays], best


class _Held:
    """What a task keeps of its queries: for each the rows that may be among its first ``n`` (by title, if titles
    are folded) and the score of the ``n``-th, and of each block the keys of the documents that rows refer to."""

    def __init__(self, n: int, fold: bool, tie: tuple[int, int]):
        self.n, self.fold, self.tie = n, fold, tie
        self.rows: dict[int, tuple] = {}
        self.bars: dict[int, float] = {}
        self.columns: dict[int, tuple[np.ndarray | None, list[pa.Array]]] = {}
        self.count = 0

    def _key(self, ref: int) -> tuple:
        used, columns = self.columns[ref >> 32]
        at = ref & 0xFFFFFFFF
        at = at if used is None else int(np.searchsorted(used, at))
        name, row_id = (columns[i][at].as_py() for i in self.tie)
        return name is not None, name or "", row_id

    def _first_by_key(self, scores, titles, refs):
        """Rows of several blocks with one title and score: the one with the lowest key."""
        first: dict[tuple, int] = {}
        for i, row in enumerate(zip(titles.tolist(), scores.tolist())):
            if row not in first or self._key(int(refs[i])) < self._key(int(refs[first[row]])):
                first[row] = i
        return np.array(sorted(first.values()))

    def shorten(self, scores, titles, refs):
        """The rows that may be among the first ``n`` (titles), and the score of the ``n``-th or nothing."""
        if self.fold:
            chosen, best = _by_title(scores, titles, refs)
            scores, titles, refs = scores[chosen], titles[chosen], refs[chosen]
            if len(chosen) > len(best):
                chosen = self._first_by_key(scores, titles, refs)
                scores, titles, refs = scores[chosen], titles[chosen], refs[chosen]
        else:
            best = scores
        if len(best) < self.n:
            return (scores, titles, refs), None
        bar = float(np.partition(best, len(best) - self.n)[len(best) - self.n])
        stays = scores >= bar - _MARGIN
        level = np.flatnonzero(scores == bar)
        if self.fold and len(level) > 2 * self.n:   # of many equal scores the lowest keys come first
            late = sorted(level.tolist(), key=lambda i: self._key(int(refs[i])))[self.n:]
            stays[late] = False
        return (scores[stays], titles[stays], refs[stays]), bar

    def offer(self, name: int, cell: _Cell, q: int, n_terms: int, titles: np.ndarray, ref: int) -> None:
        margin, bar = _MARGIN * n_terms, self.bars.get(name)
        codes = titles if self.fold else None

        def new(places, sums):
            places, sums = _narrowed(places, sums, codes, self.n, margin)
            return sums / n_terms, titles[places], ref | places.astype(np.int64)

        found = None
        if bar is not None:
            places, sums = cell.reaching(q, bar * n_terms - margin)
        else:
            total = cell.sums(q)
            if total is None:
                return
            places = np.flatnonzero(total > 0)
            if len(places) >= self.n:
                rows, least = self.shorten(*new(places, total[places]))
                # all others of this block are below, also those whose terms add up to nothing or less
                found = rows if least is not None and least > 2 * _MARGIN else None
            if found is None:
                places = cell.matched(q)
                sums = total[places]
        if found is None:
            if not len(places):
                return
            found = new(places, sums)
        held = self.rows.get(name)
        if held is not None:
            self.count -= len(held[0])
            found = tuple(np.concatenate(pair) for pair in zip(held, found))
        found, least = self.shorten(*found)
        if least is not None and (bar is None or least > bar):
            self.bars[name] = least
        self.rows[name] = found
        self.count += len(found[0])

    def reads(self, block: int, columns: list[pa.Array]) -> None:
        self.columns[block] = (None, columns)

    def leaves(self, block: int) -> None:
        """Keep the keys of the documents of the block that rows refer to."""
        refs = [rows[2] for rows in self.rows.values()]
        refs = np.concatenate(refs) if refs else np.zeros(0, np.int64)
        used = np.unique(refs[refs >> 32 == block] & 0xFFFFFFFF)
        self.columns[block] = (used, [column.take(pa.array(used)) for column in self.columns[block][1]])

    def rows_out(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """Give out all rows; the scores to reach are kept."""
        told, waiting = list(self.rows.items()), 0
        at = 0
        for to, (_, rows) in enumerate(told, 1):
            waiting += len(rows[0])
            if waiting < _ROWS_OUT and to < len(told):
                continue
            some = told[at:to]
            at, waiting = to, 0
            query = np.repeat([name for name, _ in some], [len(rows[0]) for _, rows in some])
            score, refs = (np.concatenate([rows[i] for _, rows in some]) for i in (0, 2))
            for block in np.unique(refs >> 32).tolist():
                here = refs >> 32 == block
                used, columns = self.columns[block]
                places = pa.array(np.searchsorted(used, refs[here] & 0xFFFFFFFF))
                yield _rows(query[here], [c.take(places) for c in columns], score[here], names)
        self.rows.clear()
        self.count = 0


def _rows(query: np.ndarray, columns: list[pa.Array], score: np.ndarray, names: list[str]):
    return pa.RecordBatch.from_arrays(
        [pa.array(query, pa.int64()), *columns, pa.array(score, pa.float64())], ["query_id", *names, "score"]
    )


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Every part and block of the task; a block is unpacked once for the parts that follow it."""
    parts: dict[int, tuple] = {}
    number, block = None, None
    for batch in batches:
        for b, documents, p, queries in zip(
            *(batch[name] for name in ("block", "documents", "part", "queries")), strict=True
        ):
            if b.as_py() != number:
                number, block = b.as_py(), _told(documents)
            if p.as_py() not in parts:
                parts[p.as_py()] = _told(queries)
            yield number, block, parts[p.as_py()]


def _best_of_cells(keys: Sequence[str], n: int, fold: bool):
    """Of each query, the documents that may be among its first ``n``, or the first rows of its first ``n`` titles."""
    tie = tuple(list(keys).index(name) for name in ("doc_id", "row_id"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = _Held(n, fold, tie), {}
        for number, block, queries in _cells(batches):
            if number not in blocks:
                if blocks:
                    held.leaves(len(blocks) - 1)
                if held.count > _ROWS_HELD:
                    yield from held.rows_out(list(keys))
                blocks[number] = len(blocks)
                held.reads(blocks[number], block[0])
            cell = _Cell(block, queries)
            for q, (name, n_terms) in enumerate(zip(queries[0].tolist(), queries[1].tolist())):
                held.offer(name, cell, q, n_terms, block[1], blocks[number] << 32)
        if blocks:
            held.leaves(len(blocks) - 1)
            yield from held.rows_out(list(keys))
        del held, blocks
        _give_back()

    return best


def _reached(cell: _Cell, q: int, n_terms: int, bound: float, titles: np.ndarray, fold: bool):
    """Documents and scores down to ``bound``; the first rows of titles alone, if titles are folded."""
    places, sums = cell.reaching(q, (bound - _MARGIN) * n_terms)
    scores = sums / n_terms
    if fold and len(places):
        chosen, _ = _by_title(scores, titles[places], places.astype(np.int64))
        places, scores = places[chosen], scores[chosen]
    return places, scores


def _stretch_of_cells(keys: Sequence[str], fold: bool):
    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, queries in _cells(batches):
            cell, found, waiting = _Cell(block, queries), [], 0

            def rows(found):
                places = pa.array(np.concatenate([f[1] for f in found]))
                query = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                columns = [column.take(places) for column in block[0]]
                return _rows(query, columns, np.concatenate([f[2] for f in found]), list(keys))

            for q, name in enumerate(queries[0].tolist()):
                places, scores = _reached(cell, q, int(queries[1][q]), queries[6][q], block[1], fold)
                if len(places):
                    found.append((name, places, scores))
                    waiting += len(places)
                if waiting >= _ROWS_OUT:
                    yield rows(found)
                    found, waiting = [], 0
            if found:
                yield rows(found)

    return stretch


def _cuts_of_cells(at: Sequence[float], fold: bool):
    """Of each query, how many documents of the block (titles, if folded) it has and the scores down to which some shares of them
    reach."""

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, queries in _cells(batches):
            cell, found = _Cell(block, queries), []
            for q, name in enumerate(queries[0].tolist()):
                _, scores = _reached(cell, q, int(queries[1][q]), -np.inf, block[1], fold)
                if len(scores):
                    falling = -np.sort(-scores)
                    places = [max(0, int(np.ceil(share * len(scores))) - 1) for share in at]
                    found.append((name, len(scores), falling[places].tolist()))
            if found:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("query_id", "n", "cuts"), map(list, zip(*found)))),
                    pa.schema([("query_id", pa.int64()), ("n", pa.int64()), ("cuts", pa.list_(pa.float64()))]),
                )

    return cuts


class Blocks:
    """The documents of ``matches`` in blocks, and the scores of queries over them.

    ``save`` writes a table and reads it back. With ``fold``, of documents with one title (but the empty one) the
    first of a query stands alone: the others are too close to it, whatever else is ranked. Titles are told
    apart by 64 bits among the candidates of one query."""

    def __init__(
        self,
        matches: DataFrame,
        terms: DataFrame,
        save: Callable[[str, DataFrame], DataFrame],
        ratio: str = "floor",
        keys: Sequence[str] = ("doc_id",),
        block_rows: int = BLOCK_ROWS,
        part_queries: int = PART_QUERIES,
        fold: bool = False,
    ):
        self.terms = terms.withColumn("gain", ratio_gain(F.col("n_docs"), F.col("cf"), ratio))
        self.save, self.keys, self.part_queries, self.fold = save, list(keys), part_queries, fold
        self.cores = matches.sparkSession.sparkContext.defaultParallelism
        self.rounds = 0
        titled = matches.where(F.col("title").isNotNull() & (F.size("matches") > 0))
        scalars = terms.select("avgdl").limit(1)
        code = F.xxhash64(F.when(F.col("title") == "", F.col("row_id")), "title")
        self.n_blocks = max(1, -(-titled.count() // block_rows))
        held = F.transform("matches", lambda m: F.struct(
            m["term"].alias("term"), *[
                part.alias(name) for name, part in
                zip(("slope", "rest"), dph_parts(m["tf"], F.col("dl"), F.col("avgdl")))
            ]
        ))
        rows = titled.crossJoin(F.broadcast(scalars)).coalesce(self.n_blocks).select(
            *self.keys, code.alias("title_code"), held.alias("held"), F.spark_partition_id().alias("block")
        )
        self.kinds = titled.select(*self.keys).dtypes
        self.documents = save("packed_documents", rows.mapInArrow(
            _pack_documents(self.keys, block_rows), "block long, documents binary"
        ))

    def _cells(self, terms: DataFrame) -> DataFrame:
        """Every block beside every part of the queries of ``terms(query_id, n_terms, term, gain, bound)``."""
        self.rounds += 1
        want = _TASKS_PER_CORE * self.cores
        n_queries = terms.select("query_id").distinct().count()
        n_parts = max(1, -(-n_queries // self.part_queries), min(want, -(-n_queries // _FEW_QUERIES)))
        rows = terms.select("query_id", "n_terms", "term", "gain", "bound").repartition(
            n_parts, "query_id"
        ).withColumn("part", F.spark_partition_id())
        queries = self.save(f"packed_queries_{self.rounds}", rows.mapInArrow(
            _pack_queries(self.part_queries), "part long, queries binary"
        ))
        # a task reads the blocks of one partition one after the other, for the part or parts of another
        spread = self.documents.coalesce(min(self.n_blocks, -(-want // n_parts)))
        return spread.hint("shuffle_replicate_nl").join(queries.repartitionByRange(n_parts, "part"))

    def _schema(self) -> str:
        return ", ".join(
            f"{name} {kind}" for name, kind in [("query_id", "long"), *self.kinds, ("score", "double")]
        )

    def best(self, n: int) -> DataFrame:
        """``document_scores`` (``query_id, *keys, score``) without rows that cannot be among the first ``n`` of their query;
        rows that reach the score of the ``n``-th stay, and so do some more. Folded, the ``n`` first titles count."""
        cells = self._cells(self.terms.withColumn("bound", F.lit(None).cast("double")))
        return cells.mapInArrow(_best_of_cells(self.keys, n, self.fold), self._schema())

    def _of(self, open_queries: DataFrame) -> DataFrame:
        return self._cells(self.terms.join(open_queries, "query_id"))

    def stretch(self, open_queries: DataFrame) -> DataFrame:
        """The scores of some queries down to the bound of their ``stretch``."""
        bound = F.get("bounds", F.col("stretch")).alias("bound")
        return self._of(open_queries.select("query_id", bound)).mapInArrow(
            _stretch_of_cells(self.keys, self.fold), self._schema()
        )

    def bounds(self, open_queries: DataFrame, size: int) -> DataFrame:
        """``stretch_bounds`` of some queries: documents are dealt to blocks whatever their scores, so the mean
        of the cuts of the blocks is about the cut of the whole."""
        unbounded = F.lit(float("-inf")).alias("bound")
        cuts = self._of(open_queries.select("query_id", unbounded)).mapInArrow(
            _cuts_of_cells(shares(), self.fold), "query_id long, n long, cuts array<double>"
        )
        n = F.sum("n")
        means = [F.sum(F.col("cuts")[i] * F.col("n")) / n for i in range(len(shares()))]
        return bounds_from_cuts(
            cuts.groupBy("query_id").agg(n.alias("n"), F.array(*means).alias("cuts")), size
        )


def best_in_blocks(
    matches: DataFrame,
    terms: DataFrame,
    save: Callable[[str, DataFrame], DataFrame],
    n: int,
    ratio: str = "floor",
    keys: Sequence[str] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
    part_queries: int = PART_QUERIES,
) -> DataFrame:
    """``Blocks.best`` of all queries, titles not folded."""
    return Blocks(matches, terms, save, ratio, keys, block_rows, part_queries).best(n)
