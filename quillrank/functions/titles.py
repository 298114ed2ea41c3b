"""How unlike two titles are."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrank.schema import MIN_TITLE_DISTANCE

# Functions of this module travel with the tasks, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG_TITLE = 256   # two longer titles are compared faster by ``within_edits`` than by ``levenshtein``
_PAIRS = 1 << 13   # pairs that are compared side by side
_WORDS = 16        # longer titles, in words of 64 letters, are compared pair by pair


def title_distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer length: 0 for equal titles, 1 for nothing in common.

    Two empty titles have no distance (null), so they never count as copies.
    """
    longer = F.greatest(F.length(a), F.length(b))
    return F.levenshtein(a, b) / F.nullif(longer, F.lit(0))


def _most_edits(longer: Column, min_distance: float) -> Column:
    """The largest number of edits whose share of ``longer`` is below ``min_distance``, by the
    same division that the distance makes."""
    bound = F.ceil(longer * F.lit(min_distance)).cast("int")
    return (
        F.when(bound / longer < min_distance, bound)
        .when((bound - 1) / longer < min_distance, bound - 1)
        .otherwise(bound - 2)
    )


def most_edits(a: Column, b: Column, min_distance: float = MIN_TITLE_DISTANCE) -> Column:
    """With how many edits between them two titles are still near."""
    return _most_edits(F.greatest(F.length(a), F.length(b)), float(min_distance))


def lengths_allow(a: Column, b: Column, min_distance: float = MIN_TITLE_DISTANCE) -> Column:
    """Necessary for two titles to be near: the difference in length, which is the least edit distance
    that it allows."""
    longer = F.greatest(F.length(a), F.length(b))
    return (longer > 0) & (F.abs(F.length(a) - F.length(b)) / longer < float(min_distance))


def edits_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``. A column of the usual table is one number of many
    bits that say where it rises and falls (Myers, JACM 46(3), 1999), so a column costs a few operations on
    numbers; the walk ends where the columns left cannot bring the distance down far enough."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a) <= most
    at: dict[str, int] = {}
    for char in set(b):
        at[char] = int("".join("1" if c == char else "0" for c in reversed(a)), 2) if char in a else 0
    size, left = len(a), len(b)
    every, last, up, down, distance = (1 << size) - 1, 1 << (size - 1), (1 << size) - 1, 0, size
    for char in b:
        equal = at[char]
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rises, falls = down | (every & ~(across | up)), up & across
        if rises & last:
            distance += 1
        elif falls & last:
            distance -= 1
        left -= 1
        if distance - left > most:
            return False
        rises = (rises << 1 | 1) & every
        up = (falls << 1 & every) | (every & ~(vertical | rises))
        down = rises & vertical
    return distance <= most


def within_edits(a: Column, b: Column, most: Column) -> Column:
    """``edits_within`` of two columns; null where one is null."""

    @F.pandas_udf("boolean")
    def udf(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]
    ) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([
                edits_within(x, y, int(n)) if isinstance(x, str) and isinstance(y, str) else None
                for x, y, n in zip(*columns, strict=True)
            ], dtype=object)

    return udf(a, b, most)


def near_title(a: Column, b: Column, min_distance: float = MIN_TITLE_DISTANCE) -> Column:
    """True when ``title_distance(a, b) < min_distance``.

    The edit distance is at least the difference in length, so titles of very different
    length are settled without it, and the rest is computed once and only up to the largest
    distance that is still near (the bounded form answers -1 beyond that).
    """
    if min_distance <= 0:
        return F.lit(False)
    min_distance = float(min_distance)
    longer = F.greatest(F.length(a), F.length(b))
    gap = F.abs(F.length(a) - F.length(b))
    return (
        F.when(longer == 0, F.lit(False))
        .when(gap / longer >= min_distance, F.lit(False))
        .when(a == b, F.lit(True))
        .otherwise(F.call_function("levenshtein", a, b, _most_edits(longer, min_distance)) >= 0)
    )


def _edits(codes: np.ndarray, a: tuple, b: tuple, words: int) -> np.ndarray:
    """Edit distances of pairs, side by side: ``edits_within`` without its end, on numbers of 64 bits that hand
    a rise or fall at their end to the next. ``a`` and ``b`` are where titles begin in ``codes`` and their lengths (above 0),
    those of ``b`` falling; no ``a`` has more letters than ``words`` such numbers."""
    (a_at, a_len), (b_at, b_len) = a, b
    one, top = np.uint64(1), np.uint64(63)
    size = 64 * words
    pattern = np.zeros((len(a_len), size), codes.dtype)
    for i, (at, length) in enumerate(zip(a_at.tolist(), a_len.tolist())):
        pattern[i, :length] = codes[at:at + length]
    up = [np.full(len(a_len), ~np.uint64(0)) for _ in range(words)]
    down = [np.zeros(len(a_len), np.uint64) for _ in range(words)]
    distance = a_len.astype(np.int64)
    last, bit = (a_len - 1) // 64, ((a_len - 1) % 64).astype(np.uint64)
    for j in range(int(b_len[0])):
        n = int(np.searchsorted(-b_len, -j))   # pairs with a letter there stand first
        char = codes[b_at[:n] + j]
        equals = np.packbits(pattern[:n] == char[:, None], axis=1, bitorder="little").view("<u8")
        rise, fall = np.ones(n, np.uint64), np.zeros(n, np.uint64)
        for w in range(words):
            u, d, equal = up[w][:n], down[w][:n], equals[:, w]
            vertical = equal | d
            equal = equal | fall
            across = (((equal & u) + u) ^ u) | equal
            rises, falls = d | ~(across | u), u & across
            ends = (rises >> bit[:n] & one).astype(np.int64) - (falls >> bit[:n] & one).astype(np.int64)
            distance[:n] += np.where(last[:n] == w, ends, 0)
            next_rise, next_fall = rises >> top, falls >> top
            rises, falls = rises << one | rise, falls << one | fall
            up[w][:n] = falls | ~(vertical | rises)
            down[w][:n] = rises & vertical
            rise, fall = next_rise, next_fall
    return distance


class _Titles:
    """Titles by number, each told once, to be compared side by side."""

    def __init__(self):
        self.at: dict[str, int] = {}

    def number(self, title: str) -> int:
        return self.at.setdefault(title, len(self.at))

    def told(self) -> None:
        """All titles are numbered; none comes later."""
        self.titles = list(self.at)
        self.lengths = np.array([len(title) for title in self.titles], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        text = np.frombuffer("".join(self.titles).encode("utf-32-le", "surrogatepass"), "<u4")
        known = np.bincount(text) > 0
        codes = np.cumsum(known)
        self.codes = codes.astype(np.uint8 if known.sum() < 255 else np.uint32)[text]

    def near(self, left: Sequence[int], right: Sequence[int], min_distance: float) -> np.ndarray:
        """``near_title`` of pairs. They come more than once where documents share a title; each is compared once."""
        if not len(left):
            return np.zeros(0, bool)
        size = len(self.titles)
        pairs, back = np.unique(np.array(left, np.int64) * size + np.array(right, np.int64), return_inverse=True)
        return self._near(pairs // size, pairs % size, min_distance)[back]

    def _near(self, left: np.ndarray, right: np.ndarray, min_distance: float) -> np.ndarray:
        swap = self.lengths[left] < self.lengths[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        longer, shorter = self.lengths[left], self.lengths[right]
        some = np.maximum(longer, 1)
        most = np.ceil(longer * float(min_distance))
        most = np.where(
            most / some < min_distance, most, np.where((most - 1) / some < min_distance, most - 1, most - 2)
        )
        near = (longer > 0) & ((longer - shorter) / some < min_distance)
        open_pairs = np.flatnonzero(near & (left != right))
        words = -(-longer[open_pairs] // 64)
        near[open_pairs] = longer[open_pairs] <= most[open_pairs]   # all that is left where the shorter one is empty
        for n in np.unique(words).tolist():
            pairs = open_pairs[(words == n) & (shorter[open_pairs] > 0)]
            if n > _WORDS:
                for i in pairs.tolist():
                    near[i] = edits_within(self.titles[left[i]], self.titles[right[i]], int(most[i]))
                continue
            pairs = pairs[np.argsort(-shorter[pairs], kind="stable")]
            for at in range(0, len(pairs), _PAIRS):
                chunk = pairs[at:at + _PAIRS]
                a, b = left[chunk], right[chunk]
                found = _edits(
                    self.codes, (self.starts[a], self.lengths[a]), (self.starts[b], self.lengths[b]), n
                )
                near[chunk] = found <= most[chunk]
        return near


def near_pairs(pairs: Sequence[tuple[str, str]], min_distance: float = MIN_TITLE_DISTANCE) -> np.ndarray:
    """``near_title`` of pairs of titles, side by side."""
    numbers = _Titles()
    left, right = ([numbers.number(pair[i]) for pair in pairs] for i in (0, 1))
    numbers.told()
    return numbers.near(left, right, min_distance)


def near_any_of(titles: Sequence[str | None], others: Sequence, min_distance: float) -> np.ndarray:
    """Whether a title is near one of the others beside it; a missing one is."""
    numbers, left, right, row = _Titles(), [], [], []
    for i, (title, beside) in enumerate(zip(titles, others, strict=True)):
        if title is not None:
            for other in beside:
                row.append(i)
                left.append(numbers.number(title))
                right.append(numbers.number(other))
    numbers.told()
    near = np.array([title is None for title in titles], bool)
    near[np.array(row, np.int64)[numbers.near(left, right, min_distance)]] = True
    return near


def walk_titles(ranked: Sequence, kept: Sequence, k: int, min_distance: float) -> list[list[int]]:
    """Of each query, the places of ``ranked`` titles that are kept: those near none that were kept before, until there are ``k``."""
    numbers = _Titles()
    items = [[None if t is None else numbers.number(t) for t in titles] for titles in ranked]
    before = [[numbers.number(t) for t in titles] for titles in kept]
    numbers.told()
    chosen: list[list[int]] = [[] for _ in items]
    place, going = 0, list(range(len(items)))
    while going:
        going = [q for q in going if place < len(items[q]) and len(before[q]) < k]
        asked = [q for q in going if items[q][place] is not None]
        left = [items[q][place] for q in asked for _ in before[q]]
        right = [other for q in asked for other in before[q]]
        near = numbers.near(left, right, min_distance)
        sizes = [len(before[q]) for q in asked]
        ends = np.cumsum([0, *sizes])
        hits = np.concatenate([[0], np.cumsum(near)])
        for q, close in zip(asked, hits[ends[1:]] > hits[ends[:-1]], strict=True):
            if not close:
                chosen[q].append(place)
                before[q].append(items[q][place])
        place += 1
    return chosen


def near_any(title: Column, others: Column, min_distance: float = MIN_TITLE_DISTANCE) -> Column:
    """Whether a title is near one of an array of others, for many rows."""

    @F.pandas_udf("boolean")
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for titles, beside in batches:
            yield pd.Series(near_any_of(titles.tolist(), beside.tolist(), min_distance))

    return udf(title, others)


def walked(ranked: Column, kept: Column, k: int, min_distance: float = MIN_TITLE_DISTANCE) -> Column:
    """``walk_titles`` of two arrays of titles, for many rows."""

    @F.pandas_udf("array<int>")
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for titles, before in batches:
            chosen = walk_titles(titles.tolist(), before.tolist(), k, min_distance)
            yield pd.Series([np.array(places, np.int32) for places in chosen], dtype=object)

    return udf(ranked, kept)
