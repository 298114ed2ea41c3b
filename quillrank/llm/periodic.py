"""Stretches of words that repeat with a period: Lyndon arrays by the first phase of Baier's suffix sorter,
Lyndon roots extended into runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A run is reported from this many words and this many periods on.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start long, length long, period long>>"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def lyndon_array(items: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word from each position on, by grouping alone.

    A group holds suffixes that begin with the same Lyndon word, its context; the groups stand in the order of their
    contexts. At first the contexts are single items. The groups are taken from the greatest down. Of a
    suffix in the group at hand, the parent is the nearest position to the left in a lesser group; a parent
    with ``c`` children in the group continues with ``c`` copies of its context, so it moves to a new group right
    above its old one, for more copies further up. When a group's turn comes its context is
    final, and is the longest Lyndon word of its suffixes.
    """
    ranks = {item: rank for rank, item in enumerate(sorted(set(items)))}
    group = [ranks[item] for item in items]
    members: list[list[int]] = [[] for _ in ranks]
    for at, own in enumerate(group):
        members[own].append(at)
    length = [1] * len(ranks)
    below = list(range(-1, len(ranks) - 1))
    above = [*range(1, len(ranks)), -1]
    parent = [-1] * len(items)
    taken = bytearray(len(items))
    context = [1] * len(items)
    now = len(ranks) - 1
    while now >= 0:
        size = length[now]
        children: dict[int, int] = {}
        for at in members[now]:
            if group[at] != now:
                continue
            taken[at] = 1
            context[at] = size
            left = at - 1
            while left >= 0 and taken[left]:
                left = parent[left]
            parent[at] = left
            if left >= 0:
                children[left] = children.get(left, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for at, copies in children.items():
            moves.setdefault((copies, group[at]), []).append(at)
        for copies, old in sorted(moves, reverse=True):
            new, over = len(members), above[old]
            moved = moves[copies, old]
            members.append(moved)
            length.append(length[old] + copies * size)
            below.append(old)
            above.append(over)
            above[old] = new
            if over >= 0:
                below[over] = new
            for at in moved:
                group[at] = new
        now = below[now]
    return context


def common_length(items: list[int], a: int, b: int) -> int:
    """How many items agree from ``a`` and from ``b`` > ``a`` on (longest common extension): doubling steps, then halving
    ones, each one comparison of two slices."""
    total, step, n = 0, 1, len(items)
    while room := min(step, n - b - total):
        x, y = a + total, b + total
        if items[x:x + room] == items[y:y + room]:
            total += room
            step *= 2
            continue
        while room > 1:
            half = room // 2
            x, y = a + total, b + total
            if items[x:x + half] == items[y:y + half]:
                total += half
                room -= half
            else:
                room = half
        break
    return total


def find_runs(
    items: list[int], least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> list[Run]:
    """All maximal stretches with a smallest period, of at least ``least_length`` items and ``least_periods`` (2 or more)
    periods, by start, then period. Every run holds its Lyndon root, under the order of the items or under its
    reverse, as the longest Lyndon word of a position; so each such word is extended in both directions as long as
    the period holds. A word inside a run already found with its period is that run again."""
    n, found = len(items), set()
    backwards = items[::-1]
    for order in (items, [-item for item in items]):
        ends: dict[int, int] = {}
        for at, period in enumerate(lyndon_array(order)):
            if at + period <= ends.get(period, 0):
                continue
            right = common_length(items, at, at + period)
            left = common_length(backwards, n - at - period, n - at) if at else 0
            size = left + period + right
            if size >= 2 * period:
                ends[period] = at + period + right
                if size >= max(least_length, least_periods * period):
                    found.add((at - left, size, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _gram(least_length: int, least_periods: int) -> int:
    """The longest stretch of items that stands twice in a run wherever it is taken from it: a run of L items and
    period p holds L - g + 1 stretches of g, and each has another one a period off if those are 2 p."""
    return max(1, min(
        max(least_length, least_periods * period) + 1 - 2 * period
        for period in range(1, least_length + 1)
    ))


def possible_parts(
    items: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> list[tuple[int, int]]:
    """The stretches (begin, end) outside of which no run can stand: every few words of a run stand in the text a
    second time. Nothing is lost, as equal words have equal hashes, and each run lies in one part whole."""
    width = _gram(least_length, least_periods)
    if len(items) < least_length:
        return []
    n = len(items) - width + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ items[k:k + n].astype(np.uint64)) * _MIX
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    again = np.zeros(n + 2, dtype=np.int8)
    again[order[1:][same] + 1] = 1
    again[order[:-1][same] + 1] = 1
    turns = np.flatnonzero(np.diff(again))
    parts = zip(turns[::2].tolist(), (turns[1::2] + width - 1).tolist(), strict=True)
    return [(begin, end) for begin, end in parts if end - begin >= least_length]


def text_runs(words: list[bytes]) -> list[Run]:
    """The runs of a list of words."""
    numbers: dict[bytes, int] = {}
    items = [numbers.setdefault(word, len(numbers)) for word in words]
    return [
        (begin + start, length, period)
        for begin, end in possible_parts(np.array(items, dtype=np.int64))
        for start, length, period in find_runs(items[begin:end])
    ]


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words, joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period:start + length] = b"\x01" * (length - period)
    return b" ".join([word for word, gone in zip(words, dropped, strict=True) if not gone])


def periodic_runs(text: Column) -> Column:
    """``struct<runs, collapsed>`` of a text: the ``runs`` of its words, ``array<struct<start, length, period>>`` by start, then
    period, and what is left without the repeats.

    Words are separated by ASCII white space; a null, empty or blank text has no runs and collapses to empty text. Texts
    are read whole, one at a time, and nothing is kept between rows; a task's memory follows its longest
    text. A column function: rows, their other columns and repeats stay as they are, and nothing is
    exchanged."""

    @F.arrow_udf(f"struct<runs: {RUNS}, collapsed: string>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            runs, collapsed = [], []
            for text in texts.cast(pa.binary()):
                words = (text.as_py() or b"").split()
                found = text_runs(words)
                runs.append([
                    {"start": s, "length": n, "period": p} for s, n, p in found
                ])
                collapsed.append(collapse(words, found).decode())
            yield pa.StructArray.from_arrays(
                [pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.string())],
                fields=list(_FOUND),
            )

    return udf(text)


def strongest(runs: Column) -> Column:
    """The run with the most periods, compared exactly; ties by start, then period. Null where there is none."""

    def compare(a: Column, b: Column) -> Column:
        more = a["length"] * b["period"] - b["length"] * a["period"]
        return (
            F.when(more != 0, -F.signum(more))
            .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
            .otherwise(F.signum(a["period"] - b["period"]))
        ).cast("int")

    return F.get(F.array_sort(runs, compare), F.lit(0))
