"""Repair of conversations: the cheapest edits that make the roles alternate, by Knuth's agenda."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What an edit costs. A truncated row that stays costs TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# The state is what the roles so far end with: nothing, system, user or assistant.
_NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_STATES = ("", "s", "u", "a")
_WHOLE = ("", "a")
_SPOKEN = {"u": "user", "a": "assistant"}
_SPAN = 64  # steps that are taken together before their weights are joined with others'

Weight = tuple[int, str]  # cost, audit
Step = dict[str, list[tuple[str, Weight]]]  # from a state to others


def _gap() -> Step:
    """Between two rows: nothing, or one or two inserted turns. A third would lead back."""
    step: Step = {state: [(state, (0, ""))] for state in _STATES}
    for state in _STATES:
        for first in "ua":
            if one := _NEXT.get((state, first)):
                step[state].append((one, (INSERT, "I")))
                second = "a" if first == "u" else "u"
                step[state].append((_NEXT[one, second], (2 * INSERT, "II")))
    return step


_GAP = _gap()


def _row(initial: str, fault: str) -> Step:
    """One row: deleted, or kept or given another role where its fault (``b``lank, ``d``uplicate,
    ``t``runcated or none) allows it."""
    step: Step = {state: [(state, (DELETE, "D"))] for state in _STATES}
    if fault in ("b", "d"):
        return step
    extra = TRUNCATED if fault == "t" else 0
    for (state, read), after in _NEXT.items():
        if read == initial:
            step[state].append((after, (KEEP + extra, "K")))
        elif read in _SPOKEN:
            step[state].append((after, (REROLE + extra, "R")))
    return step


def lightest(steps: list[Step], start: str, goals: tuple[str, ...] = ()) -> dict[str, Weight]:
    """The lightest weight of every state after all steps, from ``start``; with ``goals``, of the first of
    them to be final.

    An item is (steps taken, state). The deduction from an item and a way of the next step to an item
    further on adds the costs and joins the audits. Its result is never below the item it comes from, and
    grows with it (equal costs at one item mean that neither audit begins with the other), so
    the function is superior, and what leaves the agenda is final.
    """
    final: dict[tuple[int, str], Weight] = {}
    agenda: list[tuple[int, str, int, str]] = [(0, "", 0, start)]
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = cost, audit
        if at == len(steps):
            if state in goals:
                break
            continue
        for after, (more, letters) in steps[at].get(state, ()):
            if (at + 1, after) not in final:
                heapq.heappush(agenda, (cost + more, audit + letters, at + 1, after))
    return {state: weight for (at, state), weight in final.items() if at == len(steps)}


def cheapest_edits(initials: str, faults: str) -> Weight:
    """Cost and audit of the lightest repair. Long conversations are taken in spans: the lightest ways
    through a span, from each state to each, are one step of the whole."""
    steps = [_GAP]
    for initial, fault in zip(initials, faults, strict=True):
        steps += [_row(initial, fault.strip()), _GAP]
    while len(steps) > _SPAN:
        spans = [steps[at:at + _SPAN] for at in range(0, len(steps), _SPAN)]
        steps = [
            {state: list(lightest(span, state).items()) for state in _STATES} for span in spans
        ]
    ends = lightest(steps, "", _WHOLE)
    return min(ends[state] for state in _WHOLE if state in ends)


def edited_rows(initials: str, audit: str) -> list[dict]:
    """The rows an audit leaves: ``row`` is the place of the row it comes from (-1: inserted), ``role`` the
    role it gets (null: its own)."""
    state, at, out = "", 0, []
    for edit in audit:
        if edit == "K":
            state = _NEXT[state, initials[at]]
            out.append({"row": at, "role": None})
        elif edit != "D":
            state = next(_NEXT[state, x] for x in "ua" if (state, x) in _NEXT)
            out.append({"row": at if edit == "R" else -1, "role": _SPOKEN[state]})
        at += edit != "I"
    return out


_EDITS = "cost long, audit string, edited array<struct<row int, role string>>"


def edits(initials: Column, faults: Column) -> Column:
    """``struct<cost, audit, edited>`` of the lightest repair, one character per row in either column."""

    @F.pandas_udf(_EDITS)
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for roles, marks in batches:
            rows = []
            for initial, fault in zip(roles, marks, strict=True):
                cost, audit = cheapest_edits(initial, fault)
                rows.append((cost, audit, edited_rows(initial, audit)))
            yield pd.DataFrame(rows, columns=["cost", "audit", "edited"])

    return udf(initials, faults)


def with_faults(messages: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ``fault`` to ``messages(<key>, role, text, ...)``: the first that holds of ``b`` (no character but white
    space), ``d`` (role and text stand earlier in the conversation) and ``t`` (the last character that is not white
    space ends no sentence); a blank where none does."""
    same = Window.partitionBy(key, "role", "text").orderBy(*order)
    return messages.withColumn(
        "fault",
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "b")
        .when(F.row_number().over(same) > 1, "d")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t")
        .otherwise(" "),
    )


def repair(
    messages: DataFrame, key: str = "conv_id", turn: str = "turn", copy: Column | None = None
) -> DataFrame:
    """``(<key>, rows, initials, faults, cost, audit, repaired)``, one row per conversation of
    ``messages(<key>, turn, role, text)``.

    ``rows`` are the turns by number (null first; ties by role, text, then ``copy``) as ``struct<turn, role, text,
    fault>``; a null role or text is one space. ``audit`` has one letter per edit, K, R, D or I, of the cheapest
    way to the roles ``(s?(ua)+)?``, the ASCII-least where several are cheapest; ``repaired`` is what it leaves, ``array<struct<role,
    text>>``. An empty role has no initial and is deleted or given a role; roles are told by their first
    character. Repeated rows are duplicates, null keys one conversation, an empty table gives no rows; other
    columns are not read.

    Rows are exchanged once, by conversation. A conversation is one row of the result, so it is gathered in one place and its task's
    memory follows its length, however long; the agenda itself works through it span by span.
    """
    plain = messages.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(0) if copy is None else copy).alias("copy"),
    )
    marked = with_faults(plain.repartition("key"), "key", ["turn", "copy"])
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "copy", "fault")))
    gathered = marked.groupBy("key").agg(rows.alias("rows"))
    first = F.transform("rows", lambda r: F.rpad(F.left(r["role"], F.lit(1)), 1, "-"))
    told = gathered.select(
        "key",
        "rows",
        F.array_join(first, "").alias("initials"),
        F.array_join(F.transform("rows", lambda r: r["fault"]), "").alias("faults"),
    )
    edited = told.withColumn("edits", edits(F.col("initials"), F.col("faults")))
    source = lambda e: F.get(F.col("rows"), e["row"])
    repaired = F.transform("edits.edited", lambda e: F.struct(
        F.coalesce(e["role"], source(e)["role"]).alias("role"),
        F.when(e["row"] >= 0, source(e)["text"]).otherwise("").alias("text"),
    ))
    return edited.select(
        F.col("key").alias(key), "rows", "initials", "faults", "edits.cost", "edits.audit",
        repaired.alias("repaired"),
    )
