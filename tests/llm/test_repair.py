from __future__ import annotations

import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from quillrank.llm import repair

WHOLE = r"(s?(ua)+)?"


def cheapest_by_search(initials, faults):
    """All edit sequences by cost, then audit, until one gives the wanted roles."""
    agenda, seen = [(0, "", 0, "")], set()
    while agenda:
        cost, audit, at, roles = heapq.heappop(agenda)
        if at == len(initials) and re.fullmatch(WHOLE, roles):
            return cost, audit
        if (audit, at, roles) in seen or len(roles) > len(initials) + 3:
            continue
        seen.add((audit, at, roles))
        if not re.fullmatch("s?(ua)*u?", roles):
            continue
        for x in "ua":
            heapq.heappush(agenda, (cost + 3, audit + "I", at, roles + x))
        if at < len(initials):
            heapq.heappush(agenda, (cost + 4, audit + "D", at + 1, roles))
            if faults[at] not in "bd":
                more = cost + 3 * (faults[at] == "t")
                heapq.heappush(agenda, (more, audit + "K", at + 1, roles + initials[at]))
                for x in "ua":
                    heapq.heappush(agenda, (more + 3, audit + "R", at + 1, roles + x))
    raise AssertionError


def test_agenda_equals_exhaustive_search():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randint(0, 6)
        initials = "".join(rng.choice("suaux-") for _ in range(n))
        faults = "".join(rng.choice("  bdt") for _ in range(n))
        assert repair.cheapest_edits(initials, faults) == cheapest_by_search(initials, faults)


@pytest.mark.parametrize("span", [3, 5, 64])
def test_spans_change_nothing(monkeypatch, span):
    rng = random.Random(6)
    cases = [
        ("".join(rng.choice("sua") for _ in range(n)), "".join(rng.choice("   bt") for _ in range(n)))
        for n in (40, 90, 150)
    ]
    monkeypatch.setattr(repair, "_SPAN", 10**9)
    whole = [repair.cheapest_edits(*case) for case in cases]
    monkeypatch.setattr(repair, "_SPAN", span)
    assert [repair.cheapest_edits(*case) for case in cases] == whole


def test_edited_rows_have_the_wanted_roles():
    rng = random.Random(7)
    for _ in range(300):
        initials = "".join(rng.choice("suat") for _ in range(rng.randint(0, 12)))
        cost, audit = repair.cheapest_edits(initials, " " * len(initials))
        rows = repair.edited_rows(initials, audit)
        roles = "".join((row["role"] or initials[row["row"]])[0] for row in rows)
        assert re.fullmatch(WHOLE, roles)
        assert len(audit.replace("I", "")) == len(initials)
        assert cost == 3 * audit.count("R") + 4 * audit.count("D") + 3 * audit.count("I")


MESSAGES = "conv_id long, turn long, role string, text string"


def test_faults_order_and_repair(spark):
    rows = [
        (1, 2, "assistant", "Fine."), (1, 0, "user", "How are you?"), (1, 1, "user", " \t"),
        (1, 3, "assistant", "Fine."), (1, 4, "user", "cut of"), (1, None, "system", "Be kind."),
        (2, 0, "assistant", "Alone!"),
        (3, 0, None, None), (3, 0, "", "x."), (3, None, None, "y."),
        (None, 0, "user", "a."), (None, 1, "assistant", "b?"), (None, 1, "assistant", "b?"),
    ]
    frame = spark.createDataFrame(rows, MESSAGES).selectExpr(
        "*", "1 as key", "2 as copy", "3 as fault", "4 as rows", "5 as edits", "6 as cost"
    )
    got = {r.conv_id: r for r in repair.repair(frame).collect()}
    assert set(got) == {1, 2, 3, None}
    assert (got[1].initials, got[1].faults) == ("suuaau", "  b dt")
    assert (got[1].cost, got[1].audit) == (12, "KKDKDD")
    assert [tuple(r) for r in got[1].repaired] == [
        ("system", "Be kind."), ("user", "How are you?"), ("assistant", "Fine.")
    ]
    assert (got[2].cost, got[2].audit) == (3, "IK")
    assert [tuple(r) for r in got[2].repaired] == [("user", ""), ("assistant", "Alone!")]
    assert got[3].initials == " - " and got[3].faults == "  b"
    assert (got[3].cost, got[3].audit) == repair.cheapest_edits(" - ", "  b")
    assert (got[None].audit, got[None].faults) == ("KKD", "  d")
    assert repair.repair(frame.where("false")).count() == 0


def test_long_conversation_and_long_text(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", f"turn {i}.") for i in range(2000)]
    rows.append((8, 0, "user", "word " * 100_000 + "."))
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, MESSAGES)).collect()}
    initials = "".join("u" if i % 3 else "a" for i in range(2000))
    assert (got[7].cost, got[7].audit) == repair.cheapest_edits(initials, " " * 2000)
    assert got[8].audit == "KI" and len(got[8].repaired[0].text) == 500_001


def test_one_exchange(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x.")], MESSAGES)
    plan = repair.repair(frame, copy=F.lit(0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
