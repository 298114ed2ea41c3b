"""Small helpers to hand Catalyst an expression as SQL text.

A rule table of a hundred branches is one parse this way, instead of a thousand calls from
Python into the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def is_one_of(expression: str, values: Iterable[str]) -> str:
    """Membership in a fixed set: a hash lookup once Catalyst has seen it."""
    return f"{expression} IN ({', '.join(literal(value) for value in values)})"


def map_items(items: Column, body: str) -> Column:
    """``transform`` with the lambda given as text over ``x``."""
    return F.call_function("transform", items, F.expr(f"x -> {body}"))


def keep_items(items: Column, condition: str) -> Column:
    """``filter`` with the lambda given as text over ``x``."""
    return F.call_function("filter", items, F.expr(f"x -> {condition}"))
