"""Connected components of a link table by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.shared import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` (long ids): nodes that can be reached
    from each other share ``root``, a number without further meaning.

    Each round renames all nodes by a hash that is one-to-one on 64-bit numbers, lets every
    node step to the smallest name among its neighbours and itself, and keeps the links
    between what remains. The renaming makes the order random anew, so a chain of any length
    shrinks by a constant share each round instead of by one step: rounds grow with the
    logarithm of the longest chain. The minimum is a partial aggregate and the joins are plain
    equi-joins with one row per key on the small side, so a node with very many links is
    pre-aggregated or split by adaptive execution. Each round is written to the shared folder.
    """
    alive = scratch.table("links-0", links.where("a <> b").select("a", "b"))
    both = alive.select("a").union(alive.select("b")).distinct()
    names = both.select(F.col("a").alias("node"), F.col("a").alias("root"))
    turn = 0
    while not alive.isEmpty():
        turn += 1
        renamed = alive.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
        ends = renamed.union(renamed.select("b", "a"))
        step = scratch.table(
            f"step-{turn}",
            ends.groupBy("a").agg(F.min("b").alias("least"))
            .select(F.col("a").alias("name"), F.least("a", "least").alias("next")),
        )
        a_step = step.select(F.col("name").alias("a"), F.col("next").alias("a_next"))
        b_step = step.select(F.col("name").alias("b"), F.col("next").alias("b_next"))
        moved = renamed.join(a_step, "a").join(b_step, "b").where("a_next <> b_next")
        alive = scratch.table(
            f"links-{turn}",
            moved.select(
                F.least("a_next", "b_next").alias("a"), F.greatest("a_next", "b_next").alias("b")
            ).distinct(),
        )
        names = scratch.table(
            f"names-{turn}",
            names.select("node", F.xxhash64("root").alias("name"))
            .join(step, "name", "left")
            .select("node", F.coalesce("next", "name").alias("root")),
        )
    return names
