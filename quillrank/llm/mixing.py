"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.shared import Scratch

SEED = 17
MAX_EPOCHS = 2.0        # a document is used at most this often, on average over its leaf
BUDGET_SHARE = 0.5      # target tokens as a share of all tokens
LEVELS = ["domain", "lang", "source"]
# Target weights by path; a path that is not named weighs 1 among its siblings.
WEIGHTS = {
    ("long",): 3.0, ("medium",): 2.0,
    ("long", "en"): 3.0, ("medium", "en"): 3.0, ("short", "en"): 3.0,
}
_HEX = 12               # hex digits of a document's place in an epoch
_STEP = 3               # hex digits looked at in one descent: 4,096 ranges
_NONE = "none"          # stands for a null level


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")).cast("long")


def length_domain(n_chars: Column) -> Column:
    """The top of the tree for a table without domains: how long its texts are."""
    return F.when(n_chars >= 5000, "long").when(n_chars >= 1000, "medium").otherwise("short")


def _level(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(_NONE))


def _weights_table(docs: DataFrame, weights: dict[tuple, float], depth: int) -> DataFrame:
    rows = [(*path, float(w)) for path, w in weights.items() if len(path) == depth]
    names = [f"{name} string" for name in LEVELS[:depth]]
    return docs.sparkSession.createDataFrame(rows, ", ".join([*names, "weight double"]))


def _pour(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Divide the ``budget`` of each parent among its children (one row each, with ``weight`` and
    ``capacity``) in proportion to weight; what a child cannot take goes to its siblings.

    Children are ordered by capacity per weight; those below the water level are filled, the
    others share what is left by weight. The level of a child, taken as the first that is not
    filled, is found from running sums, so there is no iteration.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    by_ratio = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), "name")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = nodes.withColumn("ratio", ratio).select(
        "*",
        F.coalesce(F.sum("capacity").over(before), F.lit(0.0)).alias("poured"),
        (F.sum("weight").over(Window.partitionBy(*parent))
         - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("thirsty"),
    ).withColumn(
        "level", F.when(F.col("thirsty") > 1e-12,
                        (F.col("budget") - F.col("poured")) / F.col("thirsty"))
    )
    open_level = F.min(
        F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "name", "level"))
    ).over(Window.partitionBy(*parent))
    share = F.when(F.col("weight") <= 0, F.lit(0.0)).when(
        open_level.isNull(), F.col("capacity")
    ).otherwise(F.least("capacity", open_level["level"] * F.col("weight")))
    return rows.withColumn("given", F.greatest(F.lit(0.0), share)).drop(
        "ratio", "poured", "thirsty", "level"
    )


def leaf_budgets(
    leaves: DataFrame,
    weights: dict[tuple, float] = WEIGHTS,
    budget: float | None = None,
    budget_share: float = BUDGET_SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``(domain, lang, source, tokens, full_epochs, rest)`` from ``leaves(domain, lang, source,
    tokens)``: how often a leaf is used whole, and how many tokens of the next epoch it is used for.

    A node can take what its leaves hold times ``max_epochs``. The budget is poured from the top:
    at every node it is shared among the children by weight, and the shortage of a child goes to
    its siblings as long as they have room. A parent never gets more than its children can take
    together, so a shortage leaves a family only when all siblings are full; then it has
    gone to the relatives one level up. Weights of zero get nothing. The tables here have one
    row per node of the tree.
    """
    tree = leaves.select(*LEVELS, F.col("tokens").cast("double").alias("tokens"))
    total = tree.agg(F.coalesce(F.sum("tokens"), F.lit(0.0)).alias("tokens"))
    wanted = F.lit(float(budget)) if budget is not None else F.col("tokens") * budget_share
    above = total.select(F.least(wanted, F.col("tokens") * max_epochs).alias("budget"))
    for depth in range(1, len(LEVELS) + 1):
        path, parent = LEVELS[:depth], LEVELS[:depth - 1]
        nodes = tree.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("capacity"))
        named = _weights_table(leaves, weights, depth)
        nodes = nodes.join(named, path, "left").select(
            *path, "capacity", F.coalesce("weight", F.lit(1.0)).alias("weight"),
            F.col(path[-1]).alias("name"),
        )
        nodes = nodes.join(above, parent) if parent else nodes.crossJoin(F.broadcast(above))
        above = _pour(nodes, parent or [F.lit(0)]).select(*path, F.col("given").alias("budget"))
    sized = tree.join(above, LEVELS)
    given = F.round("budget", 3)
    full = F.when(F.col("tokens") > 0, F.floor(given / F.col("tokens"))).otherwise(0).cast("long")
    return sized.select(*LEVELS, "tokens", "budget", full.alias("full_epochs")).select(
        *LEVELS, F.col("tokens").cast("long").alias("tokens"), "full_epochs",
        F.floor(given - F.col("full_epochs") * F.col("tokens")).cast("long").alias("rest"),
    )


def epoch_place(key: Column, epoch: Column, seed: int = SEED) -> Column:
    """Where a document stands in the seeded order of an epoch, as hex digits; documents with
    equal keys (null keys too) stand at one place."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), _level(key))
    return F.substring(F.md5(name.cast("binary")), 1, _HEX)


def _cutoffs(places: DataFrame, scratch: Scratch) -> DataFrame:
    """``(domain, lang, source, cutoff)`` from ``places(domain, lang, source, rest, place, tokens)``: the last place
    whose running token sum, in order of place, does not exceed ``rest``; null if there is none.

    Found like a number in a trie: sums per range of places (the first three hex digits),
    the range that the budget ends in, then the same inside it. A step leaves one range in 4,096
    of each leaf, however large the leaf is; what is sorted is at most 4,096 sums per leaf.
    """
    done = places.groupBy(*LEVELS).agg(
        F.first("rest").alias("rest"), F.lit("").alias("prefix"), F.lit(None).cast("string")
        .alias("cutoff"),
    )
    done = scratch.table("cutoff-0", done)
    for depth in range(_STEP, _HEX + 1, _STEP):
        inside = places.drop("rest").join(done, LEVELS).where(
            F.substring("place", 1, depth - _STEP) == F.col("prefix")
        )
        sums = inside.groupBy(
            *LEVELS, "rest", "cutoff", F.substring("place", 1, depth).alias("range")
        ).agg(F.sum("tokens").alias("tokens"), F.max("place").alias("last"))
        order = Window.partitionBy(*LEVELS).orderBy("range")
        sums = sums.withColumn("upto", F.sum("tokens").over(order))
        fits = F.col("upto") <= F.col("rest")
        step = sums.groupBy(*LEVELS, "rest").agg(
            F.max(F.when(fits, F.col("last"))).alias("fitted"),
            F.max(F.when(fits, F.col("upto"))).alias("used"),
            F.min(F.when(~fits, F.col("range"))).alias("prefix"),
            F.max("cutoff").alias("before"),
        ).select(
            *LEVELS, (F.col("rest") - F.coalesce("used", F.lit(0))).alias("rest"), "prefix",
            F.coalesce("fitted", "before").alias("cutoff"),
        )
        # a leaf whose budget ended with a range stays as it is in further steps
        ended = done.join(step.select(*LEVELS), LEVELS, "left_anti")
        done = scratch.table(f"cutoff-{depth}", step.unionByName(ended))
    return done.select(*LEVELS, "cutoff")


def with_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    levels: list[Column] | None = None,
    weights: dict[tuple, float] = WEIGHTS,
    budget: float | None = None,
    budget_share: float = BUDGET_SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``(row, domain, lang, source, n_tokens, copies)``: the columns of ``docs`` as a struct, the leaf
    of the row, its tokens, and how often it is taken.

    Every leaf of the tree (``levels``: domain, language, source; by default length band, ``lang``,
    ``source``) is used for ``full_epochs`` whole epochs and for a prefix of the next one: the
    documents at the front of that epoch's seeded order as long as their tokens fit into the
    rest of the leaf's budget (the first that does not fit ends the prefix). A null level is a
    level of its own ("none"); null and empty texts have no tokens and cost nothing; rows with
    equal keys stand at one place and are taken together; an empty table gives an empty one.
    Texts are read, not moved: what is exchanged is one row per leaf and range of the order.
    """
    scratch = Scratch(docs.sparkSession)
    if levels is None:
        levels = [length_domain(F.col("n_chars")), F.col("lang"), F.col("source")]
    row = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("key"), n_tokens(F.col(text)).alias("n_tokens"),
        *[_level(level).alias(name) for level, name in zip(levels, LEVELS, strict=True)],
    )
    narrow = scratch.table("sized", row.select(*LEVELS, "key", "n_tokens"))
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = scratch.table(
        "budgets", leaf_budgets(leaves, weights, budget, budget_share, max_epochs)
    )
    place = epoch_place(F.col("key"), F.col("full_epochs"), seed)
    places = narrow.join(budgets.select(*LEVELS, "full_epochs", "rest"), LEVELS).select(
        *LEVELS, "rest", place.alias("place"), F.col("n_tokens").alias("tokens")
    )
    plan = budgets.select(*LEVELS, "full_epochs").join(_cutoffs(places, scratch), LEVELS)
    chosen = row.join(plan, LEVELS)
    more = F.coalesce(place <= F.col("cutoff"), F.lit(False)).cast("long")
    return chosen.select("row", *LEVELS, "n_tokens", (F.col("full_epochs") + more).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``with_copies`` takes it."""
    taken = with_copies(docs, **options).where("copies > 0")
    repeated = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")
