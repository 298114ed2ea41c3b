"""Greedy removal of near-copies: walk a query's documents from the best score down and keep
one unless its title is too close to the title of one already kept; stop at ``k`` kept.

A document's fate depends only on better-ranked *kept* documents. So the walk can be cut
anywhere: fold a bounded window of top rows, and if a query is still short, drop in parallel
everything that is too close to what it has kept, and fold the next window of what is left.
A further round keeps at least one more document per open query (its best survivor is close
to nothing kept) or finds that nothing is left, so the rounds are few and no group larger
than the window meets in one task, however many copies a title has.

The further rounds look at a stretch of the ranking that grows eightfold, down to a score
that a quantile sketch gives, so that the work follows how deep the walk really has to go.
Nothing is capped: a query is closed only when it has ``k`` documents or no candidate is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.titles import (
    LONG_TITLE,
    lengths_allow,
    most_edits,
    near_any,
    near_title,
    walked,
    within_edits,
)
from quillrank.operators.ranking import PARTS, SCORE_DIGITS, part_of, top_ranked
from quillrank.schema import MIN_TITLE_DISTANCE, TOP_K

ITEM = "struct<row_id:bigint,doc_id:string,score:double,title:string>"
TIE_BREAK = ("doc_id", "row_id")
WINDOW = 200

# The stretches of the ranking that further rounds look at, as shares of the candidates; a
# stretch is passed over while it holds less than a few windows. The last is everything.
_SHARES = (1 / 4096, 1 / 512, 1 / 64, 1 / 8)
_MIN_WINDOWS = 4
_TASKS_PER_CORE = 8   # where a task's work follows the square of some lengths, not its rows


def _walk(ranked: Column, kept: Column, k: int, min_distance: float) -> Column:
    def step(acc: Column, item: Column) -> Column:
        close = _close_to_any(acc, item["title"], min_distance)
        return F.when((F.size(acc) < k) & ~close, F.concat(acc, F.array(item))).otherwise(acc)

    return F.aggregate(ranked, kept, step)


def _close_to_any(kept: Column, title: Column, min_distance: float) -> Column:
    """Equal titles settle it before any edit distance is computed."""
    if min_distance <= 0:
        return F.lit(False)
    equal = F.exists(kept, lambda d: (d["title"] == title) & (title != ""))
    return equal | F.exists(kept, lambda d: near_title(d["title"], title, min_distance))


def _titles(items: Column) -> Column:
    return F.transform(items, lambda item: item["title"])


def fold_window(
    window: DataFrame,
    kept: DataFrame | None = None,
    k: int = TOP_K,
    min_distance: float = MIN_TITLE_DISTANCE,
    many: bool = False,
) -> DataFrame:
    """``(query_id, kept, seen)`` from ranked rows ``(query_id, rank, row_id, doc_id, score,
    title)``, a bounded number per query (``seen``), continuing from ``kept`` where given. The walks of
    ``many`` queries go side by side in numpy, with the same answer."""
    item = F.struct("row_id", "doc_id", "score", "title").cast(ITEM)
    # Few bytes but much work per query: the fixed number keeps adaptive execution from
    # folding all queries in one task because their rows are small.
    tasks = window.sparkSession.sparkContext.defaultParallelism
    ranked = window.repartition(tasks, "query_id").groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", item.alias("item")))).alias("ranked")
    )
    ranked = ranked.select(
        "query_id", F.transform("ranked", lambda r: r["item"]).alias("ranked")
    )
    none_yet = F.array().cast(f"array<{ITEM}>")
    if kept is None:
        state = ranked.withColumn("before", none_yet)
    else:
        state = kept.select("query_id", F.col("kept").alias("before")).join(
            ranked, "query_id", "left"
        )
    ranked_rows = F.coalesce(F.col("ranked"), none_yet)
    if many and min_distance > 0:
        chosen = walked(_titles(ranked_rows), _titles(F.col("before")), k, min_distance)
        return state.withColumn("chosen", chosen).select(
            "query_id",
            F.concat("before", F.transform("chosen", lambda i: F.get(ranked_rows, i))).alias("kept"),
            F.size(ranked_rows).alias("seen"),
        )
    return state.select(
        "query_id",
        _walk(ranked_rows, F.col("before"), k, min_distance).alias("kept"),
        F.size(ranked_rows).alias("seen"),
    )


def ruled_out(
    candidates: DataFrame, kept: DataFrame, min_distance: float = MIN_TITLE_DISTANCE
) -> DataFrame:
    """``candidates(query_id, doc_id, title)`` beside every other result of their query in ``kept(query_id,
    kept_doc_id, kept_title)``, a bounded number, whose title is too close to theirs.

    The kept titles go to the candidates, so that a query is not one task. Few bytes but much work, as in
    ``fold_window``: the number of tasks is fixed. Two long titles are compared by ``within_edits``."""
    if min_distance <= 0:
        return candidates.join(F.broadcast(kept), "query_id").where(F.lit(False))
    tasks = _TASKS_PER_CORE * candidates.sparkSession.sparkContext.defaultParallelism
    a, b = F.col("title"), F.col("kept_title")
    pairs = candidates.repartition(tasks, "query_id", "doc_id").join(
        F.broadcast(kept), "query_id"
    ).where((F.col("doc_id") != F.col("kept_doc_id")) & lengths_allow(a, b, min_distance))
    long = (F.least(F.length(a), F.length(b)) > LONG_TITLE) & (a != b)
    near_long = within_edits(
        F.when(long, a), F.when(long, b), F.when(long, most_edits(a, b, min_distance))
    )
    return pairs.withColumn("near_long", near_long).where(
        F.when(long, F.col("near_long")).otherwise(near_title(a, b, min_distance))
    ).drop("near_long")


def stretch_bounds(scores: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(query_id, bounds)``: the scores down to which further rounds look, one after the
    other, ending with minus infinity. Sketches only: a bound that is a little off makes a
    stretch longer or shorter, not wrong."""
    above = [1.0 - share for share in _SHARES]
    return bounds_from_cuts(scores.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("score", above).alias("cuts")
    ), size)


def shares() -> tuple[float, ...]:
    """The shares of its candidates that the stretches of a query but the last one hold."""
    return _SHARES


def bounds_from_cuts(sketch: DataFrame, size: int = WINDOW) -> DataFrame:
    """``stretch_bounds`` from ``(query_id, n, cuts)``: how many candidates a query has, and down to which score
    each of ``shares`` reaches."""
    long_enough = F.filter(
        F.arrays_zip(F.array(*[F.lit(share) for share in _SHARES]).alias("share"), "cuts"),
        lambda z: z["share"] * F.col("n") >= _MIN_WINDOWS * size,
    )
    cuts = F.transform(long_enough, lambda z: z["cuts"])
    return sketch.select(
        "query_id", F.concat(cuts, F.array(F.lit(float("-inf")))).alias("bounds")
    )


def _replicated(per_query: DataFrame) -> DataFrame:
    """A row per query, once for each part its ranking is joined in."""
    return per_query.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def survivors(
    scores: DataFrame,
    open_queries: DataFrame,
    with_titles: Callable[[DataFrame], DataFrame],
    min_distance: float = MIN_TITLE_DISTANCE,
    many: bool = False,
) -> DataFrame:
    """The scored rows of open queries, down to the bound of their stretch, that nothing kept
    so far rules out, with their titles. Rows of earlier windows were kept, or are close to a kept
    title, so they are out as well.

    Where the state of the queries is too large to be broadcast, a row meets it by query and part
    of the ranking, so that the stretch of one hot query is looked at in ``PARTS`` tasks. Titles are fetched
    for the stretch alone, and the kept titles join after that.
    """
    state = _replicated(open_queries.select(
        "query_id", "kept", F.get("bounds", F.col("stretch")).alias("bound")
    ))
    parts = scores.withColumn("part", part_of(F.col("row_id")))
    stretch = (
        parts.join(state.drop("kept"), ["query_id", "part"])
        # rounded as in the ranking, so that a stretch is a whole number of places in it
        .where(F.round("score", SCORE_DIGITS) >= F.round("bound", SCORE_DIGITS))
        .drop("bound")
    )
    titled = with_titles(stretch).join(state.drop("bound"), ["query_id", "part"])
    stands = F.exists("kept", lambda d: d["row_id"] == F.col("row_id"))
    if many and min_distance > 0:
        near = near_any(F.col("title"), _titles(F.col("kept")), min_distance)
        return titled.where(~stands).withColumn("near", near).where(~F.col("near")).drop("kept", "part", "near")
    out = stands | _close_to_any(F.col("kept"), F.col("title"), min_distance)
    return titled.where(~out).drop("kept", "part")


def distinct_top(
    scores: DataFrame,
    with_titles: Callable[[DataFrame], DataFrame],
    scores_of: Callable[[DataFrame], DataFrame],
    save: Callable[[str, DataFrame], DataFrame],
    k: int = TOP_K,
    min_distance: float = MIN_TITLE_DISTANCE,
    size: int = WINDOW,
    first: int | None = None,
    bounds_of: Callable[[DataFrame, int], DataFrame] | None = None,
    many: bool = False,
) -> DataFrame:
    """``(query_id, kept)`` for every query with a candidate.

    ``scores`` are ``(query_id, row_id, doc_id, score)`` and what ``with_titles`` needs to fetch the titles
    of some rows; ``scores_of`` gives the scores of some queries, down to the bound of their stretch at least, for the
    rare further rounds; ``save`` writes a small table and reads it back. ``first`` is the size of the first window
    where it is another, ``bounds_of`` gives ``stretch_bounds`` where it is not taken from ``scores_of``; ``many`` as in ``fold_window``.
    """
    def cut(rows: DataFrame, n: int = size) -> DataFrame:
        return top_ranked(rows, n, TIE_BREAK, in_parts=True)

    first = first or size
    full, seen_all = F.size("kept") >= k, F.col("seen") < size
    state = save("kept_1", fold_window(
        with_titles(cut(scores, first)), None, k, min_distance, many
    ))
    closed = [state.where(full | (F.col("seen") < first)).select("query_id", "kept")]
    open_queries = state.where(~(full | (F.col("seen") < first)))
    left_open = not open_queries.isEmpty()
    if left_open:
        if bounds_of:
            bounds = bounds_of(open_queries, size)
        else:
            bounds = stretch_bounds(scores_of(open_queries), size)
        open_queries = save(
            "bounds", open_queries.join(bounds, "query_id").withColumn("stretch", F.lit(0))
        )
    round_no = 1
    while left_open:
        round_no += 1
        left = survivors(scores_of(open_queries), open_queries, with_titles, min_distance, many)
        folded = fold_window(cut(left), open_queries, k, min_distance, many)
        places = open_queries.select("query_id", "bounds", "stretch")
        # A stretch that gave less than a full window is used up.
        state = folded.join(places, "query_id").withColumn(
            "stretch", F.col("stretch") + seen_all.cast("int")
        )
        state = save(f"kept_{round_no}", state)
        done = full | (F.col("stretch") >= F.size("bounds"))
        closed.append(state.where(done).select("query_id", "kept"))
        open_queries = state.where(~done)
        left_open = not open_queries.isEmpty()
    result = closed[0]
    for part in closed[1:]:
        result = result.unionByName(part)
    return result


def kept_rows(kept: DataFrame) -> DataFrame:
    """``(query_id, rank, doc_id, score, title)``: ranks run 1, 2, … without gaps."""
    return kept.select("query_id", F.posexplode("kept").alias("position", "item")).select(
        "query_id",
        (F.col("position") + 1).alias("rank"),
        F.col("item.doc_id").alias("doc_id"),
        F.col("item.score").alias("score"),
        F.col("item.title").alias("title"),
    )
