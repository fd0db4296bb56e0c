"""Mixing sources to target weights by fitting subset sums to budgets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskflow.llm.common import BROADCAST_BYTES, bytes_of, hashable, null_key, numbered, stored, word_count

# Fixed values of the production mix.
WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 1.5
MOST = 2.0

# Rows of (source, size, cut) up to which the table is broadcast, if its bytes allow.
BROADCAST_ROWS = 500_000
SALTS = 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs=EPOCHS, most=MOST) -> DataFrame:
    """(source, source_size, target) given (source, size).

    Sources sorted by code point, null last, take the weights in turn. Targets
    share ``epochs`` times all sizes by weight; a target stops at ``most`` times
    its source's size and the excess is shared again by weight until none is
    above. That ends where target = least(most * size, weight * level) for the
    one level that uses up the budget, found by prefix sums over the sources
    sorted by the level at which they stop. One row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = totals.withColumn("weight", weight).withColumn(
        "most", F.col("source_size").cast("double") * most
    )
    rows = rows.withColumn("stop", F.col("most") / F.col("weight"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    below = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_stop.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(epochs))).alias("budget"),
        F.coalesce(F.sum("most").over(below), F.lit(0.0)).alias("stopped"),
        F.sum("weight").over(from_here).alias("open"),
    )
    level = (F.col("budget") - F.col("stopped")) / F.col("open")
    level = F.max(F.when(level <= F.col("stop"), level)).over(everything)
    return rows.select(
        "source",
        "source_size",
        F.least("most", F.col("weight") * F.coalesce(level, F.lit(float("inf")))).alias("target"),
    )


def knapsack(sizes: list[int], rooms: list[int], budget: int, rest: float = 0.0) -> dict[int, int]:
    """How many documents of each index to take, at most ``rooms`` of it, so that the sum
    of their sizes is nearest to ``budget`` and a ``rest`` below 1; of two as near the lower.

    A bounded knapsack with a bit for every reachable sum, counts in binary
    parts. Sums up to one largest size above the budget are looked at. What was taken is
    traced by halves, so that few tables of sums are held, however many parts there are.
    """
    usable = [i for i, room in enumerate(rooms) if room]
    if not usable or budget < 0:
        return {}
    reach = budget + max(sizes[i] for i in usable)
    parts = []  # (index, number of documents)
    for i in usable:
        room, part = min(rooms[i], reach // sizes[i]), 1
        while room > 0:
            parts.append((i, min(part, room)))
            room -= parts[-1][1]
            part *= 2
    mask = (1 << (reach + 1)) - 1

    def after(state: int, some: list[tuple[int, int]]) -> int:
        for i, n in some:
            state |= (state << sizes[i] * n) & mask
        return state

    taken: dict[int, int] = {}

    def trace(state: int, some: list[tuple[int, int]], goal: int) -> int:
        """Take of ``some`` what leads from the sums ``state`` to ``goal``; the sum left."""
        if len(some) == 1:
            if state >> goal & 1:
                return goal
            i, n = some[0]
            taken[i] = taken.get(i, 0) + n
            return goal - sizes[i] * n
        half = len(some) // 2
        goal = trace(after(state, some[:half]), some[half:], goal)
        return trace(state, some[:half], goal)

    last = after(1, parts)
    best = (last & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = last >> (budget + 1)
    if above:
        over = budget + 1 + (above & -above).bit_length() - 1
        best = over if over - budget - rest < budget - best + rest else best
    trace(1, parts, best)
    return taken


def pools(sizes: list[int], counts: list[int], shares: list[int], budget: int) -> Iterator[tuple[list[int], list[int]]]:
    """(lows, rooms) of ever larger pools: how often each size is taken for certain, and how
    often it may be taken beyond. Sizes are ascending, ``shares`` lie near the budget.

    A pool is of the smallest sizes, around their shares; the other sizes keep theirs, but
    that some are given back or added until the budget lies in the middle of the sums of
    the pool, where these are densest. The last pool is of all sizes. It holds a nearest
    sum: as sums lie within one largest size of the budget, a nearest solution differs from
    the one that fills up the sizes in their order by fewer documents than three times the
    largest size and four (proximity of integer and fractional solutions of one equation).
    """
    kinds, room = 64, 7
    while kinds < 4 * len(sizes) or room < 64:
        lows, rooms = list(shares), [0] * len(sizes)
        for i in range(min(kinds, len(sizes))):
            rooms[i] = min(room, counts[i])
            lows[i] = min(max(0, shares[i] - rooms[i] // 2), counts[i] - rooms[i])
        whole = sum(s * n for s, n in zip(sizes, rooms))
        rest = budget - sum(s * n for s, n in zip(sizes, lows))
        for i in reversed(range(min(kinds, len(sizes)), len(sizes))):
            if sizes[i] <= whole // 2:
                back = min(lows[i], max(0, -(-(whole // 4 - rest) // sizes[i])))
                more = min(counts[i] - lows[i], max(0, -(-(rest - whole * 3 // 4) // sizes[i])))
                lows[i] += more - back
                rest -= (more - back) * sizes[i]
        if 0 <= rest <= whole:
            yield lows, rooms
        kinds, room = 4 * kinds, 2 * room
    filled, left = [], budget
    for size, count in zip(sizes, counts):
        filled.append(min(count, left // size))
        left -= size * filled[-1]
    near = 3 * sizes[-1] + 4
    lows = [max(0, n - near) for n in filled]
    yield lows, [min(count, n + near) - low for count, n, low in zip(counts, filled, lows)]


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to the nearest there
    is to ``budget``; sizes are positive, ascending and distinct.

    Sizes are divided by what divides all of them. Every size first gives its share of the
    budget, rounded down; then sizes with the largest lost parts give one more while it
    fits. What remains is fitted by a bounded knapsack over ever larger pools of sizes,
    until no sum can be nearer: a multiple of the common divisor is met, or the pool holds
    a nearest sum. Real sizes are met by the first pool; only sizes whose sums have gaps
    need the last, whose cost grows with the largest size, not with the documents.
    """
    common = math.gcd(*(int(s) for s in sizes)) if len(sizes) else 1
    sizes = [int(s) // common for s in sizes]
    counts = [int(c) for c in counts]
    total = sum(s * c for s, c in zip(sizes, counts))
    wanted = max(0, min(int(budget), total * common))
    if not total or not wanted:
        return np.zeros(len(sizes), dtype=np.int64)
    budget, part = divmod(wanted, common)  # ``part`` cannot be met by any sum
    shares = [c * budget // total for c in counts]
    lost = [c * budget % total for c in counts]
    left = budget - sum(s * n for s, n in zip(sizes, shares))
    for i in sorted(range(len(sizes)), key=lambda i: (-lost[i], -sizes[i])):
        if sizes[i] <= left and shares[i] < counts[i]:
            shares[i] += 1
            left -= sizes[i]

    def miss(taken: list[int]) -> int:
        return abs(wanted - common * sum(s * n for s, n in zip(sizes, taken)))

    least = min(part, common - part)
    found = shares
    for lows, rooms in pools(sizes, counts, shares, budget):
        if miss(found) == least:
            break
        taken = list(lows)
        rest = budget - sum(s * n for s, n in zip(sizes, lows))
        for i, n in knapsack(sizes, rooms, rest, part / common).items():
            taken[i] += n
        if miss(taken) < miss(found):
            found = taken
    return np.array(found, dtype=np.int64)


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """Of one source, with a row per size: how often all are taken, how many once more."""
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    whole = int(target // size) if size else 0
    extra = np.zeros(len(group), dtype=np.int64)
    useful = (group["size"] > 0).to_numpy()
    order = np.argsort(group["size"].to_numpy()[useful])
    index = np.flatnonzero(useful)[order]
    extra[index] = fit_counts(
        group["size"].to_numpy()[index],
        group["n"].to_numpy()[index],
        round(target - whole * size),
    )
    return group[["source_key", "size"]].assign(whole=whole, extra=extra)


def mix_plan(sizes: DataFrame, **shares) -> DataFrame:
    """What the mix does with every (source, size): (source_key, size, whole, extra,
    cut, at_cut, source_size, target).

    ``sizes`` has source, size and draw, a seeded hash of the row. All rows are
    taken ``whole`` times, and those of the ``extra`` lowest draws once more:
    draws below ``cut``, and ``at_cut`` of the rows that share the draw ``cut``.
    The cut comes from counts by 1/4096 of the draws' range, then from counts of
    the draws in the one part it lies in, so no task holds a whole size.
    """
    rows = sizes.select(null_key(F.col("source")).alias("source_key"), "source", "size", "draw")
    targets = source_targets(rows, **shares).withColumn("source_key", null_key(F.col("source")))
    lengths = rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n"))
    fitted = (
        lengths.join(targets.drop("source"), "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit, "source_key string, size bigint, whole bigint, extra bigint")
    )
    keys = ["source_key", "size"]
    rows = rows.withColumn("part", F.shiftrightunsigned("draw", 52))
    ordered = Window.partitionBy(*keys).orderBy("part")
    parts = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("upto", F.sum("n").over(ordered)).join(fitted, keys)
    parts = parts.where("upto - n < extra and upto >= extra").select(
        *keys, "part", (F.col("extra") - F.col("upto") + F.col("n")).alias("in_part")
    )
    # Unsigned order of draws is that of their top 12 bits, then of the other 52.
    low = F.col("draw").bitwiseAND(F.lit((1 << 52) - 1))
    draws = (
        rows.groupBy(*keys, "part", "draw").agg(F.count(F.lit(1)).alias("n"))
        .join(parts, [*keys, "part"])
        .withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy(low)))
        .where("upto - n < in_part and upto >= in_part")
        .select(*keys, F.col("draw").alias("cut"), (F.col("in_part") - F.col("upto") + F.col("n")).alias("at_cut"), F.col("n").alias("with_cut"))
    )
    return (
        fitted.join(draws, keys, "left").join(targets.drop("source"), "source_key")
        .select(*keys, "whole", "cut", "at_cut", "with_cut", "source_size", "target")
    )


def sized(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Rows (doc, source, _size, _draw, _home): the row packed, so that its names
    clash with none here, its source, its words, a seeded hash of the whole row,
    and the partition it is read from."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(
        F.struct(*columns).alias("doc"),
        F.col("source"),
        word_count("text").alias("_size"),
        F.xxhash64(F.lit(seed), *hashable(docs)).alias("_draw"),
        F.spark_partition_id().alias("_home"),
    )


def taken_times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (from ``sized``) with ``_times``, ``_source_size`` and ``_target``.

    The plan has a row per (source, size): it is broadcast while it is
    small, else every row of it is copied to 16 salts. Rows equal to the cut are
    equal in all columns; they are counted off with ``numbered``.
    """
    any_ties = bool(plan.where("at_cut < with_cut").head(1))
    plan = plan.select(*(F.col(c).alias(f"_{c}") for c in plan.columns))
    keys = ["_source_key", "_size"]
    rows = rows.withColumn("_source_key", null_key(F.col("source")))
    if plan.count() <= BROADCAST_ROWS and bytes_of(plan) <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(plan), keys)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = rows.withColumn("_salt", F.pmod("_draw", F.lit(SALTS)).cast("int"))
        met = salted.join(plan.withColumn("_salt", salts), [*keys, "_salt"]).drop("_salt")
    part = F.shiftrightunsigned("_draw", 52)
    cut_part = F.shiftrightunsigned("_cut", 52)
    low = F.lit((1 << 52) - 1)
    below = (part < cut_part) | (
        (part == cut_part) & (F.col("_draw").bitwiseAND(low) < F.col("_cut").bitwiseAND(low))
    )
    tied = F.coalesce((F.col("_draw") == F.col("_cut")) & (F.col("_at_cut") < F.col("_with_cut")), F.lit(False))
    once_more = F.coalesce(below | (F.col("_draw") == F.col("_cut")), F.lit(False))
    if not any_ties:  # no repeated rows at a cut: one pass
        return met.withColumn("_times", F.col("_whole") + once_more.cast("bigint"))
    clear = met.where(~tied).withColumn("_times", F.col("_whole") + once_more.cast("bigint"))
    ties = numbered(met.where(tied), keys, "_draw", "_place", "_home")
    ties = ties.withColumn("_times", F.col("_whole") + (F.col("_place") < F.col("_at_cut")).cast("bigint"))
    return clear.unionByName(ties.drop("_place"))


def mix(docs: DataFrame, seed: int = 1, **shares) -> DataFrame:
    """Documents of the mix: every row as often as it is taken, with its columns.

    Null texts and texts without words have size 0 and stay as often as their
    whole source does; a null source is a source, sorted last; repeated rows
    are taken apart; an empty table gives an empty mix. ``docs`` must read
    stored files.
    """
    rows = sized(docs, seed)
    narrow = stored(
        rows.select("source", F.col("_size").alias("size"), F.col("_draw").alias("draw")), "sizes"
    )
    plan = stored(mix_plan(narrow, **shares), "mix")
    repeats = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    times = taken_times(rows, plan).where("_times > 0").withColumn("_copy", repeats)
    return times.select("doc.*")


def mix_digests(docs: DataFrame, seed: int = 1, **shares) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    narrow = stored(sized(docs, seed).select(F.col("doc.doc_id"), "source", "_size", "_draw", "_home"), "sizes")
    plan = stored(
        mix_plan(narrow.select("source", F.col("_size").alias("size"), F.col("_draw").alias("draw")), **shares),
        "mix",
    )
    return taken_times(narrow, plan).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_times") * F.col("_size")).alias("taken"),
    )
