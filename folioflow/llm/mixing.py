"""Mixing sources to target weights by balanced sampling (the cube method).

Every document is taken ``target / source size`` times on average: the whole part for
certain, the rest as an inclusion probability. The flight phase moves these probabilities
through the null space of two constraints, the source's words and its number of
documents, until each is 0 or 1 but for at most two units of a block. These leftovers meet
in larger blocks again, until one block a source is left. There the few units that outweigh
the others are drawn first, in a way that the others can make up for, and the others' chances
follow. ``RESERVE`` units of all sizes stay out of the last flight; they and its leftovers
are the landing problem: of all their choices the one whose words come closest to the target.

A unit is a group of equal rows (same id, text, source), so results do not depend on the
order of rows. NULL texts have no words, NULL ids and sources are values like any other.
A source without words has target 0 and keeps its place in the weights. An empty table
gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.store import extended, lean, materialise
from folioflow.llm.words import WordHasher, slices

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 4096
#: Units that land, spread in size, and units drawn first: all choices of each are looked at.
RESERVE, GIANTS = 14, 10
#: Where a source has no more ways than that to take its units, each up to the cap, all are looked at.
WAYS = 1 << 20
EPSILON = 1e-9


def with_sizes(docs: DataFrame, text: str, keep: list[Column], name: str = "size") -> DataFrame:
    """The kept columns and the number of words of every row's text."""
    source = docs.select(*keep, F.col(text).alias("_text"))
    kept = source.drop("_text").schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = WordHasher().inside
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for _, _, data, bounds in slices(batch.column(batch.num_columns - 1)):
                word = inside[data]
                first = word.copy()
                first[1:] &= ~word[:-1]
                cut = bounds[:-1][bounds[:-1] < len(data)]
                first[cut] = word[cut]
                found.append(np.diff(np.concatenate([[0], np.cumsum(first)])[bounds]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(found))], names=[*kept.names, name]
            )

    return source.mapInArrow(lean(count), extended(kept, f"{name} long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Sharing by weight, cutting at the cap and resharing the excess ends at one level L with
    sum(min(cap, L weight)) = all words. In the order of cap / weight the cut sources come
    first, so L follows from running sums.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * float(cap))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_level",
            (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            / F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        # the first source that its level does not fill sets the level of all that follow
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)["_level"])
        .select("source", "source_size", F.least("_cap", F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap"))).alias("target"))
    )


def flight(size: np.ndarray, count: np.ndarray, chance: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but for at most two.

    Three units at a time: a direction that keeps both totals is the cross product of the
    constraints' rows. One of the two steps that bring a unit to 0 or 1 is drawn so that
    every probability keeps its mean.
    """
    p = chance.tolist()
    s, c = size.tolist(), count.tolist()
    hand: list[int] = []
    for k, value in enumerate(p):
        if not EPSILON < value < 1 - EPSILON:
            p[k] = float(round(value))
            continue
        hand.append(k)
        while len(hand) == 3:
            x, y, z = hand
            u = (s[y] * c[z] - s[z] * c[y], s[z] * c[x] - s[x] * c[z], s[x] * c[y] - s[y] * c[x])
            if not any(u):  # equal ratios: two units already keep both totals
                u = (c[y], -c[x], 0.0)
            up = min((1 - p[i]) / v if v > 0 else -p[i] / v for i, v in zip(hand, u, strict=True) if v)
            down = min(p[i] / v if v > 0 else (p[i] - 1) / v for i, v in zip(hand, u, strict=True) if v)
            step = up if draws[k] * (up + down) < down else -down
            for i, v in zip(hand, u, strict=True):
                p[i] = min(1.0, max(0.0, p[i] + step * v))
            for i in list(hand):
                if not EPSILON < p[i] < 1 - EPSILON:
                    p[i] = float(round(p[i]))
                    hand.remove(i)
    return np.array(p)


def choices(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every choice among a few units (rows of 0 and 1) and the words it takes."""
    taken = (np.arange(1 << len(size))[:, None] >> np.arange(len(size))) & 1
    return taken, taken @ size


def drawn_first(size: np.ndarray, rate: np.ndarray, draws: np.ndarray, cap: int) -> np.ndarray:
    """Rates after the units that outweigh the others were drawn, and the others made up for it.

    Of the choices that leave the others a total they can reach, or come nearest to that, the one
    taken differs in the fewest units from the units' own draws. The others then share their
    total in proportion, up to the cap.
    """
    whole = np.floor(rate + EPSILON)
    largest = np.argsort(-size, kind="stable")
    giants = np.array([i for k, i in enumerate(largest[:GIANTS]) if k + 1 < len(size) and size[i] >= 4 * size[largest[k + 1:]].mean()], int)
    giants = giants[rate[giants] - whole[giants] > EPSILON]
    if not len(giants):
        return rate
    others = np.setdiff1d(np.arange(len(size)), giants)
    taken, words = choices(size[giants])
    left = (size * rate).sum() - words - (size * whole)[giants].sum()
    missed = np.maximum(0, -left) + np.maximum(0, left - cap * size[others].sum())
    flips = (taken != (draws[giants] < (rate - whole)[giants])).sum(axis=1)
    best = np.lexsort((np.arange(len(words)), flips, missed))[0]
    new, goal = rate.copy(), min(max(0.0, left[best]), cap * size[others].sum())
    new[giants] = whole[giants] + taken[best]
    for _ in range(len(others)):  # what the cap cuts off is shared again
        total = (size * new)[others].sum()
        open_ = others[(new[others] < cap) & (new[others] > 0)] if goal > total else others
        if abs(goal - total) < EPSILON * max(1.0, goal) or not len(open_):
            break
        new[open_] = np.minimum(cap, new[open_] * (1 + (goal - total) / (size * new)[open_].sum()))
    return new


def few(size: np.ndarray, rate: np.ndarray, cap: int) -> np.ndarray:
    """Of all ways to take few units, among those within half a percent of the expected words the one nearest to the rates."""
    words, away = np.zeros(1), np.zeros(1)
    for one, expected in zip(size, rate, strict=True):
        copies = np.arange(cap + 1)
        words = np.add.outer(words, copies * one).ravel()
        away = np.add.outer(away, one * (copies - expected) ** 2).ravel()
    miss = np.abs(words - (size * rate).sum())
    room = max(miss.min(), 0.005 * (size * rate).sum())
    best = int(np.argmin(np.where(miss <= room + EPSILON, away, np.inf)))
    return np.array(np.unravel_index(best, (cap + 1,) * len(size)), float)


def settle(size: np.ndarray, count: np.ndarray, rate: np.ndarray, draws: np.ndarray, cap: int) -> np.ndarray:
    """How often every unit of a source's last block is taken, the words near the expected."""
    if (cap + 1) ** len(size) <= WAYS:
        return few(size, rate, cap)
    want = float((size * rate).sum())
    rate = drawn_first(size, rate, draws, cap)
    whole = np.floor(rate + EPSILON)
    p = np.maximum(0.0, rate - whole)
    open_ = np.flatnonzero(p > EPSILON)
    by_size = open_[np.argsort(size[open_], kind="stable")]
    reserve = by_size if len(by_size) <= RESERVE else by_size[np.unique(np.linspace(0, len(by_size) - 1, RESERVE).astype(int))]
    rest = np.setdiff1d(np.arange(len(p)), reserve)
    p[rest] = flight(size[rest], count[rest], p[rest], draws[rest])
    last = np.concatenate([reserve, rest[(p[rest] > 0) & (p[rest] < 1)]])
    p[last] = 0
    taken, words = choices(size[last])
    p[last] = taken[np.lexsort((np.arange(len(words)), np.abs(words + (size * (whole + p)).sum() - want)))[0]]
    return whole + p


def fly(units: DataFrame, buckets: str, final: bool, cap: int) -> DataFrame:
    """One flight per source and bucket; in the final one all units settle."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("key", ignore_index=True)
        size, count = block["words"].to_numpy(float), block["rows"].to_numpy(float)
        draws = (block["draw"].to_numpy(np.int64).astype(np.uint64) >> np.uint64(11)) / 2.0**53
        chance = block["chance"].to_numpy(float)
        if final:
            taken = settle(size, count, block["whole"].to_numpy(float) + chance, draws, cap)
            return block.assign(whole=taken.astype(np.int64), chance=0.0)
        return block.assign(chance=flight(size, count, chance, draws))

    return units.withColumn("bucket", F.expr(buckets)).groupBy("source", "bucket").applyInPandas(run, units.withColumn("bucket", F.expr(buckets)).schema).drop("bucket")


def goals(sized: DataFrame, size: str, source: str, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The targets over all rows: a source without words keeps its place among the weights."""
    per_source = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    return materialise(targets(per_source, weights, cap), "mix-targets")


def mix(docs: DataFrame, key: str, size: str, source: str, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """(_key, source, source_size, target, copies) per distinct ``key`` of rows with words.

    ``key`` tells rows apart; rows that share one are taken together. ``goal`` has the sources'
    targets. Rows without words never move a total and are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(size).alias("words"), F.col(source).alias("source")).where("words > 0")
    units = materialise(
        rows.groupBy("key", "source").agg(F.sum("words").alias("words"), F.count("*").alias("rows")), "mix-units"
    )
    per_source = units.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("_units"))
    share = goal.join(per_source, F.col("source").eqNullSafe(F.col("_source")), "inner").drop("_source")
    rate = F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))
    begun = materialise(
        units.alias("u").join(share.alias("g"), F.expr("u.source <=> g.source"))
        .select("u.key", "u.source", "u.words", "u.rows", "source_size", "target", F.col("_units").alias("left"),
                F.floor(rate + EPSILON).alias("whole"), rate.alias("chance"), F.xxhash64("u.key", F.lit(17)).alias("draw"))
        .withColumn("chance", F.greatest(F.lit(0.0), F.col("chance") - F.col("whole"))),
        "mix-begin",
    )
    fractional = f"chance > {EPSILON}"
    done = [begun.where(f"NOT ({fractional})").withColumn("chance", F.lit(0.0))]
    rest, most = begun.where(fractional), begun.agg(F.max("left")).first()[0] or 0
    level = 0
    while most:
        final = most <= BLOCK
        flown = materialise(
            fly(rest, "0L" if final else f"pmod(xxhash64(key, {level}), CAST(ceil(left / {BLOCK}) AS BIGINT))", final, cap),
            f"mix-{level}",
        )
        done.append(flown.where("chance IN (0, 1)"))
        if final:
            break
        rest = flown.where("chance NOT IN (0, 1)")
        most = 2 * math.ceil(most / BLOCK)  # at most two units a block are open
        rest = rest.withColumn("left", 2 * F.ceil(F.col("left") / BLOCK))
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out.select(F.col("key").alias("_key"), "source", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))


def row_key(key: str, text: str, source: str) -> Column:
    """A name for a document's row, the same for equal rows only."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in (key, source, text)]
    return F.sha2(F.concat_ws("\0", F.octet_length(part[0]).cast("string"), part[0], F.octet_length(part[1]).cast("string"), *part[1:]), 256)


def mixed_sizes(docs: DataFrame, key: str, text: str, source: str, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    kept = [F.col(key).alias("doc_id"), F.col(source).alias("source"), row_key(key, text, source).alias("_row")]
    sized = materialise(with_sizes(docs, text, kept), "mix-sizes")
    goal = goals(sized, "size", "source", weights, cap)
    taken = mix(sized, "_row", "size", "source", goal, cap)
    rows = sized.join(taken.select("_key", "copies"), F.col("_row") == F.col("_key"), "left")
    return (
        rows.alias("r").join(goal.alias("g"), F.expr("r.source <=> g.source"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"))
    )


def mixed(docs: DataFrame, key: str, text: str, source: str, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    name = row_key(key, text, source)
    sized = materialise(with_sizes(docs, text, [F.col(source).alias("source"), name.alias("_row")]), "mix-sizes")
    goal = goals(sized, "size", "source", weights, cap)
    taken = mix(sized, "_row", "size", "source", goal, cap).where("copies > 0").select("_key", "copies")
    rows = docs.select(F.struct("*").alias("row"), name.alias("_key")).join(taken, "_key")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
