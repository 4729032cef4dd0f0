"""Embedding near-duplicates by collision-counting projections.

Vectors of unit length are projected onto many random lines. Along a line a vector's
window reaches ``WIDTH`` standard deviations of a pair at the threshold to either side; two
vectors collide there when one lies in the other's window. A pair is verified when it
collides on at least ``least_count`` of ``LINES`` lines, the count that a pair at the
threshold reaches with the target recall, and links when its cosine, in double precision,
reaches the threshold.

Collisions are counted inside cells. A cell holds the vectors that lie furthest along the
same one of some random directions. Coarse cells fit in a task; a vector travels once for
each coarse table, one table after the other, and what a table moved is dropped before the
next. Inside a coarse cell, fine tables of two sets of directions deal the vectors again in
memory. Numbers of tables follow from the recall: half of what may be missed for the coarse
ones, half for the fine ones, which are the same in every coarse table. Pairs unlike on too
many sides of ``SKETCH`` lines are not counted. A pair is looked at in the first table that
it shares only. Coarse cells of any size are cut into blocks that meet in rounds, each of
which moves a block twice at most; equal vectors are one class and never become pairs.

Many distinct near copies are a ball: vectors within half the threshold's angle of a centre
link with one another, whatever they are, and are counted without forming pairs.

Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with
nothing, nor do vectors of different lengths. Rows with a NULL id are rows of their own.
The table is read more than once.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from folioflow.llm.blocks import clusters, whole_groups
from folioflow.llm.components import components
from folioflow.llm.store import lean, materialise, shuffle_width
from folioflow.llm.words import mix

THRESHOLD, RECALL = 0.9, 0.999
LINES, WIDTH = 32, 2.0
SKETCH = 192
#: Bytes of an average coarse cell and of a block; rows of an average fine cell.
CELL_BYTES, BLOCK_BYTES, CELL_ROWS = 12 << 20, 24 << 20, 2
#: Tables and rounds are moved together up to so many bytes, or 1.3 times the classes.
PASS_BYTES = 128 << 20
#: Classes of one bucket that make it worth a centre, and the most centres.
HEAVY, MOST_BALLS = 512, 1024
#: Rows of a fine cell whose pairs are compared by distance in order.
SMALL = 200
#: Pairs formed at once.
PAIRS = 1 << 18


def least_count(lines: int, width: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    p = math.erf(width / math.sqrt(2))
    tail, count = 0.0, 0
    while tail + (step := math.comb(lines, count) * p**count * (1 - p) ** (lines - count)) <= 1 - recall:
        tail, count = tail + step, count + 1
    return count


def most_unlike(bits: int, threshold: float, miss: float) -> int:
    """The least number of lines that a pair at the threshold exceeds as separated with probability ``miss`` at most."""
    p = math.acos(threshold) / math.pi
    tail, count = 1.0, -1
    while tail > miss and count < bits:
        count += 1
        tail -= math.comb(bits, count) * p**count * (1 - p) ** (bits - count)
    return count


def same_cell(directions: int, threshold: float) -> float:
    """How probably a pair at the threshold lies furthest along the same one of random directions.

    That is the integral of ``directions`` times the density of two normal numbers so
    correlated times the probability that both exceed those of all other directions.
    """
    rho, step = min(threshold, 0.999), 0.02
    x = np.arange(-7, 7, step) + step / 2
    density = np.exp(-(x[:, None] ** 2 - 2 * rho * x[:, None] * x + x**2) / (2 * (1 - rho**2)))
    density /= density.sum()
    below = np.zeros((len(x) + 1, len(x) + 1))
    below[1:, 1:] = density.cumsum(0).cumsum(1)
    middle = (below[1:, 1:] + below[1:, :-1] + below[:-1, 1:] + below[:-1, :-1]) / 4
    return min(1.0, float(directions * (density * middle ** (directions - 1)).sum()))


def tables_for(p: float, miss: float) -> int:
    """Tables so that a pair that shares each with probability ``p`` shares none with probability ``miss`` at most."""
    return 1 if p >= 1 - miss else math.ceil(math.log(miss) / math.log(1 - p))


class Plan:
    """How many cells and tables a number of classes takes, and the cells of vectors."""

    def __init__(self, classes: int, width: float, threshold: float, recall: float) -> None:
        miss = (1 - recall) / 2
        each = width + 100  # what travels beside a vector
        self.coarse = min(1 << 16, max(1, math.ceil(classes * each / CELL_BYTES)))
        self.tables = tables_for(same_cell(self.coarse, threshold), miss)
        self.fine = min(1 << 8, max(1, math.ceil(math.sqrt(classes / self.coarse / CELL_ROWS))))
        self.subtables = tables_for(same_cell(self.fine, threshold) ** 2, miss)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Per row the coarse cell of each table, then the fine cell of each subtable."""
        out = np.empty((len(unit), self.tables + self.subtables), np.uint16)
        for table in range(self.tables):
            out[:, table] = furthest(unit, self.coarse, 31, table)
        for table in range(self.subtables):
            first, second = (furthest(unit, self.fine, seed, table) for seed in (33, 34))
            out[:, self.tables + table] = first * self.fine + second
        return out


def lines_of(dimension: int, count: int, seed: int, table: int = 0) -> np.ndarray:
    return np.random.default_rng([seed, dimension, table]).standard_normal((dimension, count)).astype(np.float32)


def furthest(unit: np.ndarray, directions: int, seed: int, table: int) -> np.ndarray:
    """The direction along which each vector lies furthest."""
    lines, step = lines_of(unit.shape[1], directions, seed, table), max(1, (1 << 20) // directions)
    return np.concatenate([(unit[at:at + step] @ lines).argmax(axis=1) for at in range(0, max(1, len(unit)), step)])


def sides(unit: np.ndarray) -> np.ndarray:
    """On which side of SKETCH lines each vector lies, 64 in a number."""
    return np.ascontiguousarray(np.packbits(unit @ lines_of(unit.shape[1], SKETCH, 35) >= 0, axis=1).view(np.uint64).T)


def buckets(unit: np.ndarray) -> np.ndarray:
    """One of 2^24 cells, and the dimension above them; apart from chance, only near copies fill one."""
    number = np.full(len(unit), unit.shape[1], np.int64)
    for table in range(4):
        number = number * 64 + furthest(unit, 64, 36, table)
    return number


def as_unit(matrix: np.ndarray, step: int = 4096) -> np.ndarray:
    out = np.empty(matrix.shape, np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(matrix), step):
            wide = matrix[at:at + step].astype(np.float64)
            out[at:at + step] = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    return out


def plain(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Which lists are vectors that can link, and the bytes of those."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False)
    bounds -= bounds[0]
    wide = values.astype(np.float64)
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        some = wide * wide > 0  # NULL components have become NaN
    odd, some = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(wide), some))
    begin, end = bounds[:-1], bounds[1:]
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (odd[begin] == odd[end]) & (some[begin] < some[end])
    kept = values[np.repeat(fine, end - begin)]
    width = np.concatenate([[0], np.cumsum((end - begin)[fine])]) * values.itemsize
    return fine, pa.Array.from_buffers(pa.binary(), int(fine.sum()), [None, pa.py_buffer(width.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])


def parts_of(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Batches of a million numbers in a column of lists, or of one row."""
    for batch in batches:
        numbers = pc.sum(batch.column(name).value_lengths()).as_py() or 0
        step = max(1, batch.num_rows * (1 << 20) // max(1, numbers))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def fixed(values: pa.Array, kind: str) -> np.ndarray:
    """Equally long binary values, at least one, as rows."""
    bounds = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[bounds[0]:bounds[-1]].view(kind).reshape(len(values), -1)


def by_width(vectors: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equally long vectors, and the vectors as a matrix."""
    widths = pc.binary_length(vectors).to_numpy()
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        part = vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows))
        yield rows, fixed(part, kind)


def digests(vectors: pa.Array) -> list[bytes]:
    return [hashlib.blake2b(v, digest_size=16).digest() for v in vectors.to_pylist()]


def identified(source: DataFrame, kind: str) -> DataFrame:
    """(vec_id, digest, width, bucket) per row; a row that cannot link has no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "vector"):
            fine, vectors = plain(batch.column(1))
            at = np.flatnonzero(fine)
            found = np.zeros(len(at), np.int64)
            for rows, matrix in by_width(vectors, kind):
                found[rows] = buckets(as_unit(matrix))
            place = np.zeros(len(fine), np.int64)
            place[at] = np.arange(len(at))
            place = pa.array(place, mask=~fine)
            columns = [pa.array(digests(vectors), pa.binary()), pc.binary_length(vectors), pa.array(found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[c.take(place) for c in columns]], names=["vec_id", "digest", "width", "bucket"])

    return source.select("vec_id", "vector").mapInArrow(lean(run), "vec_id long, digest binary, width int, bucket long")


def sums_of(source: DataFrame, kind: str, heavy: np.ndarray) -> DataFrame:
    """(bucket, total): the sum of the unit vectors of each of some buckets (in order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in parts_of(batches, "vector"):
            for _, matrix in by_width(plain(batch.column(0))[1], kind):
                unit = as_unit(matrix)
                bucket = buckets(unit)
                place = np.minimum(np.searchsorted(heavy, bucket), len(heavy) - 1)
                for k in np.unique(place[heavy[place] == bucket]):
                    total = unit[bucket == heavy[k]].sum(axis=0, dtype=np.float64)
                    totals[k] = totals[k] + total if k in totals else total
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(heavy[k]) for k in totals]), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["bucket", "total"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = np.frombuffer(total)
                totals[bucket] = totals[bucket] + total if bucket in totals else total
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["bucket", "total"])

    kinds = "bucket long, total binary"
    return source.select("vector").mapInArrow(lean(run), kinds).repartition(shuffle_width(source.sparkSession), "bucket").mapInArrow(add, kinds)


def centres_of(source: DataFrame, kind: str, counts: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """By dimension, the number of the first ball and the centres of heavy buckets, far enough apart."""
    heavy = [r.bucket for r in counts.where(F.col("n") >= HEAVY).orderBy(F.desc("n"), "bucket").limit(MOST_BALLS).collect()]
    if not heavy:
        return {}
    totals = {r.bucket: np.frombuffer(r.total) for r in sums_of(source, kind, np.sort(np.array(heavy))).collect()}
    kept: dict[int, list[np.ndarray]] = {}
    for bucket in heavy:
        # a centre close to one of more vectors would share its ball
        total = totals.get(bucket)
        if total is None or not 0 < (norm := np.linalg.norm(total)) < math.inf:
            continue
        unit, others = total / norm, kept.setdefault(len(total), [])
        if not others or (np.array(others) @ unit).max() < math.cos(math.radians(5)):
            others.append(unit)
    first, out = 0, {}
    for dimension, units in kept.items():
        out[dimension] = (first, np.array(units))
        first += len(units)
    return out


def balls_of(matrix: np.ndarray, unit: np.ndarray, centres: dict[int, tuple[int, np.ndarray]], threshold: float) -> np.ndarray:
    """The ball of each vector, -1 if it lies in none: all of a ball link, by the triangle inequality."""
    ball = np.full(len(unit), -1, np.int64)
    if unit.shape[1] in centres:
        first, points = centres[unit.shape[1]]
        cosine = unit @ points.T.astype(np.float32)
        near = cosine.argmax(axis=1)
        least = math.cos(max(0.0, math.acos(threshold) / 2 - 1e-6))
        may = np.flatnonzero(cosine[np.arange(len(unit)), near] >= least - 1e-3)
        wide = matrix[may].astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            inside = np.einsum("ij,ij->i", wide, points[near[may]]) / np.linalg.norm(wide, axis=1) >= least
        ball[may[inside]] = first + near[may[inside]]
    return ball


def classes_of(source: DataFrame, kind: str, plan: Plan, centres: dict[int, tuple[int, np.ndarray]], threshold: float) -> DataFrame:
    """(class, copies, digest, ball, codes, vector) per distinct vector."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "vector"):
            _, vectors = plain(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(digests(vectors), pa.binary()), vectors], names=["digest", "vector"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            ball = np.full(len(vectors), -1, np.int64)
            codes = np.zeros((len(vectors), plan.tables + plan.subtables), np.uint16)
            for rows, matrix in by_width(vectors, kind):
                unit = as_unit(matrix)
                ball[rows], codes[rows] = balls_of(matrix, unit, centres, threshold), plan.codes(unit)
            bounds = np.arange(len(vectors) + 1, dtype=np.int32) * (codes.shape[1] * 2)
            codes = pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(bounds), pa.py_buffer(codes.ravel())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ball), codes, vectors], names=["class", "copies", "digest", "ball", "codes", "vector"])

    read_back = source.select("vector").mapInArrow(lean(read), "digest binary, vector binary")
    distinct = read_back.groupBy("digest").agg(F.count("*").alias("copies"), F.first("vector").alias("vector"))
    return distinct.select(F.monotonically_increasing_id().alias("class"), "copies", "digest", "vector").mapInArrow(
        lean(place), "class long, copies long, digest binary, ball long, codes binary, vector binary"
    )


def cell_names(dimension: int, table: int, code: np.ndarray) -> np.ndarray:
    """64-bit names that tell dimension, table and cell."""
    return mix(mix(np.full(len(code), dimension << 32 | table, np.uint64)) + code.astype(np.uint64)).view(np.int64)


def sizes(classes: DataFrame, kind: str, plan: Plan) -> DataFrame:
    """(line, cell, bytes) of each coarse cell."""
    item = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, widths = fixed(batch.column(0), "u2"), batch.column(1).to_numpy()
            for width in np.unique(widths):
                part = codes[widths == width]
                for table in range(plan.tables):
                    total = counts.setdefault((int(width), table), np.zeros(plan.coarse, np.int64))
                    total += np.bincount(part[:, table], minlength=plan.coarse)
                if len(counts) > 4 * plan.tables:  # as many widths
                    yield from told(counts)
                    counts = {}
        yield from told(counts)

    def told(counts: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (width, table), total in counts.items():
            code = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), table)), pa.array(cell_names(width // item, table, code)), pa.array(total[code] * (width + 100))],
                names=["line", "cell", "bytes"],
            )

    counted = classes.select("codes", F.length("vector").alias("width")).mapInArrow(run, "line long, cell long, bytes long")
    return counted.groupBy("line", "cell").agg(F.sum("bytes").alias("bytes"))


def passes(volume: int, blocks: dict[int, dict[int, tuple[int, int]]], tables: int) -> list[list[tuple[int, int]]]:
    """Tables and rounds, (table, round), dealt to passes of bounded volume.

    In round 0 every block meets itself, in round r the block r further on, around the cell.
    ``blocks``: by table and cell, the blocks and bytes of the cells of more than one.
    """
    out: list[list[tuple[int, int]]] = []
    most, filled = max(PASS_BYTES, 1.3 * volume), math.inf
    for table in range(tables):
        cells = list(blocks.get(table, {}).values())
        for turn in range(max([n // 2 for n, _ in cells], default=0) + 1):
            moved = sum(size * (1 if 2 * turn == n else 2) for n, size in cells if 2 * turn <= n) if turn else volume
            if filled + moved > most:
                out.append([])
                filled = 0
            out[-1].append((table, turn))
            filled += moved
    return out


def record(kind: str, plan: Plan, dimension: int) -> np.dtype:
    return np.dtype([
        ("class", "i8"), ("copies", "i8"), ("ball", "i8"), ("block", "i4"), ("codes", "u2", (plan.tables + plan.subtables,)), ("vector", kind, (dimension,))
    ])


def dealt(classes: DataFrame, kind: str, plan: Plan, blocks: dict[int, dict[int, tuple[int, int]]], units: list[tuple[int, int]]) -> DataFrame:
    """Rows by meeting, many in one value: two blocks of a cell, or one with itself."""
    known = {}
    for table, cells in blocks.items():
        names = np.sort(np.array(list(cells), np.int64))
        known[table] = names, np.array([cells[name][0] for name in names.tolist()], np.int64)

    def number_of_blocks(table: int, cell: np.ndarray) -> np.ndarray:
        if table not in known:
            return np.ones(len(cell), np.int64)
        names, count = known[table]
        at = np.minimum(np.searchsorted(names, cell), len(names) - 1)
        return np.where(names[at] == cell, count[at], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in by_width(batch.column(4), kind):
                part = np.empty(len(rows), record(kind, plan, matrix.shape[1]))
                for k, name in enumerate(("class", "copies", "ball")):
                    part[name] = batch.column(k).to_numpy()[rows]
                part["codes"] = fixed(batch.column(3), "u2")[rows]
                part["vector"] = matrix
                spread = mix(part["class"].astype(np.uint64))
                for table, turn in units:
                    cell = cell_names(matrix.shape[1], table, part["codes"][:, table])
                    count = number_of_blocks(table, cell)
                    part["block"] = block = (spread % count.astype(np.uint64)).astype(np.int64)
                    where = [np.arange(len(part))] if not turn else [np.flatnonzero(count >= 2 * turn), np.flatnonzero(count > 2 * turn)]
                    for sign, some in zip((1, -1), where, strict=False):
                        if not len(some):
                            continue
                        other = (block[some] + sign * turn) % count[some]
                        low, high = np.minimum(block[some], other), np.maximum(block[some], other)
                        order = np.lexsort((high, low, cell[some]))
                        some, low, high = some[order], low[order], high[order]
                        keys = np.stack([cell[some], low, high])
                        begin = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
                        end = np.append(begin[1:], len(some))
                        values = [part[some[a:b]].tobytes() for a, b in zip(begin, end, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[0, begin]), pa.array(np.full(len(begin), table)), pa.array(low[begin]), pa.array(high[begin]),
                             pa.array(np.full(len(begin), matrix.shape[1])), pa.array(values, pa.binary())],
                            names=["cell", "line", "low", "high", "dimension", "rows"],
                        )

    return classes.select("class", "copies", "ball", "codes", "vector").mapInArrow(
        lean(run), "cell long, line long, low long, high long, dimension long, rows binary"
    )


def ranges(who: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``who`` with each number from ``begin`` to before ``end``, about PAIRS at once."""
    some = np.flatnonzero(end > begin)
    who, begin = who[some], begin[some]
    count = end[some] - begin
    total = np.cumsum(count)
    at = 0
    while at < len(who):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        n = count[at:stop]
        offset = begin[at:stop] - (total[at:stop] - n - done)
        yield np.repeat(who[at:stop], n), np.repeat(offset, n) + np.arange(total[stop - 1] - done)
        at = stop


def cell_mates(code: np.ndarray, known: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``left`` with ``right`` that share the code, but not the group in which they are ``known`` already.

    If ``left`` is ``right``, each pair comes once.
    """
    key = code.astype(np.int64) << 40 | known
    ours = left[np.argsort(key[left])]
    mine = key[ours]
    if left is right:
        change, cell = np.flatnonzero(np.diff(mine)) + 1, np.flatnonzero(np.diff(mine >> 40)) + 1
        ends = []
        for bounds in (change, cell):
            size = np.diff(np.concatenate([[0], bounds, [len(ours)]]))
            ends.append(np.repeat(np.append(bounds, len(ours)), size))
        for a, b in ranges(ours, *ends):
            yield a, ours[b]
    else:
        theirs = right[np.argsort(key[right])]
        other = key[theirs]
        begin, end = np.searchsorted(other, mine >> 40 << 40), np.searchsorted(other, ((mine >> 40) + 1) << 40)
        for a, b in ranges(ours, begin, np.searchsorted(other, mine)):
            yield a, theirs[b]
        for a, b in ranges(ours, np.searchsorted(other, mine, "right"), end):
            yield a, theirs[b]


def small_cell_mates(code: np.ndarray, rows: np.ndarray, sketch: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``rows`` that share the code and differ in ``limit`` bits of the sketch at most; for cells of few rows.

    Ordered by the size of their cells, rows are compared with the next one, the one after that, and so on.
    """
    if not len(rows):
        return rows, rows
    rows = rows[np.argsort(code[rows], kind="stable")]
    size = np.bincount(code[rows])[code[rows]]
    rows = rows[np.argsort((SMALL - size).astype(np.uint8), kind="stable")]
    larger = len(rows) - np.cumsum(np.bincount(size))  # rows in cells of more than so many
    code, words = code[rows], [word[rows] for word in sketch]
    lefts, rights = [], []
    for step in range(1, len(larger)):
        end = int(larger[step])
        if end <= step:
            break
        close = np.flatnonzero(sum(np.bitwise_count(word[:end - step] ^ word[step:end]) for word in words) <= limit)
        close = close[code[close] == code[close + step]]
        lefts.append(rows[close])
        rights.append(rows[close + step])
    return np.concatenate([rows[:0], *lefts]), np.concatenate([rows[:0], *rights])


class Links:
    """Links and clusters of the rows of a meeting, from pairs in parts."""

    def __init__(self, copies: np.ndarray) -> None:
        self.copies, self.links, self.root = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.held.append((left, right))
        if sum(len(a) for a, _ in self.held) >= PAIRS:
            self.settle()

    def settle(self) -> None:
        if self.held:
            left, right = (np.concatenate(x) for x in zip(*self.held, strict=True))
            n = len(self.copies)
            self.links += (np.bincount(left, self.copies[right], n) + np.bincount(right, self.copies[left], n)).astype(np.int64)
            self.root = clusters(self.root[left], self.root[right], n)[self.root]
            self.held = []


def met(rows: np.ndarray, table: int, low: int, high: int, plan: Plan, threshold: float, recall: float) -> Links:
    """The links of a meeting's rows, ordered by class, that share no earlier table."""
    matrix = np.ascontiguousarray(rows["vector"])
    unit = as_unit(matrix)
    sketch, place = sides(unit), unit @ lines_of(unit.shape[1], LINES, 32)
    del unit
    coarse, fine = np.ascontiguousarray(rows["codes"][:, :table]), np.ascontiguousarray(rows["codes"][:, plan.tables:])
    ball, block = rows["ball"], rows["block"]
    left = np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    reach, least = WIDTH * math.sqrt(2 - 2 * threshold), least_count(LINES, WIDTH, recall)
    most = [most_unlike(64 * (k + 1), threshold, (1 - recall) / 1000) for k in range(len(sketch))]
    found, step = Links(rows["copies"]), max(1, (2 << 20) // (8 * matrix.shape[1]))
    for sub in range(plan.subtables):
        # who shared the table before, or the subtable before, has met
        known = coarse[:, table - 1].astype(np.int64) if table else fine[:, sub - 1].astype(np.int64) if sub else np.arange(len(rows))
        known = np.where(ball >= 0, ball + (1 << 39), known)
        code = np.ascontiguousarray(fine[:, sub])
        first: list[tuple[np.ndarray, np.ndarray]] = []
        one, other = left, right
        if left is right and len(left):
            few = np.bincount(code[left])[code[left]] <= SMALL
            first.append(small_cell_mates(code, left[few], sketch[:2], most[1]))
            one = other = left[~few]
        for a, b in itertools.chain(first, cell_mates(code, known, one, other)):
            strange = (ball[a] < 0) | (ball[a] != ball[b])
            a, b = a[strange], b[strange]
            apart = 0
            for word, limit in zip(sketch, most, strict=True):
                apart = apart + np.bitwise_count(word[a] ^ word[b])
                close = np.flatnonzero(apart <= limit)
                a, b, apart = a[close], b[close], apart[close]
            for earlier in (coarse, fine[:, :sub]):
                if len(a) and earlier.shape[1]:
                    fresh = ~(earlier[a] == earlier[b]).any(axis=1)
                    a, b = a[fresh], b[fresh]
            for at in range(0, len(a), step):
                i, j = a[at:at + step], b[at:at + step]
                enough = (np.abs(place[i] - place[j]) <= reach).sum(axis=1) >= least
                i, j = i[enough], j[enough]
                if not len(i):
                    continue
                x, y = matrix[i].astype(np.float64), matrix[j].astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                some = cosine >= threshold
                if some.any():
                    found.add(i[some], j[some])
    found.settle()
    return found


def verify(parts: DataFrame, kind: str, plan: Plan, threshold: float, recall: float) -> DataFrame:
    """(class, links, root) per vector and meeting with links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (table, low, high, dimension), group in whole_groups(batches, ("cell", "line", "low", "high", "dimension")):
            rows = np.concatenate([np.frombuffer(x.as_buffer(), record(kind, plan, dimension)) for x in group["rows"]])
            del group
            if len(rows) < 2:
                continue
            rows = rows[np.argsort(rows["class"])]
            links = met(rows, table, low, high, plan, threshold, recall)
            some = np.flatnonzero(links.links)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["class"][some]), pa.array(links.links[some]), pa.array(rows["class"][links.root[some]])], names=["class", "links", "root"]
                )

    keys = ("cell", "line", "low", "high", "dimension")
    return parts.repartition(shuffle_width(parts.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(
        lean(run), "class long, links long, root long"
    )


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query shuffled is dropped when it ends: only written tables remain."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def dropping(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(function)
    def run(vectors: DataFrame, *args: object, **kwargs: object) -> DataFrame:
        with shuffles_dropped(vectors.sparkSession):
            return function(vectors, *args, **kwargs)

    return run


@dropping
def near_duplicates(vectors: DataFrame, key: str, vector: str, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    single = vectors.schema[vector].dataType in (ArrayType(FloatType(), True), ArrayType(FloatType(), False))
    kind = "f4" if single else "f8"  # the bytes that the vectors have
    source = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"))
    stored = materialise(identified(source, kind), "vector-digests")
    some = stored.where("digest IS NOT NULL")
    distinct = some.groupBy("digest").agg(F.first("width").alias("width"), F.first("bucket").alias("bucket"))
    counts = materialise(distinct.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("width").alias("bytes")), "vector-buckets")
    rows, volume = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    plan = Plan(rows, volume / max(1, rows), threshold, recall)
    classes = materialise(classes_of(source, kind, plan, centres_of(source, kind, counts), threshold), "vector-classes")
    blocks: dict[int, dict[int, tuple[int, int]]] = {}
    for r in sizes(classes, kind, plan).where(F.col("bytes") > BLOCK_BYTES).collect():
        blocks.setdefault(r.line, {})[r.cell] = (math.ceil(r.bytes / BLOCK_BYTES), r.bytes)
    parts = [
        materialise(verify(dealt(classes, kind, plan, blocks, units), kind, plan, threshold, recall), "vector-links")
        for units in passes(volume + 100 * rows, blocks, plan.tables)
    ]
    balls = classes.where("ball >= 0").select("class", "copies", "ball")
    ball = F.broadcast(balls.groupBy("ball").agg(F.sum("copies").alias("total"), F.min("class").alias("root")))  # MOST_BALLS rows at most
    parts.append(balls.join(ball, "ball").select("class", (F.col("total") - F.col("copies")).alias("links"), "root"))
    found = functools.reduce(DataFrame.union, parts)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = materialise(components(found.select(F.col("class").alias("a"), F.col("root").alias("b")), "vector-components"), "vector-roots")
    of_class = (
        classes.select("class", "copies", "digest").join(links, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    )
    placed = materialise(
        some.select("vec_id", "digest").join(of_class, "digest").select(
            "vec_id", F.coalesce("root", "class").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ), "vector-placed",
    )
    least = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    grouped = placed.join(least, "root").select("vec_id", "n_links", "component_id")
    alone = stored.where("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
