"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised apart, each by ``K`` centroids, so ``K * K`` cells hold
the vectors. A query walks through pairs of centroids by the sum of both halves' squared
distances: a heap holds the frontier, and a pair enters it once both its predecessors have been
taken. It stops when the cells taken hold ``budget`` vectors; these are ranked by their exact
Euclidean distance, in double precision.

The centroids are fitted on a bounded sample (``SAMPLE`` vectors a centroid, at most ``MOST``
centroids a half); every vector is indexed. The budget follows from the recall: the nearest
vectors of ``TRIALS`` of them are found by looking at all vectors, and the budget is what the
target share of them needs. On data without any structure that is a large part of the table.

Equal vectors are one entry, that remembers its ``k + 1`` least ids: more can never be among the
nearest. Cells are packed in blocks; a cell of more than a block is cut into several. Queries
travel to each block once, with the cells they look into, and queries of one block are sliced.
So a task holds one block, whatever a cell or a group of copies holds.

Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do
rows without id. Vectors of different lengths never meet: every length has its own centroids.
Repeated rows count once; an id of several vectors is several rows, all of them its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.store import materialise, shuffle_width

CELL_ROWS, MOST, SAMPLE, ROUNDS = 16, 1024, 32, 10
TRIALS, RECALL = 128, 0.97
BLOCK_BYTES, SLICE_QUERIES = 2 << 20, 1 << 16


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, dim) of the rows that take part."""
    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = "vec_id IS NOT NULL AND size(vector) > 0 AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
    return found.where(f"{fine} AND exists(vector, x -> x != 0)").withColumn("dim", F.size("vector"))


def entries_of(rows: DataFrame, keep: int) -> DataFrame:
    """(entry, vector, dim, ids): distinct vectors with their ``keep`` least ids; entry is the least."""
    distinct = rows.dropDuplicates(["vec_id", "vector"])
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = distinct.withColumn("_k", place).where(F.col("_k") <= keep)  # limited before the shuffle, too
    return few.groupBy("vector", "dim").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("entry"), "vector", "dim", "ids"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points * points).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * points @ centres.T


def fit(points: np.ndarray, count: int) -> np.ndarray:
    """Centroids by Lloyd's rounds, from evenly spaced points; an empty one keeps its place."""
    centres = points[np.linspace(0, len(points) - 1, count).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = _squares(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=count)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _cells(points: np.ndarray, book: dict) -> np.ndarray:
    half = book["half"]
    first = _squares(points[:, :half], book["first"]).argmin(1)
    return first * len(book["second"]) + _squares(points[:, half:], book["second"]).argmin(1)


def walk(query: np.ndarray, book: dict) -> Iterator[int]:
    """All cells by the summed distance of their two centroids."""
    half, width = book["half"], len(book["second"])
    one = _squares(query[None, :half], book["first"])[0]
    two = _squares(query[None, half:], book["second"])[0]
    rows, columns = one.argsort(kind="stable"), two.argsort(kind="stable")
    a, b, rows, columns = one[rows].tolist(), two[columns].tolist(), rows.tolist(), columns.tolist()
    taken = [0] * len(a)  # how many pairs of each row: the pairs taken are always a staircase
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield rows[i] * width + columns[j]
        taken[i] = j + 1
        if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and taken[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    dims = batch["dim"].to_numpy()
    table = pa.Table.from_batches([batch])
    for dim in np.unique(dims).tolist():
        yield dim, table.filter(pa.array(dims == dim))


def _nearest(queries: np.ndarray, points: np.ndarray, names: np.ndarray, k: int, allowed: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its k nearest allowed points and their exact distances.

    Products select, with room for their rounding; differences decide; ties go to smaller names.
    """
    rough = _squares(queries, points)
    if allowed is not None:
        rough[~allowed] = np.inf
    slack = 1e-9 * ((queries * queries).sum(1) + (points * points).sum(1).max(initial=0.0))
    for q in range(len(queries)):
        row = rough[q]
        if len(row) > k:
            limit = np.partition(row, k - 1)[k - 1]
            some = np.flatnonzero(row <= limit + slack[q])
            some = some[np.isfinite(row[some])]
        else:
            some = np.flatnonzero(np.isfinite(row))
        exact = np.sqrt(((points[some] - queries[q]) ** 2).sum(1))
        best = np.lexsort((names[some], exact))[:k]
        yield some[best], exact[best]


def build(rows: DataFrame, id_col: str, vector_col: str, k: int = 10, recall: float = RECALL) -> dict:
    """Index all rows for searches of up to ``k`` neighbours.

    Returns ``entries`` (dim, cell, block, entry, vector, ids), a written table, and ``books``:
    per vector length its centroids, the sizes and blocks of its cells, and its budget.
    """
    spark = rows.sparkSession
    entries = materialise(entries_of(usable(rows, id_col, vector_col), k + 1), "multiindex-entries")
    totals = {r.dim: r.n for r in entries.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    books = {}
    sizes = {dim: max(1, min(MOST, round(math.sqrt(n / CELL_ROWS)))) for dim, n in totals.items()}
    most = max([TRIALS, *(SAMPLE * size for size in sizes.values())])
    hashed = F.xxhash64("entry")
    # twice as many as wanted, by hash, before any are compared: what meets in one task never grows with the table
    share = F.lit(1.0)
    for dim, n in totals.items():
        share = F.when(F.col("dim") == dim, min(1.0, 2 * most / n)).otherwise(share)
    few = entries.select("entry", "vector", "dim").where(F.pmod(hashed, F.lit(1 << 30)) < share * (1 << 30))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.pmod(hashed, F.lit(1 << 30)), "entry"))
    sample = few.withColumn("_k", place).where(F.col("_k") <= most)
    drawn: dict[int, list] = {}
    for row in sample.orderBy("dim", "_k").collect():
        drawn.setdefault(row.dim, []).append((row.entry, row.vector))
    for dim, found in drawn.items():
        points = np.array([v for _, v in found[:max(SAMPLE * sizes[dim], 1)]])
        half = dim // 2
        books[dim] = {
            "half": half, "first": fit(points[:, :half], min(sizes[dim], len(points)) if half else 1),
            "second": fit(points[:, half:], min(sizes[dim], len(points))),
            "trials": np.array([v for _, v in found[:TRIALS]]), "names": np.array([e for e, _ in found[:TRIALS]]),
        }
    shared = spark.sparkContext.broadcast(books)

    def quantised(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dim, some in _by_dim(batch):
                cells = pa.array(_cells(_matrix(some["vector"]), shared.value[dim]), pa.int64())
                for part in some.append_column("cell", cells).to_batches():
                    yield part

    fields = "entry bigint, vector array<double>, dim int, ids array<bigint>, cell bigint"
    placed = materialise(entries.select("entry", "vector", "dim", "ids").mapInArrow(quantised, fields), "multiindex-cells")
    shared.unpersist()
    for dim, book in books.items():
        book["sizes"] = np.zeros(len(book["first"]) * len(book["second"]), np.int64)
    for row in placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect():
        books[row.dim]["sizes"][row.cell] = row.n
    for dim, book in books.items():
        _pack(book, max(16, BLOCK_BYTES // (8 * dim)))
    _calibrate(placed, books, k, recall)
    shared = spark.sparkContext.broadcast({d: {x: b[x] for x in ("block", "blocks")} for d, b in books.items()})

    def dealt(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dim, some in _by_dim(batch):
                book, cell, salt = shared.value[dim], some["cell"].to_numpy(), some["salt"].to_numpy()
                block = pa.array(book["block"][cell] + salt % book["blocks"][cell], pa.int64())
                for part in some.drop_columns(["salt"]).append_column("block", block).to_batches():
                    yield part

    salted = placed.withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(1 << 40)))
    return {"entries": materialise(salted.mapInArrow(dealt, f"{fields}, block bigint"), "multiindex"), "books": books, "k": k}


def _pack(book: dict, rows: int) -> None:
    """First block and number of blocks of every cell: small cells share, large ones are cut."""
    sizes = book["sizes"]
    large = sizes > rows
    before = np.cumsum(np.where(large, 0, sizes)) - np.where(large, 0, sizes)
    block = before // rows
    pieces = np.where(large, -(-sizes // rows), 1)
    shared = int(block.max(initial=0)) + 1
    own = np.cumsum(np.where(large, pieces, 0)) - np.where(large, pieces, 0)
    book["block"], book["blocks"] = np.where(large, shared + own, block), pieces


def _calibrate(placed: DataFrame, books: dict, k: int, recall: float) -> None:
    """Sets every book's budget: so many vectors must be looked at for the target recall."""
    spark = placed.sparkSession
    shared = spark.sparkContext.broadcast({dim: (book["trials"], book["names"]) for dim, book in books.items()})

    def best(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in stream:
            for dim, some in _by_dim(batch):
                trials, names = shared.value[dim]
                entries, cells = some["entry"].to_numpy(), some["cell"].to_numpy()
                mine = held.setdefault(dim, [[] for _ in trials])
                others = entries[None] != names[:, None]
                for t, (at, exact) in enumerate(_nearest(trials, _matrix(some["vector"]), entries, k, others)):
                    mine[t] = sorted([*mine[t], *zip(exact.tolist(), entries[at].tolist(), cells[at].tolist(), strict=True)])[:k]
        rows = [(dim, t, *near) for dim, mine in held.items() for t, found in enumerate(mine) for near in found]
        columns = zip(*rows, strict=True) if rows else [[] for _ in range(5)]
        types = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], names=["dim", "trial", "score", "entry", "cell"])

    found = placed.select("entry", "vector", "dim", "cell").mapInArrow(best, "dim int, trial int, score double, entry bigint, cell bigint")
    order = F.row_number().over(Window.partitionBy("dim", "trial").orderBy("score", "entry"))
    wanted: dict = {}
    for row in found.withColumn("_k", order).where(F.col("_k") <= k).collect():  # k rows a trial
        wanted.setdefault(row.dim, {}).setdefault(row.trial, []).append(row.cell)
    shared.unpersist()
    for dim, book in books.items():
        needed = []
        for trial, cells in wanted.get(dim, {}).items():
            looked, left = 0, set(cells)
            for cell in walk(book["trials"][trial], book):
                looked += int(book["sizes"][cell])
                if cell in left:
                    left.remove(cell)
                    needed += [looked] * cells.count(cell)
                    if not left:
                        break
        needed.sort()
        book["budget"] = max(4 * k, needed[min(len(needed) - 1, math.ceil(recall * len(needed)))] if needed else 0)


def search(index: dict, queries: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every query; ties to smaller ids.

    Rows of a query's own id are never its neighbours. Queries of a length that the index does
    not hold find nothing.
    """
    if k > index["k"]:
        raise ValueError(f"the index keeps ids for up to {index['k']} neighbours")
    spark, entries = queries.sparkSession, index["entries"]
    asked = usable(queries, id_col, vector_col).dropDuplicates(["vec_id", "vector"])
    groups = materialise(asked.groupBy("vector", "dim").agg(F.min("vec_id").alias("q")), "multiindex-queries")
    shared = spark.sparkContext.broadcast({
        d: {x: b[x] for x in ("half", "first", "second", "sizes", "block", "blocks", "budget")} for d, b in index["books"].items()
    })

    def routed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dim, some in _by_dim(batch):
                book = shared.value.get(dim)
                if book is None:
                    continue
                points, found = _matrix(some["vector"]), ([], [], [])
                for at, point in enumerate(points):
                    looked, cells = 0, []
                    for cell in walk(point, book):
                        if size := int(book["sizes"][cell]):
                            cells.append(cell)
                            looked += size
                            if looked >= book["budget"]:
                                break
                    visits: dict = {}
                    for cell in cells:
                        for piece in range(int(book["blocks"][cell])):
                            visits.setdefault(int(book["block"][cell]) + piece, []).append(cell)
                    for block, inside in visits.items():
                        for column, value in zip(found, (at, block, inside), strict=True):
                            column.append(value)
                taken = some.select(["q", "vector", "dim"]).take(pa.array(found[0], pa.int64()))
                taken = taken.append_column("block", pa.array(found[1], pa.int64())).append_column("cells", pa.array(found[2], pa.list_(pa.int64())))
                for part in taken.to_batches():
                    yield part

    fields = "q bigint, vector array<double>, dim int, block bigint, cells array<bigint>"
    visits = materialise(groups.select("q", "vector", "dim").mapInArrow(routed, fields), "multiindex-visits")
    slices = visits.groupBy("dim", "block").agg(F.ceil(F.count("*") / SLICE_QUERIES).cast("int").alias("slices"))
    asking = visits.join(slices, ["dim", "block"]).select(
        "dim", "block", F.pmod(F.xxhash64("q"), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"),
        F.col("q").alias("name"), "vector", "cells",
    )
    held = entries.join(slices, ["dim", "block"]).select(
        "dim", "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"),
        F.col("entry").alias("name"), "vector", F.array("cell").alias("cells"),
    )
    keys = ["dim", "block", "slice"]
    dealt = held.union(asking).repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys, "kind")
    near = dealt.mapInArrow(_ranked(k + 1), "q bigint, entry bigint, score double")
    best = near.withColumn("_k", F.row_number().over(Window.partitionBy("q").orderBy("score", "entry"))).where(F.col("_k") <= k + 1)
    ids = best.join(entries.select("entry", "ids"), "entry").select("q", "score", F.explode("ids").alias("vec_id"))
    few = ids.withColumn("_k", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).where(F.col("_k") <= k + 1)
    of = asked.join(groups.select("vector", "q"), "vector").select(F.col("vec_id").alias("query_id"), "q")
    mine = of.join(few.drop("_k"), "q").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("score", "vec_id"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _ranked(k: int):
    """Of every block its entries, then the queries that look into it, as they come."""

    def ranked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, points = None, []
        for batch in stream:
            columns = [batch[c].to_numpy() for c in ("dim", "block", "slice", "kind")]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if batch.num_rows else []
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                *key, kind = (int(c[a]) for c in columns)
                part = batch.slice(a, b - a)
                names = part["name"].to_numpy()
                if key != now:
                    now, points, cells, entries = key, [], [], []
                if kind == 0:
                    points.append(_matrix(part["vector"]))
                    cells.append(part["cells"].flatten().to_numpy())
                    entries.append(names)
                    continue
                if len(points) > 1:
                    points, cells, entries = ([np.concatenate(x)] for x in (points, cells, entries))
                known, place = np.unique(cells[0], return_inverse=True)
                for low in range(0, len(names), 256):
                    some = part.slice(low, 256)
                    open_ = np.zeros((some.num_rows, len(known)), bool)
                    lengths = np.diff(some["cells"].offsets.to_numpy())
                    open_[np.repeat(np.arange(some.num_rows), lengths), np.searchsorted(known, some["cells"].flatten().to_numpy())] = True
                    found = list(_nearest(_matrix(some["vector"]), points[0], entries[0], k, open_[:, place]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(names[low:low + 256], [len(at) for at, _ in found])),
                        pa.array(np.concatenate([entries[0][at] for at, _ in found])), pa.array(np.concatenate([s for _, s in found])),
                    ], names=["q", "entry", "score"])

    return ranked
