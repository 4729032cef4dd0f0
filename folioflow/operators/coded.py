"""A stored vector index: inverted lists by cell, each vector as a few bytes beside itself.

    model/             centroids of the cells (part -1) and one codebook per stretch of values
    lists/cell=C/      vec_id, codes (a byte per stretch), error, embedding

A vector belongs to the cell of its nearest centroid; what remains is cut into stretches, and
each becomes the number of its nearest codebook entry. A search reads identities and codes of
the probed cells only, adds up distances from small tables, and reads the full vectors of the
rows that may win. ``error``, the distance between a vector and what its codes stand for,
bounds how far a coded distance can be off, so a search can also be told to lose nothing.

One index holds the vectors of one length. Vectors that are NULL, of another length, or hold
NULL or non-finite values, or no identity, are not part of it; as queries they find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import similarity as S

N_CODES = 256
SAMPLE_ROWS = 20_000  # codebooks are learned from about so many vectors, picked by hash
STEPS = 12
SLACK = 1e-9
MODEL = "part int, code int, dim int, values array<double>"
LISTED = "vec_id bigint, cell int, codes binary, error double, embedding array<double>"
CANDIDATE = "query_id bigint, vec_id bigint, cell int, distance double"


class Index(NamedTuple):
    path: str
    dim: int
    cells: np.ndarray  # cells x dim
    books: np.ndarray  # stretches x codes x values of a stretch, padded with zeros


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size("embedding") == dim) & fine)


def _stretches(matrix: np.ndarray, parts: int) -> np.ndarray:
    """rows x stretches x values, padded with zeros, which change no distance."""
    width = math.ceil(matrix.shape[1] / parts)
    padded = np.pad(matrix, ((0, 0), (0, parts * width - matrix.shape[1])))
    return padded.reshape(len(matrix), parts, width)


def _closest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    step = max(1, S.BLOCK_VALUES // len(centres))
    size = (centres * centres).sum(axis=1)
    for at in range(0, len(points), step):
        out[at : at + step] = np.argmin(size - 2 * (points[at : at + step] @ centres.T), axis=1)
    return out


def codebook(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Lloyd's centres; an entry that loses all its points moves to the point worst served."""
    different = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = different[rng.permutation(len(different))[:codes]]
    if len(different) <= codes:
        return centres
    for _ in range(STEPS):
        mine = _closest(points, centres)
        count = np.bincount(mine, minlength=codes)
        total = np.stack([np.bincount(mine, column, codes) for column in points.T], axis=1)
        gap = ((points - centres[mine]) ** 2).sum(axis=1)
        centres = total / np.maximum(count, 1)[:, None]
        lost = np.flatnonzero(count == 0)
        centres[lost] = points[np.argsort(-gap, kind="stable")[: len(lost)]]
    return centres


def train_books(vectors: DataFrame, cells: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Codebooks, each learned in a task of its own from a sample bounded by ``SAMPLE_ROWS``."""
    rows = vectors.count()
    share = 1.0 if rows <= SAMPLE_ROWS else SAMPLE_ROWS / rows
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = S._matrix(batch.column("embedding"), cells.shape[1])
            pieces = _stretches(matrix - cells[_closest(matrix, cells)], parts)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.tile(np.arange(parts, dtype=np.int32), len(matrix))),
                "piece": pa.array(list(pieces.reshape(-1, pieces.shape[2])), pa.list_(pa.float64())),
            })

    def learn(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        book = codebook(np.stack(table["piece"].to_numpy()), N_CODES, seed + part)
        return pa.table({"part": pa.array([part] * len(book), pa.int32()),
                         "code": pa.array(range(len(book)), pa.int32()),
                         "values": pa.array(list(book), pa.list_(pa.float64()))})

    learned = (
        sample.select("embedding").mapInArrow(cut, "part int, piece array<double>")
        .groupBy("part").applyInArrow(learn, "part int, code int, values array<double>")
        .collect()  # at most parts x 256 rows
    )
    width = math.ceil(cells.shape[1] / parts)
    books = np.full((parts, N_CODES, width), np.inf)
    for row in learned:
        books[row["part"], row["code"]] = row["values"]
    return books


def _encode(cells: np.ndarray, books: np.ndarray) -> Callable:
    used = [book[np.isfinite(book).all(axis=1)] for book in books]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = S._matrix(batch.column("embedding"), cells.shape[1])
            cell = _closest(matrix, cells)
            pieces = _stretches(matrix - cells[cell], len(books))
            codes = np.empty((len(matrix), len(books)), np.uint8)
            gap = np.zeros(len(matrix))
            for part, book in enumerate(used):
                codes[:, part] = _closest(pieces[:, part], book)
                gap += ((pieces[:, part] - book[codes[:, part]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cell.astype(np.int32)),
                 pa.array([row.tobytes() for row in codes], pa.binary()),
                 pa.array(np.sqrt(gap)), batch.column("embedding")],
                names=["vec_id", "cell", "codes", "error", "embedding"],
            )

    return encode


def _cells(rows: DataFrame, n_cells: int, seed: int) -> np.ndarray:
    """Trained centroids; where there are no more different vectors than cells, those themselves."""
    if rows.select(F.approx_count_distinct(F.xxhash64("embedding"))).first()[0] <= 2 * n_cells:
        few = rows.select("embedding").distinct().limit(n_cells + 1).collect()
        if len(few) <= n_cells:
            return np.array(sorted(row["embedding"] for row in few))
    return S.train_cells(rows, n_cells, seed)


def build(vectors: DataFrame, path: str, dim: int, n_cells: int, parts: int, seed: int = 7) -> Index:
    """Train on and store ``(vec_id, embedding)``, every usable vector of length ``dim``.

    Rows are rebalanced by cell as they are written, so a cell with a third of all vectors
    becomes many files and small cells become one.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, dim).where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")
    )
    if rows.isEmpty():
        cells, books = np.zeros((1, dim)), np.zeros((parts, 1, math.ceil(dim / parts)))
    else:
        cells = _cells(rows, n_cells, seed)
        books = train_books(rows, cells, parts, seed)
    model = [(-1, i, dim, [float(x) for x in c]) for i, c in enumerate(cells)] + [
        (part, code, dim, [float(x) for x in entry])
        for part, book in enumerate(books) for code, entry in enumerate(book) if np.isfinite(entry).all()
    ]
    spark.createDataFrame(model, MODEL).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    (
        rows.mapInArrow(_encode(cells, books), LISTED).hint("rebalance", F.col("cell"))
        .write.mode("overwrite").partitionBy("cell").parquet(f"{path}/lists")
    )
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Index:
    """A stored index; its model is bounded by the cells and 256 entries a stretch."""
    rows = spark.read.schema(MODEL).parquet(f"{path}/model").collect()
    dim = rows[0]["dim"]
    cells = np.array([r["values"] for r in sorted(rows, key=lambda r: r["code"]) if r["part"] < 0])
    parts = 1 + max(r["part"] for r in rows)
    width = math.ceil(dim / parts)
    books = np.full((parts, N_CODES, width), np.inf)
    for row in rows:
        if row["part"] >= 0:
            books[row["part"], row["code"]] = row["values"]
    return Index(path, dim, cells, books)


def read_lists(spark: SparkSession, index: Index, cells: list[int]) -> DataFrame:
    rows = spark.read.schema(LISTED).parquet(f"{index.path}/lists")
    return rows.where(F.col("cell").isin(cells))


def probe_order(index: Index, point: np.ndarray) -> np.ndarray:
    gap = index.cells - point
    return np.argsort((gap * gap).sum(axis=1), kind="stable")


def _scan(index: Index, ids: list[int], points: np.ndarray, probes: int, k: int, candidates: int | None) -> Callable:
    """Candidates per query from codes alone, in memory bounded by the queries."""
    cells, books = index.cells, index.books
    asking: dict[int, list[int]] = {}
    for q, point in enumerate(points):
        for cell in probe_order(index, point)[:probes]:
            asking.setdefault(int(cell), []).append(q)
    part_of = np.arange(len(books))

    def rows(q: np.ndarray, vec_ids: np.ndarray, cell: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.array(ids, np.int64)[q]), "vec_id": pa.array(vec_ids.astype(np.int64)),
            "cell": pa.array(cell.astype(np.int32)), "distance": pa.array(distance.astype(float)),
        })

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        highs = [np.empty(0) for _ in ids]
        for batch in batches:
            vec_ids, cell_of, error = (
                batch.column(name).to_numpy(zero_copy_only=False) for name in ("vec_id", "cell", "error")
            )
            if not len(vec_ids):
                continue
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(vec_ids), -1)
            for cell in np.unique(cell_of):
                here = np.flatnonzero(cell_of == cell)
                mine, off = codes[here], error[here]
                for q in asking.get(int(cell), ()):
                    rest = _stretches((points[q] - cells[cell])[None], len(books))[0]
                    table = ((rest[:, None, :] - books) ** 2).sum(axis=2)
                    distance = np.sqrt(table[part_of, mine].sum(axis=1))
                    if candidates is None:
                        highs[q] = np.sort(np.concatenate([highs[q], distance + off]))[:k]
                        bound = highs[q][-1] + SLACK if len(highs[q]) == k else np.inf
                        may = np.flatnonzero(distance - off <= bound)
                        yield rows(np.full(len(may), q), vec_ids[here[may]], cell_of[here[may]], distance[may])
                    else:
                        d, v, c = (np.concatenate(pair) for pair in zip(
                            best[q], (distance, vec_ids[here], cell_of[here])))
                        keep = np.lexsort((v, d))[:candidates]
                        best[q] = (d[keep], v[keep], c[keep])
        if candidates is not None:
            for q, (d, v, c) in enumerate(best):
                yield rows(np.full(len(d), q), v, c, d)

    return scan


def _search(spark: SparkSession, index: Index, asked: list, k: int, probes: int, candidates: int | None) -> DataFrame:
    """Search for at most ``MAX_SHIPPED_QUERIES`` collected queries."""
    ids = [int(row["query_id"]) for row in asked]
    points = np.array([row["embedding"] for row in asked], dtype=float).reshape(len(ids), index.dim)
    probed = sorted({int(c) for p in points for c in probe_order(index, p)[:probes]})
    lists = read_lists(spark, index, probed)
    may = lists.select("vec_id", "cell", "codes", "error").mapInArrow(
        _scan(index, ids, points, probes, k, candidates), CANDIDATE
    )
    if candidates is not None:
        may = S._top(may, candidates)
    may = may.select("query_id", "vec_id", "cell").distinct()
    queries = spark.createDataFrame(
        [(i, [float(x) for x in p]) for i, p in zip(ids, points)], "query_id bigint, point array<double>"
    )
    gap = F.zip_with("embedding", "point", lambda x, y: (x - y) * (x - y))
    return (
        may.join(lists.select("cell", "vec_id", "embedding"), ["cell", "vec_id"])
        .join(F.broadcast(queries), "query_id")
        .select("query_id", "vec_id", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda a, x: a + x)).alias("distance"))
    )


def search(
    index: Index, queries: DataFrame, k: int, probes: int, candidates: int | None = None
) -> DataFrame:
    """The ``k`` nearest of the index for each ``(query_id, embedding)``, nearest first.

    Compared are the ``probes`` nearest cells, and only those are read. With ``candidates``
    so many rows a query, the best by codes, are looked at in full; without, all rows whose
    codes cannot rule them out, so that nothing in the probed cells is lost (all of them
    probed, the result is exact). More queries than a task carries take one pass over the
    codes for each 2,048 of them.
    """
    spark = queries.sparkSession
    rows = usable(queries.select(F.col("query_id").cast("bigint"), F.col("embedding").cast("array<double>")), index.dim)
    if candidates is not None and candidates < k:
        raise ValueError("fewer candidates than neighbours")
    blocks = math.ceil(rows.count() / S.MAX_SHIPPED_QUERIES)
    if not blocks:
        return S._top(spark.createDataFrame([], S.FOUND), k)
    found = []
    for block in range(2 * blocks if blocks > 1 else 1):  # twice as many: hashes spread unevenly
        mine = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("query_id"), F.lit(2 * blocks)) == block)
        asked = mine.collect()
        if asked:
            found.append(_search(spark, index, asked, k, probes, candidates))
    return S._top(reduce(DataFrame.unionByName, found), k)


def calibrate(spark: SparkSession, index: Index, k: int, target: float, sample: int = 64) -> int:
    """The fewest probes whose cells hold the share ``target`` of the nearest neighbours.

    Measured on ``sample`` vectors of the index, picked by hash, against all its vectors.
    """
    stored = spark.read.schema(LISTED).parquet(f"{index.path}/lists").select("vec_id", "cell", "embedding")
    picked = stored.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    asked = picked.select(F.col("vec_id").alias("query_id"), "embedding")
    near = S.nearest(stored.select("vec_id", "embedding"), asked, k + 1).where("query_id <> vec_id")
    rows = near.join(stored.select("vec_id", "cell"), "vec_id").select("query_id", "cell").collect()
    if not rows:
        return 1
    order = {r["query_id"]: np.argsort(probe_order(index, np.array(r["embedding"]))) for r in asked.collect()}
    place = np.sort([order[r["query_id"]][r["cell"]] for r in rows])
    return int(place[math.ceil(target * len(place)) - 1]) + 1


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Of each query's exact neighbours, how many were found: ``(query_id, wanted, hits)``."""
    hit = found.select("query_id", "vec_id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "vec_id"], "left").groupBy("query_id").agg(
        F.count("*").alias("wanted"), F.count("hit").alias("hits")
    )
