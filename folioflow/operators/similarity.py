"""Nearest vectors by Euclidean distance: exact, or within the nearest cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_SHIPPED_QUERIES = 2048  # at most this many query vectors travel inside a task
MAX_CELLS = 4096
ROWS_PER_GROUP = 50_000
BLOCK_VALUES = 4_000_000
FOUND = "query_id bigint, vec_id bigint, distance double"


def mean_vectors(vectors: DataFrame, by: str) -> DataFrame:
    """Mean vector per group: ``(query_id, embedding)``; partial sums before the shuffle."""
    return (
        vectors.groupBy(F.col(by).cast("bigint").alias("query_id"))
        .agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("m"))
        .select("query_id", vector_to_array("m").alias("embedding"))
    )


def train_cells(vectors: DataFrame, n_cells: int, seed: int = 7, steps: int = 10) -> np.ndarray:
    """Cell centroids. The model is ``n_cells`` vectors, whatever the table's size."""
    if n_cells > MAX_CELLS:
        raise ValueError(f"at most {MAX_CELLS} cells")
    data = vectors.select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = KMeans(k=n_cells, seed=seed, maxIter=steps).fit(data)
    return np.array(model.clusterCenters())


def nearest_cells(vector: Column, centroids: np.ndarray, n: int) -> Column:
    """The ``n`` cells closest to each vector, nearest first."""
    if len(centroids) > MAX_CELLS:
        raise ValueError(f"at most {MAX_CELLS} cells")

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cells(batch: pa.Array) -> pa.Array:
        out = []
        step = max(1, BLOCK_VALUES // centroids.size)
        for at in range(0, len(batch), step):
            block = _matrix(batch.slice(at, step), centroids.shape[1])
            gap = block[:, None, :] - centroids[None, :, :]
            order = np.argsort((gap * gap).sum(axis=2), axis=1, kind="stable")
            out.extend(order[:, :n].astype(np.int32))
        return pa.array(out, type=pa.list_(pa.int32()))

    return cells(vector)


def assign_cells(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    return vectors.withColumn("cell", nearest_cells(F.col("embedding"), centroids, 1)[0])


def centroids_of(rows: DataFrame) -> np.ndarray:
    """Centroids from a table of ``(query_id, embedding)`` that must not exceed the cells."""
    found = rows.select("query_id", "embedding").limit(MAX_CELLS + 1).collect()
    if len(found) > MAX_CELLS:
        raise ValueError(f"at most {MAX_CELLS} cells")
    return np.array([row["embedding"] for row in sorted(found)])


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of one dimension as a matrix, without a Python object per value."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(float)


def _closest(ids: np.ndarray, matrix: np.ndarray, query: np.ndarray, k: int) -> list[tuple]:
    gap = matrix - query
    distance = np.sqrt((gap * gap).sum(axis=1))
    if len(ids) > k:
        # Everything tied with the k-th smallest distance competes by id.
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
        ids, distance = ids[near], distance[near]
    order = np.lexsort((ids, distance))[:k]
    return [(float(distance[i]), int(ids[i])) for i in order]


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _scan(queries: Sequence, k: int, by_cell: bool) -> Callable:
    """Batch function keeping the best ``k`` per query of a whole partition.

    A query meets the vectors of its own dimension only.
    """
    ids = [q["query_id"] for q in queries]
    points = [np.array(q["embedding"], dtype=float) for q in queries]
    dims = sorted({len(point) for point in points})
    probes = [set(q["cells"]) for q in queries] if by_cell else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in ids]
        for batch in batches:
            size = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for dim in dims:
                same = np.flatnonzero(size == dim)
                if not len(same):
                    continue
                part = batch if len(same) == len(size) else batch.take(pa.array(same))
                matrix = _matrix(part.column("embedding"), dim)
                vec_ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                cells = part.column("cell").to_numpy(zero_copy_only=False) if by_cell else None
                for i, point in enumerate(points):
                    if len(point) != dim:
                        continue
                    if cells is None:
                        near = _closest(vec_ids, matrix, point, k)
                    else:
                        rows = np.flatnonzero(np.isin(cells, list(probes[i])))
                        near = _closest(vec_ids[rows], matrix[rows], point, k)
                    best[i] = sorted(best[i] + near)[:k]
        rows = [(q, v, d) for q, hits in zip(ids, best) for d, v in hits]
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array([r[0] for r in rows], pa.int64()),
            "vec_id": pa.array([r[1] for r in rows], pa.int64()),
            "distance": pa.array([r[2] for r in rows], pa.float64()),
        })

    return scan


def _match(k: int) -> Callable:
    def match(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(vectors) and len(queries):
            matrix = np.array(vectors["embedding"].tolist(), dtype=float)
            ids = vectors["vec_id"].to_numpy()
            for query_id, point in zip(queries["query_id"], queries["point"]):
                near = _closest(ids, matrix, np.asarray(point, dtype=float), k)
                rows += [(query_id, v, d) for d, v in near]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "distance"]).astype(
            {"query_id": "int64", "vec_id": "int64", "distance": "float64"}
        )

    return match


def _slices(rows: DataFrame, limit: int) -> DataFrame:
    """How many groups of at most about ``limit`` rows each cell of each dimension needs."""
    return rows.groupBy("cell", "dim").agg(F.ceil(F.count("*") / limit).cast("int").alias("n"))


def _grid(vectors: DataFrame, queries: DataFrame, k: int, max_queries: int) -> DataFrame:
    """Many queries: meet in groups ``(cell, dim, slice, block)`` bounded on both sides.

    A cell with a third of all vectors is cut into as many slices as its count asks
    for, so no task gathers it; each group emits only its best ``k`` per query.
    """
    vectors, queries = (rows.withColumn("dim", F.size("embedding")) for rows in (vectors, queries))
    slices, blocks = _slices(vectors, ROWS_PER_GROUP), _slices(queries, max_queries)
    keys, cell = ["cell", "dim", "slice", "block"], ["cell", "dim"]
    left = (
        vectors.join(slices, cell)
        .withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.col("n")))
        .drop("n")
        .join(blocks, cell)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select(*[F.col(c).cast("bigint") for c in keys], "vec_id", "embedding")
    )
    right = (
        queries.join(blocks, cell)
        .withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("n")))
        .drop("n")
        .join(slices, cell)
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        # columns of its own: the queries may be picked from the very frame of the vectors
        .select(*[F.col(c).cast("bigint") for c in keys],
                F.col("query_id").alias("query_id"), F.col("embedding").alias("point"))
    )
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(_match(k), FOUND)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    max_queries: int = MAX_SHIPPED_QUERIES,
    stored_cells: bool = True,
) -> DataFrame:
    """The ``k`` nearest rows of ``(vec_id, embedding)`` for each ``(query_id, embedding)``.

    With a ``cell`` on the vectors and an array ``cells`` on the queries, only probed
    cells are compared; where the vectors are stored by cell, the others are not even
    read. (A filter on a cell derived on the fly would derive it twice.) A query set of
    proven small size travels to the vectors, which then never shuffle; a larger one
    meets them in bounded groups. Either way a query meets vectors of its own dimension.
    """
    by_cell = "cell" in vectors.columns and "cells" in queries.columns
    columns = ["query_id", "embedding"] + (["cells"] if by_cell else [])
    queries, vectors = (rows.where(F.size("embedding") > 0) for rows in (queries, vectors))
    shipped = queries.select(*columns).limit(max_queries + 1).collect()
    if not shipped:
        empty = queries.select(
            F.col("query_id").cast("bigint"),
            F.lit(None).cast("bigint").alias("vec_id"),
            F.lit(None).cast("double").alias("distance"),
        )
        return _top(empty, k)
    if len(shipped) <= max_queries:
        rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding",
                              *(["cell"] if by_cell else []))
        if by_cell and stored_cells:
            probed = sorted({c for q in shipped for c in q["cells"]})
            rows = rows.where(F.col("cell").isin(probed))
        found = rows.mapInArrow(_scan(shipped, k, by_cell), FOUND)
    else:
        if by_cell:
            queries = queries.withColumn("cell", F.explode("cells"))
        else:
            vectors = vectors.withColumn("cell", F.lit(0))
            queries = queries.withColumn("cell", F.lit(0))
        found = _grid(vectors, queries, k, max_queries)
    return _top(found, k)


def nearest_in_cells(
    vectors: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int, probes: int
) -> DataFrame:
    """Approximate search: compare each query with its ``probes`` nearest cells only."""
    return nearest(
        assign_cells(vectors, centroids),
        queries.withColumn("cells", nearest_cells(F.col("embedding"), centroids, probes)),
        k,
        stored_cells=False,
    )
