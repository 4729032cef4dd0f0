"""Nearest vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.operators import similarity as S


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(900, 6)).astype(np.float32)
    points[300:600] = points[0] + rng.normal(scale=0.01, size=(300, 6))  # a third in one spot
    points[700:710] = points[700]  # copies tie
    queries = np.vstack([points[[0, 700, 5]], rng.normal(size=(9, 6))])
    vectors = spark.createDataFrame(
        [(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<float>"
    ).repartition(5)
    asked = spark.createDataFrame(
        [(i, [float(x) for x in q]) for i, q in enumerate(queries)], "query_id long, embedding array<double>")
    return points.astype(float), queries, vectors, asked


def brute(points, queries, k):
    out = set()
    for q, query in enumerate(queries):
        distance = np.sqrt(((points - query) ** 2).sum(axis=1))
        for rank, i in enumerate(np.lexsort((np.arange(len(points)), distance))[:k]):
            out.add((q, rank + 1, int(i)))
    return out


def found(df):
    return {(r.query_id, r["rank"], r.vec_id) for r in df.collect()}


def test_exact(data):
    points, queries, vectors, asked = data
    assert found(S.nearest(vectors, asked, 7)) == brute(points, queries, 7)


def test_more_queries_than_a_task_carries(data, monkeypatch):
    points, queries, vectors, asked = data
    monkeypatch.setattr(S, "ROWS_PER_GROUP", 100)
    out = S.nearest(vectors, asked, 7, max_queries=3)
    assert found(out) == brute(points, queries, 7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "Cartesian" not in plan


def test_many_queries_picked_from_the_vectors_themselves(data, monkeypatch):
    """Both sides then have columns of one frame, which must not be taken for each other."""
    points, _, vectors, _ = data
    monkeypatch.setattr(S, "ROWS_PER_GROUP", 400)
    asked = vectors.where("vec_id % 90 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {(q // 90, rank, v) for q, rank, v in found(S.nearest(vectors, asked, 7, max_queries=4))}
    assert got == brute(points, points[::90], 7)


def test_all_cells_is_exact_and_few_cells_recall_most(data, monkeypatch):
    points, queries, vectors, asked = data
    centroids = S.train_cells(vectors, 12)
    assert found(S.nearest_in_cells(vectors, asked, centroids, 7, 12)) == brute(points, queries, 7)
    some = found(S.nearest_in_cells(vectors, asked, centroids, 7, 4))
    exact = brute(points, queries, 7)
    hits = {(q, v) for q, _, v in some} & {(q, v) for q, _, v in exact}
    assert len(hits) / len(exact) > 0.8
    monkeypatch.setattr(S, "ROWS_PER_GROUP", 50)
    cells = S.assign_cells(vectors, centroids)
    probing = asked.withColumn("cells", S.nearest_cells(F.col("embedding"), centroids, 4))
    assert found(S.nearest(cells, probing, 7, max_queries=2)) == some


def test_only_equal_dimensions_compare(spark, data):
    _, _, vectors, _ = data
    longer = spark.createDataFrame([(5000, [0.0] * 9)], vectors.schema)
    query = spark.createDataFrame([(0, [0.0] * 9)], "query_id long, embedding array<double>")
    assert [r.vec_id for r in S.nearest(vectors.union(longer), query, 3).collect()] == [5000]


@pytest.mark.parametrize("carried", [2048, 3])
def test_queries_of_several_dimensions(spark, data, carried):
    points, queries, vectors, asked = data
    longer = np.random.default_rng(5).normal(size=(40, 8))
    frame = spark.createDataFrame([(1000 + i, [float(x) for x in p]) for i, p in enumerate(longer)], vectors.schema)
    odd = spark.createDataFrame([(2000, None), (2001, [])], vectors.schema)
    more = spark.createDataFrame([(100 + i, [float(x) for x in np.float32(p)]) for i, p in enumerate(longer[:3])]
                                 + [(900, None), (901, [])], asked.schema)
    got = found(S.nearest(vectors.union(frame).union(odd), more.union(asked), 7, max_queries=carried))
    floats = longer.astype(np.float32).astype(float)
    assert got == brute(points, queries, 7) | {
        (q + 100, rank, i + 1000) for q, rank, i in brute(floats, floats[:3], 7)}


def test_fewer_vectors_than_wanted(data):
    points, queries, vectors, asked = data
    few = vectors.where("vec_id < 3")
    assert found(S.nearest(few, asked, 10)) == brute(points[:3], queries, 10)
    assert S.nearest(vectors, asked.where("false"), 3).count() == 0
    assert S.nearest(vectors.where("false"), asked, 3).count() == 0


def test_too_many_cells(data):
    with pytest.raises(ValueError):
        S.train_cells(data[2], S.MAX_CELLS + 1)


def test_mean_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0]), (2, [0.0, 1.0])], "label int, embedding array<float>")
    assert {r.query_id: list(r.embedding) for r in S.mean_vectors(df, "label").collect()} == {
        1: [2.0, 4.0], 2: [0.0, 1.0]}


def test_vectors_stored_by_cell_are_pruned(spark, data, tmp_path):
    _, _, vectors, asked = data
    centroids = S.train_cells(vectors, 6)
    path = str(tmp_path / "cells")
    S.assign_cells(vectors, centroids).write.partitionBy("cell").parquet(path)
    probing = asked.where("query_id < 2").withColumn(
        "cells", S.nearest_cells(F.col("embedding"), centroids, 1))
    out = S.nearest(spark.read.parquet(path), probing, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    [filters] = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert "cell#" in filters.split("PartitionFilters:")[1].split("PushedFilters")[0]
    want = S.nearest(S.assign_cells(vectors, centroids), probing, 5)
    assert found(out) == found(want)
