"""The stored index of byte codes against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.operators import coded as V
from folioflow.operators import similarity as S
from tests.test_similarity import brute, data, found  # noqa: F401


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):  # noqa: F811
    return V.build(data[2], str(tmp_path_factory.mktemp("coded") / "x"), 6, n_cells=8, parts=4)


@pytest.fixture(scope="module")
def clustered(spark):
    """4,000 vectors around 60 centres in 24 dimensions, a third around one of them."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 24))
    of = np.where(rng.random(4000) < 1 / 3, 0, rng.integers(60, size=4000))
    points = (centres[of] + rng.normal(scale=0.15, size=(4000, 24))).astype(np.float32)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return points.astype(float), spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


def test_all_cells_without_limit_is_exact(data, index):  # noqa: F811
    points, queries, _, asked = data
    got = V.search(index, asked, 7, len(index.cells))
    assert found(got) == brute(points, queries, 7)
    rows = {(r.query_id, r.vec_id): r.distance for r in got.collect()}
    for (q, v), distance in rows.items():
        assert distance == pytest.approx(np.linalg.norm(points[v] - queries[q]), abs=1e-12)


def test_some_cells_lose_nothing_of_those_cells(spark, data, index):  # noqa: F811
    points, queries, _, asked = data
    stored = spark.read.schema(V.LISTED).parquet(f"{index.path}/lists")
    cell = {r.vec_id: r.cell for r in stored.select("vec_id", "cell").collect()}
    assert len(cell) == len(points)
    want = set()
    for q, query in enumerate(queries):
        near = set(V.probe_order(index, query)[:2])
        ids = np.array([i for i in range(len(points)) if cell[i] in near])
        distance = np.sqrt(((points[ids] - query) ** 2).sum(axis=1))
        want |= {(q, rank + 1, int(ids[i])) for rank, i in enumerate(np.lexsort((ids, distance))[:7])}
    assert found(V.search(index, asked, 7, 2)) == want


def test_recall_at_two_of_eight_probes(spark, clustered, tmp_path):
    points, vectors = clustered
    index = V.build(vectors, str(tmp_path / "x"), 24, n_cells=8, parts=6)
    asked = vectors.where("vec_id % 40 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    got = V.recall(V.search(index, asked, 10, 2, 100), S.nearest(vectors, asked, 10)).collect()
    assert len(got) == 100 and all(r.wanted == 10 for r in got)
    assert sum(r.hits for r in got) >= 0.95 * 1000
    assert V.calibrate(spark, index, 10, 0.95) <= 2
    assert V.calibrate(spark, index, 10, 1.0) <= 8


def test_only_probed_cells_and_narrow_columns_are_read(data, index):  # noqa: F811
    plan = V.search(index, data[3].where("query_id < 2"), 5, 1, 20)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    # a scan inside a pruning subquery is a copy that only runs where its broadcast exists
    schemas = [line.split("ReadSchema: ")[1].strip() for line in scans]
    assert set(schemas) == {"struct<vec_id:bigint,codes:binary,error:double>",
                            "struct<vec_id:bigint,embedding:array<double>>"}
    assert all("cell#" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans)


def test_more_queries_than_a_task_carries(data, index, monkeypatch):  # noqa: F811
    points, queries, _, asked = data
    monkeypatch.setattr(S, "MAX_SHIPPED_QUERIES", 5)
    assert found(V.search(index, asked, 3, len(index.cells), 900)) == brute(points, queries, 3)


def test_rows_that_are_no_vectors(spark, data, tmp_path):  # noqa: F811
    _, _, vectors, asked = data
    odd = spark.createDataFrame(
        [(9000, None), (9001, []), (9002, [1.0] * 5), (9003, [float("nan")] + [0.0] * 5),
         (9004, [None] + [0.0] * 5), (None, [0.0] * 6)], vectors.schema)
    few = vectors.where("vec_id < 3")
    index = V.build(few.union(odd).withColumn("cell", F.lit("x")), str(tmp_path / "x"), 6, 8, 4)
    strange = asked.limit(2).union(odd.where("vec_id IS NOT NULL").select("vec_id", "embedding"))
    got = V.search(index, strange, 10, 8)
    assert {r.vec_id for r in got.collect()} == {0, 1, 2} and got.count() == 6
    with pytest.raises(ValueError):
        V.search(index, asked, 10, 8, 9)


def test_empty_index_and_no_queries(data, index, tmp_path):  # noqa: F811
    _, _, vectors, asked = data
    empty = V.build(vectors.where("false"), str(tmp_path / "x"), 6, 8, 4)
    assert V.search(empty, asked, 3, 8).count() == 0
    assert V.search(index, asked.where("false"), 3, 8).count() == 0


def test_equal_vectors_tie_by_identity(spark, tmp_path):
    same = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(1.0)] * 4).alias("embedding"))
    index = V.build(same, str(tmp_path / "x"), 4, 8, 2)
    asked = spark.createDataFrame([(1, [0.0] * 4)], "query_id long, embedding array<double>")
    for candidates in (None, 5):
        assert [r.vec_id for r in V.search(index, asked, 5, 8, candidates).orderBy("rank").collect()] == [0, 1, 2, 3, 4]
