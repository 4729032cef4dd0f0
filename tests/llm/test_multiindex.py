"""The inverted multi-index against a look at all vectors."""

import numpy as np
import pytest

from folioflow.llm import multiindex as M
from folioflow.llm import queries

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, asked, k=10):
    """{query: [(vec_id, score), ...]} by plain differences in double precision."""
    ids = np.array([i for i, _ in rows])
    points = np.array([np.array(v, np.float32).astype(float) for _, v in rows])
    found = {}
    for q, v in asked:
        scores = np.sqrt(((points - np.array(v, np.float32).astype(float)) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, scores)) if ids[i] != q][:k]
        found[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return found


def grouped(result):
    found = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(found[r.query_id]) == r.rank
    return found


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items()) / sum(map(len, want.values()))


def made(kind, n, dim, seed=0):
    pick = np.random.default_rng(seed)
    if kind == "clustered":
        centres = pick.normal(size=(40, dim))
        points = centres[pick.integers(0, 40, n)] + 0.2 * pick.normal(size=(n, dim))
    else:
        points = pick.normal(size=(n, dim))
    return [(i, [float(x) for x in p]) for i, p in enumerate(points)]


@pytest.mark.parametrize("kind", ["clustered", "random"])
def test_recall_and_exact_scores(spark, kind):
    rows = made(kind, 6000, 16)
    asked = rows[::60]
    frame = spark.createDataFrame(rows, SCHEMA)
    index = M.build(frame, "vec_id", "embedding", 10)
    got = grouped(M.search(index, spark.createDataFrame(asked, SCHEMA), "vec_id", "embedding", 10))
    want = exact(rows, asked)
    assert recall(got, want) >= 0.93
    scores = {q: dict(exact(rows, [(q, v)], len(rows))[q]) for q, v in asked[:10]}
    for q, v in scores.items():
        assert all(score == v[i] for i, score in got[q])
    assert index["entries"].count() == 6000
    if kind == "clustered":
        assert index["books"][16]["budget"] < 2000


def test_walk_takes_all_pairs_in_order():
    pick = np.random.default_rng(1)
    book = {"half": 3, "first": pick.normal(size=(7, 3)), "second": pick.normal(size=(5, 2))}
    query = pick.normal(size=5)
    cells = list(M.walk(query, book))
    sums = [((query[:3] - book["first"][c // 5]) ** 2).sum() + ((query[3:] - book["second"][c % 5]) ** 2).sum() for c in cells]
    assert sorted(cells) == list(range(35)) and np.all(np.diff(sums) > -1e-12)


def test_copies_ties_and_small_tables_are_exact(spark, monkeypatch):
    """With every cell in reach the result is the exact one, whatever the groups of copies."""
    monkeypatch.setattr(M, "BLOCK_BYTES", 16 * 8 * 3)
    monkeypatch.setattr(M, "SLICE_QUERIES", 3)
    pick = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 900, 3)]
    rows += [(i, [float(x) for x in pick.integers(0, 3, 3)]) for i in range(1, 900, 3)]
    rows += [(i, [0.5, float(i % 7), 0.0]) for i in range(2, 900, 3)]
    rows = [(i, v) for i, v in rows if any(v)]
    asked = [(i, v) for i, v in rows if i % 20 == 0]
    index = M.build(spark.createDataFrame(rows + rows[:50], SCHEMA), "vec_id", "embedding", 10)
    index["books"][3]["budget"] = 1 << 40
    got = grouped(M.search(index, spark.createDataFrame(asked + asked[:3], SCHEMA), "vec_id", "embedding", 10))
    assert got == exact(rows, asked)


def test_a_crowded_cell_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 16 * 8 * 2)
    monkeypatch.setattr(M, "CELL_ROWS", 1000)
    rows = [(i, [1 + i * 1e-6, 1.0]) for i in range(500)]
    index = M.build(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 3)
    assert index["books"][2]["blocks"].max() > 20
    assert max(r["count"] for r in index["entries"].groupBy("block").count().collect()) < 60
    got = grouped(M.search(index, spark.createDataFrame(rows[::50], SCHEMA), "vec_id", "embedding", 3))
    assert got == exact(rows, rows[::50], 3)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]),
            (6, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (8, [2.0, 2.0]), (9, [-0.0, 1.0]), (9, [0.0, 1.0]), (10, [4.0]), (20, [7.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], f"{SCHEMA}, cell int")
    index = M.build(frame, "vec_id", "embedding", 2)
    got = grouped(M.search(index, frame, "vec_id", "embedding", 2))
    assert {q: [i for i, _ in near] for q, near in got.items()} == {6: [9, 8], 8: [6, 9], 9: [6, 8], 10: [20], 20: [10]}
    with pytest.raises(ValueError, match="up to 2"):
        M.search(index, frame, "vec_id", "embedding", 3)
    empty = M.build(frame.limit(0), "vec_id", "embedding", 2)
    assert M.search(empty, frame, "vec_id", "embedding", 2).count() == 0


def test_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    asked = [(i, v) for i, v in rows if i % 100 == 0]
    assert recall(grouped(queries.op12_multiindex(spark, sf_dir)), exact(rows, asked)) >= 0.9
