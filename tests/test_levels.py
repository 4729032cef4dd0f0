"""Folded batch tables and bucketed ones: nothing is lost, doubled or read more than needed."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.jobs import process as P
from folioflow.jobs import reprocess as R
from folioflow.operators import updates as U
from folioflow.sources import buckets as B
from folioflow.sources import files, levels
from folioflow.sources.batches import latest_set, write_batch

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
VALUES = levels.last_values("id", ["a", "b"])


def made(number):
    """A batch of twelve rows, some of them changing only one column."""
    pick = random.Random(number)
    return {i: (f"a{number}" if pick.random() < 0.7 else None, f"b{number}" if pick.random() < 0.3 else None)
            for i in pick.sample(range(30), 12)}


def put(spark, path, number):
    rows = [(i, *values) for i, values in made(number).items()]
    write_batch(spark.createDataFrame(rows, ROW).coalesce(1), path, number)


def state(rows):
    last = U.latest_changes(rows, "id", ["batch_id"], ["a", "b"])
    return {r.id: (r.a, r.b) for r in last.collect()}


def expected(numbers):
    out = {}
    for n in numbers:
        for i, (a, b) in made(n).items():
            old = out.get(i, (None, None))
            out[i] = (a or old[0], b or old[1])
    return out


def fold(spark, path):
    return levels.fold_batches(spark, path, ROW, ["id"], VALUES)


def test_reads_grow_with_the_logarithm_of_the_batches(spark, tmp_path):
    path, folds = str(tmp_path / "t"), 0
    for n in range(70):
        put(spark, path, n)
        folds += fold(spark, path)
        now = levels.snapshot(spark, path)
        tail = [k for k in levels.batches(spark, path) if k not in now.covered]
        assert len(now.runs) + len(tail) <= levels.FANOUT * (1 + math.log(n + 2, levels.FANOUT))
        if n % 23 == 22:
            assert state(levels.read_levels(spark, path, ROW)) == expected(range(n + 1))
    assert folds == 69 // levels.FANOUT
    assert len(os.listdir(path)) < 15 and len(os.listdir(f"{path}/_manifests")) <= 2 * levels.KEEP + 1
    assert levels.read_levels(spark, path, ROW).count() < 30 * 2 * 10  # of a key a few rows a run


def test_a_fold_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(5):
        put(spark, path, n)
    real = files.publish

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(files, "publish", die)
    with pytest.raises(KeyboardInterrupt):
        fold(spark, path)
    assert len(os.listdir(f"{path}/_runs")) == 1 and levels.snapshot(spark, path).number == 0
    assert state(levels.read_levels(spark, path, ROW)) == expected(range(5))
    monkeypatch.setattr(files, "publish", real)
    assert fold(spark, path) and state(levels.read_levels(spark, path, ROW)) == expected(range(5))
    assert len(os.listdir(f"{path}/_runs")) == 1  # what the dead fold left is gone
    monkeypatch.setattr(files, "publish", lambda *_: False)
    for n in range(5, 9):
        put(spark, path, n)
    with pytest.raises(RuntimeError, match="another job"):
        fold(spark, path)
    monkeypatch.setattr(files, "publish", real)
    assert state(levels.read_levels(spark, path, ROW)) == expected(range(9))


def test_readers_keep_the_snapshot_they_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        put(spark, path, n)
    before = levels.read_levels(spark, path, ROW)
    assert fold(spark, path)
    between = levels.read_levels(spark, path, ROW)
    assert state(before) == state(between) == expected(range(5))
    for n in range(5, 9):
        put(spark, path, n)
    assert fold(spark, path)
    assert state(between) == expected(range(5))


def test_the_newest_batch_can_be_replayed_and_late_ones_count(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (0, 1, 2, 3, 9):
        put(spark, path, n)
    fold(spark, path)
    write_batch(spark.createDataFrame([(1, "x", "y")], ROW), path, 9)  # a replay after the fold
    assert state(levels.read_levels(spark, path, ROW)) == expected(range(4)) | {1: ("x", "y")}
    put(spark, path, 5)
    got = state(levels.read_levels(spark, path, ROW))
    assert got == expected([0, 1, 2, 3, 5]) | {1: ("x", "y")}
    for n in (10, 11, 12, 13):
        put(spark, path, n)
    fold(spark, path)
    after = {**expected([0, 1, 2, 3, 5]), 1: ("x", "y")}
    for n in (10, 11, 12, 13):
        for i, (a, b) in made(n).items():
            old = after.get(i, (None, None))
            after[i] = (a or old[0], b or old[1])
    assert state(levels.read_levels(spark, path, ROW)) == after


def test_jobs_read_the_same_before_and_after_folds(spark, tmp_path):
    out = str(tmp_path / "out")
    import datetime as dt

    for n in range(6):
        now = dt.datetime(2024, 5, 1, n)
        rows = [(i, "Processed", None, now, now) for i in range(n, n + 3)]
        for name in ("started", "states", "sweeps"):
            write_batch(spark.createDataFrame(rows, P.STATE), f"{out}/{name}", n)
        chunks = [(i, k, f"{n} {i} {k}", None, None, now) for i in range(n, n + 3) for k in range(n + 1)]
        write_batch(spark.createDataFrame(chunks, P.CHUNK), f"{out}/chunks", n)
        texts = [(i, f"t{n}" if i % 2 else None, f"s{n}", now) for i in range(n, n + 3)]
        write_batch(spark.createDataFrame(texts, P.TEXT), f"{out}/outcomes", n)
        changes = [(i, "p", "TXT", "Failed", n, now, f"n{n}" if i % 2 else None) for i in range(n, n + 3)]
        for name in ("attempts", "settled"):
            write_batch(spark.createDataFrame(changes, R.CHANGE), f"{out}/{name}", n)

    def everything():
        tables = [P.current_states(spark, out), P.current_chunks(spark, out).drop("batch_id"),
                  P.current_texts(spark, out).drop("batch_id"), R.latest_states(spark, out, 99), R.latest_states(spark, out, 5)]
        return [sorted(map(repr, t.collect())) for t in tables]

    before = everything()
    R.fold_cycles(spark, out)
    assert levels.snapshot(spark, f"{out}/chunks").runs and levels.snapshot(spark, f"{out}/settled").runs
    assert everything() == before


# --- buckets -----------------------------------------------------------------------------

CHUNKS = T.StructType([T.StructField("document_id", T.LongType()), T.StructField("content", T.StringType())])


def parts(path):
    return {f"{folder}/{name}" for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet") and "_drafts" not in folder}


def contents(spark, path):
    return sorted((r.document_id, r.content) for r in B.read_buckets(spark, path, CHUNKS).collect())


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(d, f"old {d} {k}") for d in range(200) for k in range(3)]
    B.write_buckets(spark.createDataFrame(old, CHUNKS), path, "document_id", 32)
    before = parts(path)
    fresh = write_batch(spark.createDataFrame([(7, "new"), (7, "new 2"), (300, "first")], CHUNKS), str(tmp_path / "f"), 0)
    touched = B.replace_in_buckets(fresh, path, "document_id", 1, 32)
    assert 1 <= len(touched) <= 2
    now = parts(path)
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept == before & now and kept == {f for f in now if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    want = sorted([r for r in old if r[0] != 7] + [(7, "new"), (7, "new 2"), (300, "first")])
    assert contents(spark, path) == want
    B.replace_in_buckets(fresh, path, "document_id", 1, 32)  # replayed
    assert contents(spark, path) == want and not files.names(spark, f"{path}/_drafts")
    none = write_batch(spark.createDataFrame([], CHUNKS), str(tmp_path / "f"), 1)
    assert B.replace_in_buckets(none, path, "document_id", 2, 32) == [] and contents(spark, path) == want


def test_a_change_that_dies_is_put_in_place_later(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = [(d, f"old {d}") for d in range(50)]
    B.write_buckets(spark.createDataFrame(old, CHUNKS), path, "document_id", 8)
    fresh = write_batch(spark.createDataFrame([(3, "new")], CHUNKS), str(tmp_path / "f"), 0)
    want = sorted([r for r in old if r[0] != 3] + [(3, "new")])

    def die(rows, where):
        number = rows.select("bucket").first().bucket  # the bucket's folder is gone already
        files.remove(spark, f"{where}/bucket={number}")
        raise KeyboardInterrupt

    real = B._place
    monkeypatch.setattr(B, "_place", die)
    with pytest.raises(KeyboardInterrupt):
        B.replace_in_buckets(fresh, path, "document_id", 1, 8)
    assert contents(spark, path) != want
    monkeypatch.setattr(B, "_place", real)
    os.makedirs(f"{path}/_drafts/000000000009/bucket=1")  # a draft that never became whole
    B.recover(spark, path, CHUNKS)
    assert contents(spark, path) == want and not files.names(spark, f"{path}/_drafts")


def test_a_bucket_read_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_buckets(spark.createDataFrame([(d, "x") for d in range(50)], CHUNKS), path, "document_id", 8)
    one = B.read_buckets(spark, path, CHUNKS).where(F.col("bucket") == 3)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert latest_set(one.withColumn("batch_id", F.lit(1))).count() == one.count()
