"""Retry cycles that find what is due in the index by due time."""

import datetime as dt
import random

import pytest

from folioflow.jobs import due as D
from folioflow.jobs import reprocess
from folioflow.operators import lifecycle as L
from folioflow.sources.blobs import read_blobs
from folioflow.sources.files import names
from tests.test_jobs import DOC, NOW, states, store  # noqa: F401


@pytest.fixture
def parts(spark, store):  # noqa: F811
    base = spark.read.parquet(str(store / "documents"))
    return base, read_blobs(spark, str(store / "objects")), str(store / "out")


def cycle(parts, number, minutes=None, **options):
    base, blobs, out = parts
    now = NOW + dt.timedelta(minutes=30 * number if minutes is None else minutes)
    return tuple(reprocess.run_cycle(base, blobs, out, number, now, indexed=True, **options).first())


def test_cycles_give_the_same_as_without_index(spark, parts):
    base, _, out = parts
    assert cycle(parts, 0) == (2, 1, 1, 0)
    assert cycle(parts, 1) == (1, 0, 1, 1)
    assert cycle(parts, 1) == (1, 0, 1, 1)  # rerun after a lost driver
    after = reprocess.current_documents(base, out, 2)
    assert states(after) == {1: ("Processed", 1), 2: ("Failed", 3),
                             3: ("TextExtractionFailed", 3), 4: ("Processed", 0)}
    assert cycle(parts, 2) == (0, 0, 0, 0)


def test_limited_cycles_take_what_was_left(spark, parts):
    assert [cycle(parts, n, limit=1)[0] for n in range(5)] == [1, 1, 1, 0, 0]


def test_cool_down_is_strict(spark, parts):
    assert cycle(parts, 0)[0] == 2
    assert cycle(parts, 1, minutes=10)[0] == 0
    assert cycle(parts, 2, minutes=11)[0] == 1


def test_later_cycles_read_due_buckets_only(spark, parts, monkeypatch):
    cycle(parts, 0)
    last, now = D.last_turn(spark, f"{parts[2]}/wheel", 1), NOW + dt.timedelta(minutes=30)
    due = D.read_due(spark, f"{parts[2]}/wheel", last, 1, now)
    plan = due._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("bucket" in line and "batch_id" in line for line in filters)
    assert "documents" not in plan

    def forbidden(*_, **__):
        raise AssertionError("the records of earlier cycles were read")

    monkeypatch.setattr(reprocess, "latest_states", forbidden)
    assert cycle(parts, 1)[0] == 1


def test_attempts_that_died_come_back_and_count(spark, parts, monkeypatch):
    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(reprocess, "store_outcomes", dies)
        with pytest.raises(RuntimeError):
            cycle(parts, 0)
    assert cycle(parts, 1, minutes=20)[0] == 0  # they may still run
    assert cycle(parts, 2, minutes=31) == (2, 1, 1, 1)  # document 2 was at its last attempt


def test_last_attempt_that_died_is_given_up(spark, parts, monkeypatch):
    def dies(*_, **__):
        raise RuntimeError("lost")

    cycle(parts, 0)  # document 2 has one attempt left
    with monkeypatch.context() as patch:
        patch.setattr(reprocess, "store_outcomes", dies)
        with pytest.raises(RuntimeError):
            cycle(parts, 1)
    assert cycle(parts, 2, minutes=61) == (1, 0, 1, 1)
    assert states(reprocess.current_documents(parts[0], parts[2], 3))[2] == ("Failed", 3)
    assert cycle(parts, 3, minutes=120)[0] == 0


def test_turn_that_died_before_its_mark_leaves_nothing(spark, parts, monkeypatch):
    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(D, "publish", dies)
        with pytest.raises(RuntimeError):
            cycle(parts, 0)
    assert names(spark, f"{parts[2]}/wheel/begun") == ["batch_id=0"]
    assert cycle(parts, 1)[0] == 2
    assert names(spark, f"{parts[2]}/wheel/begun") == ["batch_id=1"]


def test_outcomes_whose_entries_were_lost_are_filed_by_the_next(spark, parts, monkeypatch):
    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(D, "settle", dies)
        with pytest.raises(RuntimeError):
            cycle(parts, 0)
    assert cycle(parts, 1, minutes=11)[0] == 1  # document 2 again, 1 is settled
    assert cycle(parts, 2, minutes=60)[0] == 0


def test_index_starts_from_cycles_without_it(spark, parts):
    base, blobs, out = parts
    assert tuple(reprocess.run_cycle(base, blobs, out, 0, NOW).first())[0] == 2
    assert cycle(parts, 1) == (1, 0, 1, 1)


def test_empty_table_and_old_turns_go(spark, parts):
    empty = (parts[0].limit(0), *parts[1:])
    for number in range(5):
        assert cycle(empty, number)[0] == 0
    assert "batch_id=0" not in names(spark, f"{parts[2]}/wheel/begun")
    assert D.turns(spark, f"{parts[2]}/wheel")[0] > 0


def test_failures_filed_from_outside_are_found_once(spark, parts):
    wheel = f"{parts[2]}/wheel"
    cycle(parts, 0)
    late = spark.createDataFrame(
        [(9, "ok.txt", "TXT", "TextExtractionFailed", 0, NOW - dt.timedelta(days=3), None, None)], DOC)
    D.file_states(late, wheel, 1, NOW, L.MAX_RETRIES)
    last = D.last_turn(spark, wheel, 1)
    found = D.read_due(spark, wheel, last, 1, NOW + dt.timedelta(minutes=30))
    assert sorted(r.id for r in found.collect()) == [2, 9]
    assert cycle(parts, 1) == (2, 1, 1, 1)
    assert cycle(parts, 2)[0] == 0


def test_buckets_ascend_in_every_zone(spark):
    rng = random.Random(5)
    moments = sorted(dt.datetime(2024, 3, 30) + dt.timedelta(seconds=rng.randrange(400_000)) for _ in range(200))
    rows = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz").coalesce(1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = []
    try:
        for name in ("Europe/Berlin", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            seen.append([r.b for r in rows.select(D.bucket_of(rows.m).alias("b")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen[0] == seen[1] == sorted(seen[0])
