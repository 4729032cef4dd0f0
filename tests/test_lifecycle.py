"""States, retries and their truth tables."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from folioflow.operators import lifecycle as L
from folioflow.operators import metrics as M
from folioflow.plans import fixtures as fx
from folioflow.schemas import EXTRACTION_FAILED, FAILED, PROCESSED

NOW = dt.datetime(2024, 5, 1, 12, 0)
DOC = ("id long, storage_path string, file_type string, status string, retry_count int,"
       " updated_at timestamp_ntz, processing_notes string")


def doc(i, status, retry, minutes, notes=None):
    return (i, "p", "PDF", status, retry, NOW - dt.timedelta(minutes=minutes), notes)


def test_time_limits_are_strict(spark):
    rows = [doc(1, "ExtractingText", None, 30), doc(2, "ExtractingText", None, 30.0001),
            doc(3, "Queued", None, 99), doc(4, EXTRACTION_FAILED, 0, 10),
            doc(5, EXTRACTION_FAILED, 0, 10.0001), doc(6, EXTRACTION_FAILED, None, 60),
            doc(7, EXTRACTION_FAILED, 3, 60), doc(8, EXTRACTION_FAILED, 2, 50)]
    docs = spark.createDataFrame(rows, DOC)
    assert [r.id for r in L.stuck_documents(docs, NOW).collect()] == [2]
    assert [r.id for r in L.retry_candidates(docs, NOW, limit=10).collect()] == [6, 8, 5]
    assert [r.id for r in L.retry_candidates(docs, NOW, limit=2).collect()] == [6, 8]
    assert sorted(r.id for r in L.retry_candidates(docs, NOW, max_retries=9).collect()) == [5, 6, 7, 8]
    assert [r.id for r in L.exhausted_limbo(docs).collect()] == [7]
    failed = {r.id: (r.status, r.updated_at) for r in L.fail_stuck(docs, NOW).collect()}
    assert failed[2] == (EXTRACTION_FAILED, NOW) and failed[1][0] == "ExtractingText"


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    docs = spark.createDataFrame(
        [doc(1, "ExtractingText", None, 31), doc(2, "ExtractingText", None, 29)], DOC)
    timed = spark.createDataFrame(
        [(PROCESSED, dt.datetime(2024, 3, 10, 12), dt.datetime(2024, 3, 9, 12))],
        "status string, updated_at timestamp_ntz, processing_started_at timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [r.id for r in L.stuck_documents(docs, NOW).collect()] == [1]
        assert M.mean_processing_time(timed).first()[0] == 86400.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_settling_every_outcome(spark):
    cases = list(itertools.product([PROCESSED, EXTRACTION_FAILED], [1, 2, 3, 4], [None, "n"]))
    rows = [(i, *case) for i, case in enumerate(cases)]
    df = spark.createDataFrame(rows, "id long, outcome string, retry_count int, processing_notes string")
    settled = L.settle_attempts(df, NOW, 3)
    got = {r.id: r for r in settled.collect()}
    for i, (outcome, tries, notes) in enumerate(cases):
        gave_up = outcome != PROCESSED and tries >= 3
        assert got[i].status == (FAILED if gave_up else outcome)
        assert got[i].processing_notes == (
            (notes or "") + "\n[2024-05-01 12:00:00] Documento marcado como permanentemente falhado"
            " após 3 tentativas de reprocessamento." if gave_up else notes)
        assert got[i].updated_at == NOW and got[i].retry_count == tries
    stats = L.cycle_stats(settled).first()
    assert tuple(stats) == (16, 8, 8, 4)
    assert tuple(L.cycle_stats(settled.where("false")).first()) == (0, 0, 0, 0)


def test_attempt_is_counted_before_it_is_made(spark):
    docs = spark.createDataFrame([doc(1, EXTRACTION_FAILED, None, 60), doc(2, EXTRACTION_FAILED, 1, 60)], DOC)
    rows = L.start_attempt(L.retry_candidates(docs, NOW), NOW).orderBy("id").collect()
    assert [(r.status, r.retry_count, r.updated_at) for r in rows] == [
        ("ExtractingText", 1, NOW), ("ExtractingText", 2, NOW)]


def test_snapshot_of_nothing(spark):
    docs = spark.createDataFrame([], DOC + ", processing_started_at timestamp_ntz")
    chunks = spark.createDataFrame([], "embedding array<float>")
    row = M.metrics_snapshot(docs, chunks, NOW).first()
    assert (row.total_documents, row.total_chunks, row.embedding_completion_percent) == (0, 0, 0.0)
    assert row.avg_processing_time_seconds == 0.0
    assert row.status_counts == {} and row.failed_by_retry_count == {}
    line = M.report_lines(M.metrics_snapshot(docs, chunks, NOW)).first()
    assert "Total de documentos: 0" in line.report and line.retry_detail == ""


def test_snapshot_maps(spark, sf_dir):
    docs = fx.document_state(spark, sf_dir)
    row = M.metrics_snapshot(docs, fx.chunk_state(spark, sf_dir), NOW, vector_col="vec_id").first()
    assert row.status_counts == {r.status: r.n for r in M.docs_by_status(docs).collect()}
    assert row.failed_by_retry_count == {r.retry_count: r.n for r in M.failed_by_retry(docs).collect()}


def test_sums_of_time_cannot_overflow(spark):
    """Ten billion documents of an hour each would exceed whole microseconds."""
    took = (F.lit(3_600_000_000) * 300_000).cast("bigint")
    rows = spark.range(20_000).select(F.lit(PROCESSED).alias("status"), took.alias("took"))
    got = rows.agg(*M.timing(F.col("took"))).first()
    assert got.took_seconds == 3600 * 300_000 * 20_000


def test_documents_without_a_status_do_not_break_the_summary(spark):
    from folioflow.operators.metrics import document_summary

    cells = spark.createDataFrame(
        [(None, 0, 2, 0, 0, 0), ("Processed", 0, 3, 0, 0, 0)],
        "status string, retry_count int, n long, took_seconds long, took_rest long, n_timed long")
    got = document_summary(cells).first()
    assert got.status_counts == {"Processed": 3} and got.total_documents == 5
