"""Reprocessing cycles and metric recording as jobs."""

import datetime as dt

import pytest

from folioflow.jobs import backfill, monitor, process, reprocess, worker
from folioflow.operators import lifecycle as L
from folioflow.operators import metrics as M
from folioflow.sources.batches import read_batches
from folioflow.streaming import jobs as J
from folioflow.sources.blobs import read_blobs

NOW = dt.datetime(2024, 5, 1, 12)
DOC = ("id long, storage_path string, file_type string, status string, retry_count int,"
       " updated_at timestamp_ntz, processing_notes string, processing_started_at timestamp_ntz")


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "objects").mkdir()
    (tmp_path / "objects" / "ok.txt").write_text("fine text in here")
    old = NOW - dt.timedelta(hours=5)
    docs = spark.createDataFrame(
        [(1, "ok.txt", "TXT", "TextExtractionFailed", None, old, None, None),
         (2, "gone.txt", "TXT", "TextExtractionFailed", 1, old, "n", None),
         (3, "gone.txt", "TXT", "TextExtractionFailed", 3, old, None, None),
         (4, "ok.txt", "TXT", "Processed", 0, old, None, old - dt.timedelta(seconds=90))], DOC)
    docs.write.parquet(str(tmp_path / "documents"))
    return tmp_path


def states(df):
    return {r.id: (r.status, r.retry_count) for r in df.collect()}


def test_cycles_until_nothing_is_left(spark, store):
    out = str(store / "out")
    base = spark.read.parquet(str(store / "documents"))
    blobs = read_blobs(spark, str(store / "objects"))

    def cycle(number):
        now = NOW + dt.timedelta(minutes=30 * number)
        return tuple(reprocess.run_cycle(base, blobs, out, number, now).first())

    assert cycle(0) == (2, 1, 1, 0)
    assert states(reprocess.current_documents(base, out, 1)) == {
        1: ("Processed", 1), 2: ("TextExtractionFailed", 2),
        3: ("TextExtractionFailed", 3), 4: ("Processed", 0)}
    assert cycle(1) == (1, 0, 1, 1)
    assert cycle(1) == (1, 0, 1, 1)  # rerun after a lost driver
    after = reprocess.current_documents(base, out, 2)
    assert states(after)[2] == ("Failed", 3)
    note = {r.id: r.processing_notes for r in after.collect()}
    assert note[2].startswith("n\n[2024-05-01 12:30:00] Documento marcado") and note[1] is None
    assert cycle(2) == (0, 0, 0, 0)
    assert [(r.document_id, r.content) for r in process.current_chunks(spark, out).collect()] == [
        (1, "fine text in here")]
    assert [r.summary for r in process.current_texts(spark, out).collect()] == ["fine text in here"]


def test_an_attempt_that_died_still_counts_and_comes_back(spark, store):
    out = str(store / "out")
    base = spark.read.parquet(str(store / "documents"))
    begun = spark.createDataFrame(
        [(2, "gone.txt", "TXT", "ExtractingText", 2, NOW, "n")], reprocess.CHANGE)
    begun.write.parquet(f"{out}/attempts/batch_id=0")
    assert states(reprocess.current_documents(base, out, 1))[2] == ("ExtractingText", 2)
    later = NOW + dt.timedelta(hours=1)
    due = reprocess.candidates(base, out, 1, later, 3, None)
    assert sorted((r.id, r.retry_count) for r in due.collect()) == [(1, 0), (2, 2)]
    soon = NOW + dt.timedelta(minutes=20)
    due = reprocess.candidates(base, out, 1, soon, 3, None)
    assert [r.id for r in due.collect()] == [1]  # 2 may still be under extraction


def test_a_last_attempt_that_died_is_given_up(spark, store):
    out = str(store / "out")
    base = spark.read.parquet(str(store / "documents"))
    blobs = read_blobs(spark, str(store / "objects"))
    begun = spark.createDataFrame(
        [(2, "gone.txt", "TXT", "ExtractingText", 3, NOW, "n")], reprocess.CHANGE)
    begun.write.parquet(f"{out}/attempts/batch_id=0")
    reprocess.run_cycle(base, blobs, out, 1, NOW + dt.timedelta(hours=1))
    assert states(reprocess.current_documents(base, out, 2))[2] == ("Failed", 3)


def test_candidates_equal_those_of_the_whole_table(spark, store):
    out = str(store / "out")
    base = spark.read.parquet(str(store / "documents"))
    blobs = read_blobs(spark, str(store / "objects"))
    for number in range(3):
        now = NOW + dt.timedelta(minutes=11 * number)
        whole = L.retry_candidates(
            reprocess.current_documents(base, out, number), now, 3, keep=["processing_notes"])
        due = reprocess.candidates(base, out, number, now, 3, None)
        assert sorted(map(tuple, due.collect())) == sorted(map(tuple, whole.collect()))
        reprocess.run_cycle(base, blobs, out, number, now)
    plan = reprocess.candidates(base, out, 3, now, 3, 10)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,TextExtractionFailed)" in plan and "TakeOrderedAndProject" in plan


def test_command_lines(spark, store):
    out = str(store / "cli")
    reprocess.main(["--documents", str(store / "documents"), "--blobs", str(store / "objects"),
                    "--out", out, "--run-once", "--max-retries", "2", "--limit", "5"], spark)
    settled = read_batches(spark, f"{out}/settled", reprocess.CHANGE)
    assert states(settled) == {1: ("Processed", 1), 2: ("Failed", 2)}
    chunks = spark.createDataFrame([([1.0],), (None,)], "embedding array<float>")
    chunks.write.parquet(str(store / "chunks"))
    monitor.main(["--documents", str(store / "documents"), "--chunks", str(store / "chunks"),
                  "--out", f"{out}/metrics", "--run-once"], spark)
    row = spark.read.parquet(f"{out}/metrics").first()
    assert (row.total_documents, row.failed_documents, row.reprocessable_documents) == (4, 3, 2)
    assert row.avg_processing_time_seconds == 90.0 and row.embedding_completion_percent == 50.0
    lines = M.report_lines(spark.read.parquet(f"{out}/metrics")).first()
    assert lines.retry_detail == "1 docs com 0 tentativas, 1 docs com 1 tentativas, 1 docs com 3 tentativas"
    assert "Tempo médio: 90.00s" in lines.report and "(50.00%)" in lines.report


def test_worker_and_backfill_commands(spark, store):
    (store / "queue").mkdir()
    (store / "queue" / "1.txt").write_text(
        '{"DocumentId": 1, "StoragePath": "ok.txt", "FileType": "TXT"}\n'
        '{"DocumentId": 2, "StoragePath": "gone.txt", "FileType": "TXT"}\n')
    out = str(store / "work")
    worker.main(["--queue", str(store / "queue"), "--blobs", str(store / "objects"), "--out", out,
                 "--checkpoint", str(store / "c1"), "--run-once"], spark)
    got = {r.document_id: (r.status, r.error) for r in process.current_states(spark, out).collect()}
    assert got == {1: ("Processed", None), 2: ("TextExtractionFailed", "not_found")}
    assert [r.text for r in process.current_texts(spark, out).collect()] == ["fine text in here"]
    table = spark.createDataFrame(
        [(i, "Queued", "old", NOW) for i in (1, 2, 3)],
        "id long, status string, text_extracted string, updated_at timestamp_ntz")
    after = {r.id: (r.status, r.text_extracted) for r in process.updated_documents(table, out).collect()}
    assert after == {1: ("Processed", "fine text in here"), 2: ("TextExtractionFailed", "old"), 3: ("Queued", "old")}
    chunks = process.current_chunks(spark, out).drop("batch_id")
    assert [r.embedding for r in chunks.collect()] == [None]

    def put(name, df):
        df.write.parquet(str(store / name))
        return str(store / name)

    backfill.main([
        "--chunks", put("found", chunks),
        "--documents", put("owners", spark.createDataFrame([(1, "u")], "id long, uploaded_by_user_id string")),
        "--configurations", put("cf", spark.createDataFrame(
            [(5, "u", "openai")], "id long, user_id string, default_provider string")),
        "--providers", put("pr", spark.createDataFrame(
            [(9, 5, "openai", True)],
            "id long, a_i_configuration_id long, provider string, is_enabled boolean")),
        "--out", f"{out}/vectors", "--checkpoint", str(store / "c2"), "--run-once"], spark)
    [row] = J.backfilled(spark, f"{out}/vectors").collect()
    assert (row.document_id, row.embed_status, row.credential_source, row.dim) == (1, "embedded", "user", 1536)
