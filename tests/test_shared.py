"""The four roles work on one state."""

import datetime as dt
import re

from pyspark.sql import functions as F

from folioflow.functions.embedding import hashing_embedder
from folioflow.jobs import backfill, monitor, process, reprocess, shared, worker
from folioflow.operators.process import process_documents
from folioflow.sources.batches import write_batch
from folioflow.sources.blobs import read_blobs

NOW = dt.datetime(2024, 5, 1, 12)
DOC = ("id long, storage_path string, file_type string, status string, updated_at timestamp_ntz,"
       " processing_started_at timestamp_ntz, uploaded_by_user_id string, text_extracted string")
MESSAGE = '{"DocumentId": %d, "StoragePath": "%s", "FileType": "TXT"}'


def base(spark, tmp_path, rows):
    path = str(tmp_path / "documents")
    spark.createDataFrame([(i, p, "TXT", s, NOW, None, "u", None) for i, p, s in rows], DOC).write.parquet(path)
    return path


def test_commands_share_one_state(spark, tmp_path):
    objects, queue, home = tmp_path / "objects", tmp_path / "queue", str(tmp_path / "home")
    for folder in (objects, queue):
        folder.mkdir()
    (objects / "ok.txt").write_text("fine text in here")
    (queue / "1.txt").write_text("\n".join([MESSAGE % (1, "ok.txt"), MESSAGE % (2, "late.txt")]))
    docs = base(spark, tmp_path, [(1, "ok.txt", "Queued"), (2, "late.txt", "Queued"), (3, "ok.txt", "TextExtractionFailed")])
    worker.main(["--queue", str(queue), "--blobs", str(objects), "--out", f"{home}/worker",
                 "--checkpoint", str(tmp_path / "c"), "--run-once"], spark)

    table = spark.read.parquet(docs).selectExpr("*", "0 AS retry_count", "CAST(NULL AS STRING) AS processing_notes")
    before = {r.id: r.status for r in shared.documents(table, home).collect()}
    assert before == {1: "Processed", 2: "TextExtractionFailed", 3: "TextExtractionFailed"}
    (objects / "late.txt").write_text("it came after all")
    soon = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=11)
    for _ in range(2):  # replayed
        stats = shared.cycle(table, read_blobs(spark, str(objects)), home, 5, soon).first()
        assert tuple(stats) == (2, 2, 0, 0)  # the worker's failure and the base table's
    after = {r.id: (r.status, r.retry_count, r.text_extracted) for r in shared.documents(table, home, texts=True).collect()}
    assert after == {1: ("Processed", 0, "fine text in here"), 2: ("Processed", 1, "it came after all"),
                     3: ("Processed", 1, "fine text in here")}

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    configurations = put("cf", [(5, "u", "openai")], "id long, user_id string, default_provider string")
    providers = put("pr", [(9, 5, "openai", True)],
                    "id long, a_i_configuration_id long, provider string, is_enabled boolean")
    backfill.main(["--home", home, "--documents", docs, "--configurations", configurations,
                   "--providers", providers, "--run-once"], spark)
    assert sorted((r.document_id, r.dim) for r in shared.chunks(spark, home).collect()) == [(1, 1536), (2, 1536), (3, 1536)]
    reprocess.main(["--home", home, "--documents", docs, "--blobs", str(objects), "--run-once"], spark)
    monitor.main(["--home", home, "--documents", docs, "--out", f"{home}/metrics", "--run-once"], spark)
    row = spark.read.parquet(f"{home}/metrics").first()
    assert (row.total_documents, row.processed_documents, row.total_chunks, row.chunks_with_embeddings) == (3, 3, 3, 3)


def test_dead_extraction_of_the_worker_is_retried(spark, tmp_path):
    home = str(tmp_path / "home")
    table = spark.read.parquet(base(spark, tmp_path, [(1, "gone.txt", "Queued")])).selectExpr(
        "*", "0 AS retry_count", "CAST(NULL AS STRING) AS processing_notes")
    spark.createDataFrame([(1, "ExtractingText", None, NOW, NOW)], process.STATE).write.parquet(f"{home}/worker/started/batch_id=0")
    none = spark.createDataFrame([], "path string, length long, content binary")

    def cycle(number, minutes):
        return tuple(shared.cycle(table, none, home, number, NOW + dt.timedelta(minutes=minutes)).first())

    assert cycle(0, 20) == (0, 0, 0, 0)
    assert [cycle(k, 31 * k) for k in (1, 2, 3, 4)] == [(1, 0, 1, 0), (1, 0, 1, 0), (1, 0, 1, 1), (0, 0, 0, 0)]
    assert [(r.status, r.retry_count) for r in shared.documents(table, home).collect()] == [("Failed", 3)]


def test_vectors_of_replaced_chunks_are_not_kept(spark, tmp_path):
    home, objects = str(tmp_path / "home"), tmp_path / "o"
    objects.mkdir()
    table = spark.read.parquet(base(spark, tmp_path, [(1, "a.txt", "Queued")]))
    resolved = spark.createDataFrame([("u", 1)], "user_id string, provider_config_id long")
    lines = spark.createDataFrame([(MESSAGE % (1, "a.txt"),)], "value string")
    for number, text in enumerate(["the first text here", "another text instead"]):
        (objects / "a.txt").write_text(text)
        process.process_batch(lines, number, read_blobs(spark, str(objects)), f"{home}/worker", NOW + dt.timedelta(hours=number))
        assert [(r.content, r.dim) for r in shared.chunks(spark, home).collect()] == [(text, None)]
        assert shared.embed_missing(table, resolved, home, number, hashing_embedder(8)).count() == 1
        assert [(r.content, r.dim) for r in shared.chunks(spark, home).collect()] == [(text, 8)]


def test_counting_chunks_moves_no_contents(spark, tmp_path):
    """What is asked of a content is computed below the first join."""
    counts = shared.chunks(spark, str(tmp_path)).groupBy("document_id").agg(F.count("dim"))
    plan = counts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("xxhash64" in line for line in plan)
    assert not [line for line in plan if "Project" in line and re.search(r"[\[ ]content#\d+[,\]]", line)]


def test_contents_of_objects_move_last(spark):
    """Pages are joined before the objects, whose contents then move once; a too large one's do not."""
    messages = spark.createDataFrame([(1, "a", "TXT"), (2, "b", "TXT"), (3, "c", "PDF")],
                                     "document_id long, storage_path string, file_type string")
    blobs = spark.createDataFrame([(p, len(c), c.encode()) for p, c in (("a", "short"), ("b", "x" * 99), ("c", "%PDF"))],
                                  "path string, length long, content binary")
    pages = spark.createDataFrame([(3, 1, "a page " * 20, None)], "document_id long, page int, page_text string, ocr_text string")
    out = process_documents(messages, blobs, pages, max_bytes=50)
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert "storage_path" in joins[0]
    got = {r.document_id: (r.status, r.text and r.text[:5], r.error) for r in out.collect()}
    assert got[1] == ("Processed", "short", None) and got[2] == ("TextExtractionFailed", None, "too_large")
    assert got[3][0] == "Processed" and got[3][2] is None


def test_copies_of_a_chunk_each_get_their_vector(spark, tmp_path):
    """A content joined in last is joined once to each of the equal rows that wait for it."""
    home = str(tmp_path / "home")
    rows = [(1, 0, "equal text", None, None, NOW)] * 3 + [(1, 1, "  ", None, None, NOW), (2, 0, "other text", None, None, NOW)]
    for number, created in enumerate((NOW, NOW + dt.timedelta(hours=1))):  # the earlier set is replaced by an equal one
        write_batch(spark.createDataFrame([(*r[:5], created) for r in rows], process.CHUNK), f"{home}/worker/chunks", number)
    table = spark.createDataFrame([(1, "u"), (2, "none")], "id long, uploaded_by_user_id string")
    resolved = spark.createDataFrame([("u", 9)], "user_id string, provider_config_id long")
    done = shared.embed_missing(table, resolved, home, 0, hashing_embedder(8))
    assert sorted((r.document_id, r.chunk_index, r.embed_status, r.dim) for r in done.collect()) == [
        *[(1, 0, "embedded", 8)] * 3, (1, 1, "blank", None), (2, 0, "no_credential", None)]
