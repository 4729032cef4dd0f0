"""Streams must equal their batch twins, whatever the micro-batches or replays."""

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioflow.functions.embedding import hashing_embedder
from folioflow.jobs import process as P
from folioflow.operators import embeddings as E
from folioflow.operators.chunks import build_chunk_table
from folioflow.operators.process import process_documents
from folioflow.sources import queue as Q
from folioflow.sources.batches import read_batches
from folioflow.sources.blobs import read_blobs
from folioflow.sources.objects import ObjectStore
from folioflow.streaming import jobs as J

NOW = dt.datetime(2024, 5, 1)
T0 = dt.datetime(2024, 5, 1, 8, 0)


def rows_of(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture
def queue(tmp_path):
    """Five queue files; document 3 is queued twice and one line is broken."""
    objects = tmp_path / "objects"
    objects.mkdir()
    for i in range(12):
        (objects / f"{i}.txt").write_text(f"Document {i}. " + "Some words, and more. " * (40 * i))
    folder = tmp_path / "queue"
    folder.mkdir()
    for n in range(5):
        lines = [json.dumps({"DocumentId": i + 1, "StoragePath": f"{i}.txt", "FileType": "TXT"})
                 for i in range(12) if i % 5 == n]
        if n in (0, 4):
            lines.append(json.dumps({"DocumentId": 3, "StoragePath": "2.txt", "FileType": "TXT"}))
        if n == 1:
            lines += ["broken", json.dumps({"DocumentId": 77, "StoragePath": "gone", "FileType": "TXT"})]
        (folder / f"{n}.txt").write_text("\n".join(lines) + "\n")
    return str(folder), str(objects)


def test_ingest_equals_batch_and_survives_replay(spark, queue, tmp_path):
    folder, objects = queue
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    embed = hashing_embedder(8)

    def run(checkpoint):
        lines = Q.stream_messages(spark, folder, files_per_trigger=1)
        query = J.ingest(lines, ObjectStore(objects), out, checkpoint, seconds=None,
                         clock=lambda: NOW, embed_fn=embed, sweep_every=2)
        query.awaitTermination()

    run(checkpoint)
    chunk_columns = ["document_id", "chunk_index", "content", "embedding"]
    first = rows_of(P.current_chunks(spark, out), *chunk_columns)

    parsed = Q.parse_messages(Q.read_messages(spark, folder))
    outcomes = process_documents(Q.deliverable(parsed), read_blobs(spark, objects))
    processed = outcomes.where("status = 'Processed'")
    twin = build_chunk_table(processed, embed, NOW, "document_id")
    assert first == rows_of(twin, *chunk_columns)
    assert rows_of(P.current_states(spark, out), "document_id", "status", "error") == rows_of(
        outcomes, "document_id", "status", "error")
    assert P.current_states(spark, out).where(F.col("processing_started_at") != NOW).count() == 0
    assert [r.value for r in P.current_dead_letters(spark, out).collect()] == ["broken"]

    run(checkpoint)  # nothing new
    assert rows_of(P.current_chunks(spark, out), *chunk_columns) == first
    run(str(tmp_path / "fresh"))  # every micro-batch again, from the start
    assert rows_of(P.current_chunks(spark, out), *chunk_columns) == first
    assert P.current_dead_letters(spark, out).count() == 1


def test_sweep_fails_what_began_and_never_ended(spark, tmp_path):
    out = str(tmp_path / "out")
    state = spark.createDataFrame(
        [(1, "ExtractingText", None, T0, T0), (2, "ExtractingText", None, T0, T0)], P.STATE)
    state.write.parquet(f"{out}/started/batch_id=0")
    ended = spark.createDataFrame([(2, "Processed", None, T0, T0)], P.STATE)
    ended.write.parquet(f"{out}/states/batch_id=0")
    P.sweep_stuck(spark, out, 0, T0 + dt.timedelta(minutes=30))
    assert rows_of(P.current_states(spark, out), "document_id", "status") == [
        "Row(document_id=1, status='ExtractingText')", "Row(document_id=2, status='Processed')"]
    late = T0 + dt.timedelta(minutes=31)
    for _ in range(2):  # a replayed sweep finds the same
        P.sweep_stuck(spark, out, 1, late)
    got = {r.document_id: (r.status, r.error, r.updated_at) for r in P.current_states(spark, out).collect()}
    assert got == {1: ("TextExtractionFailed", "stuck", late), 2: ("Processed", None, T0)}


def test_new_text_replaces_all_old_chunks(spark, tmp_path):
    objects, out = tmp_path / "o", str(tmp_path / "out")
    objects.mkdir()
    line = '{"DocumentId":1,"StoragePath":"a.txt","FileType":"TXT"}'
    lines = spark.createDataFrame([(line,)], "value string")
    for number, text in enumerate(["long words " * 400, "just one small chunk"]):
        (objects / "a.txt").write_text(text)
        P.process_batch(lines, number, read_blobs(spark, str(objects)), out, NOW)
    assert [r.content for r in P.current_chunks(spark, out).collect()] == ["just one small chunk"]
    (objects / "a.txt").write_text("   ")  # nothing to chunk: the old chunks stay
    P.process_batch(lines, 2, read_blobs(spark, str(objects)), out, NOW)
    assert P.current_chunks(spark, out).count() == 1


def changes(minutes_and_states):
    return [(i, s, T0 + dt.timedelta(minutes=m)) for i, s, m in minutes_and_states]


def stuck_by_hand(rows, minutes=30):
    last = {}
    for i, s, t in sorted(rows, key=lambda r: (r[2], r[1])):
        last[i] = (s, t)
    end = max(t for _, _, t in rows)
    return sorted((i, t) for i, (s, t) in last.items()
                  if s == "ExtractingText" and t < end - dt.timedelta(minutes=minutes))


def test_stuck_stream_equals_batch(spark, tmp_path):
    schema = "id long, status string, updated_at timestamp_ntz"
    parts = [
        changes([(1, "ExtractingText", 0), (2, "ExtractingText", 1), (3, "ExtractingText", 2)]),
        changes([(1, "Processed", 10), (4, "ExtractingText", 12)] + [(9, "ExtractingText", k / 50) for k in range(500)]),
        changes([(5, "ExtractingText", 25), (2, "ExtractingText", 28)]),
        changes([(6, "Queued", 60), (5, "ExtractingText", 59)]),
    ]
    folder = tmp_path / "changes"
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n}")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    J.watch_stuck(stream, out, checkpoint, seconds=None, lateness="0 seconds", partitions=2).awaitTermination()
    found = sorted((r.id, r.stuck_since) for r in J.found_stuck(spark, out).collect())
    assert found == stuck_by_hand([r for part in parts for r in part])
    assert all(r.status == "TextExtractionFailed" for r in J.found_stuck(spark, out).collect())


class FakeEngine:
    """Just enough of the engine's state, timers and clock to drive the processor by hand."""

    def __init__(self, now_ms):
        self.value, self.now, self.timers = None, now_ms, []

    def getValueState(self, *_):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.append(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


def test_clock_timers():
    engine, watch = FakeEngine(now_ms=100_000), J.StuckWatch(30, event_time=False)
    watch.init(engine)

    def feed(*rows):
        frame = pd.DataFrame(rows, columns=["micros", "status"])
        return list(watch.handleInputRows((7,), iter([frame]), engine))

    def ring():
        engine.now = engine.timers.pop()
        return list(watch.handleExpiredTimer((7,), engine, engine))

    assert feed((40_000_000, "ExtractingText")) == [] and engine.timers == [40_000 + 30 * 60_000]
    assert feed((30_000_000, "Processed")) == [] and engine.value[:2] == (40_000_000, True)  # older news
    feed((50_000_000, "Processed"))
    feed((45_000_000, "ExtractingText"))
    assert engine.value[:2] == (50_000_000, False) and engine.timers == [50_000 + 30 * 60_000]
    feed((60_000_000, "ExtractingText"), (55_000_000, "Processed"))
    [found] = ring()
    assert found.to_dict("list") == {"id": [7], "since": [60_000_000]} and engine.value is None
    feed((70_000_000, "Processed"))
    assert ring() == [] and engine.value is None
    watch.handleInitialState((7,), pd.DataFrame({"micros": [80_000_000], "status": ["ExtractingText"]}), engine)
    engine.value = (80_000_000, True, engine.timers[-1] + 5)  # a timer that was replaced meanwhile
    assert ring() == [] and engine.value is not None


def test_a_watch_starts_from_a_table(spark, tmp_path):
    schema = "id long, status string, updated_at timestamp_ntz"
    known = spark.createDataFrame(changes([(1, "ExtractingText", 0), (2, "Processed", 1), (3, "ExtractingText", 2)]), schema)
    folder = tmp_path / "changes"
    for n, rows in enumerate([changes([(3, "Processed", 20)]), changes([(4, "Queued", 60)]), changes([(4, "Queued", 61)])]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    out = str(tmp_path / "out")
    J.watch_stuck(stream, out, str(tmp_path / "c"), seconds=None, lateness="0 seconds", partitions=2, known=known).awaitTermination()
    assert [(r.id, r.stuck_since) for r in J.found_stuck(spark, out).collect()] == [(1, T0)]
    assert spark.conf.get("spark.sql.shuffle.partitions") != "2"
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")
    assert list((tmp_path / "c" / "state").rglob("*.zip"))  # RocksDB snapshots


def test_news_out_of_order_raise_no_alarm(spark, tmp_path):
    schema = "id long, status string, updated_at timestamp_ntz"
    parts = [
        changes([(1, "Processed", 10), (2, "ExtractingText", 8), (3, "Failed", 9)]),
        changes([(1, "ExtractingText", 5), (3, "ExtractingText", 8), (2, "ExtractingText", 3)]),
        changes([(9, "Processed", 300)]),
        changes([(9, "Processed", 301)]),
    ]
    folder = tmp_path / "changes"
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n}")
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    J.watch_stuck(stream, out, str(tmp_path / "c"), seconds=None, lateness="1 hour", partitions=2).awaitTermination()
    assert [(r.id, r.stuck_since) for r in J.found_stuck(spark, out).collect()] == [(2, T0 + dt.timedelta(minutes=8))]


def test_backfill_equals_batch(spark, tmp_path):
    schema = "document_id long, chunk_index int, content string, embedding array<float>"
    rows = [(i, k, "" if (i + k) % 7 == 0 else f"words {i} {k}", [1.0] if k == 0 else None)
            for i in range(8) for k in range(5)]
    folder = tmp_path / "chunks"
    for n in range(4):
        spark.createDataFrame([r for r in rows if r[0] % 4 == n], schema).coalesce(1).write.parquet(f"{folder}/{n}")
    docs = spark.createDataFrame([(i, f"u{i % 3}") for i in range(7)], "id long, uploaded_by_user_id string")
    resolved = spark.createDataFrame([("u1", 11)], "user_id string, provider_config_id long")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
        J.backfill(stream, docs, resolved, out, checkpoint, hashing_embedder(16), seconds=None).awaitTermination()

    run(checkpoint)
    run(str(tmp_path / "again"))
    plan = E.plan_backfill(E.embedding_backlog(spark.createDataFrame(rows, schema), docs), resolved, False)
    twin = E.run_backfill(plan, hashing_embedder(16))
    columns = ["document_id", "chunk_index", "embed_status", "credential_source", "dim", "embedding"]
    got = J.backfilled(spark, out)
    assert rows_of(got.where("embed_status != 'pending'"), *columns) == rows_of(twin, *columns)
    assert read_batches(spark, out, J.VECTORS).count() == twin.count() + 4 == 32
    assert [r.document_id for r in got.where("embed_status = 'pending'").collect()] == [7] * 4


def test_chunks_wait_for_their_document_and_credential(spark, tmp_path):
    schema = "document_id long, chunk_index int, content string, embedding array<float>"
    chunks, docs, out = (str(tmp_path / name) for name in ("chunks", "docs", "out"))

    def arrive(path, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    arrive(chunks, [(1, 0, "one", None), (1, 1, " ", None), (2, 0, "two", None), (3, 0, "three", None)], schema)
    arrive(docs, [(1, "u1"), (3, "u3")], "id long, uploaded_by_user_id string")
    known = [("u1", 11)]

    def resolved():
        return spark.createDataFrame(known, "user_id string, provider_config_id long")

    def stream():
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(chunks)
        J.backfill(rows, lambda: spark.read.parquet(docs), resolved, out, str(tmp_path / "c"),
                   hashing_embedder(16), seconds=None).awaitTermination()

    def states():
        return sorted((r.document_id, r.chunk_index, r.embed_status) for r in J.backfilled(spark, out).collect())

    def again(number):
        return J.backfill_pass(spark.read.parquet(chunks), spark.read.parquet(docs), resolved(), out, number, hashing_embedder(16))

    stream()
    assert states() == [(1, 0, "embedded"), (1, 1, "blank"), (2, 0, "pending"), (3, 0, "no_credential")]
    arrive(docs, [(2, "u2"), (4, "u1")], "id long, uploaded_by_user_id string")
    arrive(chunks, [(4, 0, "four", None)], schema)
    stream()  # a document that came after the stream began
    assert states()[-1] == (4, 0, "embedded")
    known += [("u2", 22), ("u3", 33)]
    for _ in range(2):  # replayed
        assert again(2).count() == 2
    assert [s for *_, s in states()] == ["embedded", "blank", "embedded", "embedded", "embedded"]
    assert again(3).count() == 0
