"""The ledger's figures equal those of the whole state after every turn."""

import datetime as dt
import json

import pytest

from folioflow.functions.embedding import hashing_embedder
from folioflow.jobs import ledger, process, shared
from folioflow.operators import metrics as M
from folioflow.sources import buckets
from folioflow.sources.batches import write_batch
from folioflow.sources.objects import ObjectStore

NOW = dt.datetime(2024, 5, 1, 12)
DOC = ("id long, storage_path string, file_type string, status string, retry_count int, updated_at timestamp_ntz,"
       " processing_notes string, processing_started_at timestamp_ntz, uploaded_by_user_id string")


def at(hours):
    return NOW + dt.timedelta(hours=hours)


@pytest.fixture
def state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BUCKETS", 4)
    objects = tmp_path / "objects"
    objects.mkdir()
    for i in range(12):
        (objects / f"{i}.txt").write_text(f"Document {i}. " + "Some words, and more. " * (30 * i))
    rows = [(i, f"{i}.txt", "TXT", "Queued" if i % 3 else "TextExtractionFailed", None if i % 2 else 1, at(-5), None, None, "u") for i in range(16)]
    base = write_batch(spark.createDataFrame(rows, DOC), str(tmp_path / "base"), 0)
    resolved = spark.createDataFrame([("u", 1)], "user_id string, provider_config_id long")
    return base, str(tmp_path / "home"), ObjectStore(str(objects)), resolved


def figures(row):
    return {k: v for k, v in row.asDict().items() if k != "timestamp"}


def check(spark, base, home, number):
    out = ledger.advance(base, home, number)
    whole = M.metrics_snapshot(shared.documents(base, home), shared.chunks(spark, home), NOW).first()
    got = ledger.snapshot(spark, out, NOW).first()
    assert figures(got) == figures(whole)
    return got


def lines(spark, ids):
    rows = [(json.dumps({"DocumentId": i, "StoragePath": f"{i}.txt", "FileType": "TXT"}),) for i in ids]
    return spark.createDataFrame(rows, "value string")


def test_every_turn_equals_the_whole_state(spark, state):
    base, home, store, resolved = state
    first = check(spark, base, home, 1)
    assert (first.total_documents, first.failed_documents, first.total_chunks) == (16, 6, 0)

    process.process_batch(lines(spark, range(1, 9)), 0, store, f"{home}/worker", at(0), at(0.1))
    assert check(spark, base, home, 2).processed_documents == 8
    assert figures(check(spark, base, home, 3)) == figures(check(spark, base, home, 4))  # nothing new

    shared.embed_missing(base, resolved, home, 0, hashing_embedder(8))
    embedded = check(spark, base, home, 5)
    assert embedded.chunks_with_embeddings == embedded.total_chunks > 10

    shared.cycle(base, store, home, 1, at(3))
    assert check(spark, base, home, 6).chunks_with_embeddings < check(spark, base, home, 7).total_chunks

    # sets replaced by other contents lose their vectors, by the same contents keep them
    (store.root and open(f"{store.root}/3.txt", "w")).write("Another text altogether. " * 200)
    process.process_batch(lines(spark, [3, 4]), 1, store, f"{home}/worker", at(4))
    replaced = check(spark, base, home, 8)
    shared.embed_missing(base, resolved, home, 1, hashing_embedder(8))
    assert check(spark, base, home, 9).chunks_with_embeddings > replaced.chunks_with_embeddings

    process.process_batch(lines(spark, [3, 4]), 1, store, f"{home}/worker", at(4))  # replayed
    again = check(spark, base, home, 10)
    ledger.open_ledger(base, f"{home}/ledger")
    assert figures(check(spark, base, home, 11)) == figures(again)


@pytest.mark.parametrize("step", ["staged", "cells", "documents", "chunks"])
def test_a_turn_that_dies_is_finished_by_the_next(spark, state, monkeypatch, step):
    base, home, store, resolved = state
    check(spark, base, home, 1)
    process.process_batch(lines(spark, range(1, 9)), 0, store, f"{home}/worker", at(0), at(0.1))

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "staged":
            patch.setattr(ledger, "_stage_chunks", die)
        elif step == "cells":
            patch.setattr(ledger, "replace_in_buckets", die)
        elif step == "documents":
            patch.setattr(buckets, "_place", die)
        else:
            real = ledger.replace_in_buckets
            patch.setattr(ledger, "replace_in_buckets", lambda *a: die() if a[1].endswith("chunks") else real(*a))
        with pytest.raises(KeyboardInterrupt):
            ledger.advance(base, home, 2)
    check(spark, base, home, 3)
    shared.embed_missing(base, resolved, home, 0, hashing_embedder(8))
    check(spark, base, home, 4)


def test_a_turn_reads_new_batches_only(spark, state, monkeypatch):
    base, home, store, _ = state
    for n in range(3):
        process.process_batch(lines(spark, [1 + n, 5 + n]), n, store, f"{home}/worker", at(n))
        ledger.advance(base, home, n + 1)
    seen = []
    real = ledger.read_levels
    monkeypatch.setattr(ledger, "read_levels", lambda *a: seen.append(a[3:]) or real(*a))
    process.process_batch(lines(spark, [9]), 3, store, f"{home}/worker", at(3))
    ledger.advance(base, home, 4)
    assert (2,) in seen and all(since != (None,) for since in seen)
    opened = real(spark, f"{home}/worker/states", process.STATE, 2).inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in opened} == {"2", "3"}
