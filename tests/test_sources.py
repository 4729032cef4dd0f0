"""Queue lines, stored objects and batch folders."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators.process import process_documents
from folioflow.sources import batches as B
from folioflow.sources import queue as Q
from folioflow.sources.blobs import fetch, read_blobs
from folioflow.sources.objects import ObjectStore, dealt_by_bytes, fetch_objects, put_objects, take_inventory

LINES = [
    ('{"DocumentId": 7, "StoragePath": "a", "FileType": "PDF"}', "valid", None),
    ('{"DocumentId": "7", "StoragePath": "a"}', "valid", None),
    ('\t {"FileType": null, "StoragePath": "a", "DocumentId": 9, "More": {"x": [1]}} ', "valid", None),
    ('{"DocumentId": 7, "StoragePath": ""}', "failed", "no_storage_path"),
    ('{"DocumentId": 7}', "failed", "no_storage_path"),
    ('{"DocumentId": 0, "StoragePath": "a"}', "dead_letter", "no_document_id"),
    ('{"DocumentId": "", "StoragePath": "a"}', "dead_letter", "no_document_id"),
    ('{"DocumentId": null, "StoragePath": "a"}', "dead_letter", "no_document_id"),
    ('{"DocumentId": false, "StoragePath": "a"}', "dead_letter", "no_document_id"),
    ('{"StoragePath": "a"}', "dead_letter", "no_document_id"),
    ("{}", "dead_letter", "no_document_id"),
    ('{"DocumentId": "x", "StoragePath": "a"}', "dead_letter", "bad_document_id"),
    ('{"DocumentId": 7, "StoragePath": "a"', "dead_letter", "bad_json"),
    ('{"DocumentId": 7, "StoragePath": "a"} tail', "dead_letter", "bad_json"),
    ('{"DocumentId": 7},{"DocumentId": 8}', "dead_letter", "bad_json"),
    ("", "dead_letter", "bad_json"),
    ("nonsense", "dead_letter", "bad_json"),
    ("[7]", "dead_letter", "not_an_object"),
    ('[{"DocumentId": 7}]', "dead_letter", "not_an_object"),
    ("7", "dead_letter", "not_an_object"),
    ('"text"', "dead_letter", "not_an_object"),
    ("null", "dead_letter", "not_an_object"),
]


def test_routes(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(LINES)], "i int, value string")
    got = {r.i: r for r in Q.parse_messages(df).collect()}
    for i, (value, route, reason) in enumerate(LINES):
        assert (got[i].route, got[i].reason) == (route, reason), value
        try:
            json.loads(value)
        except json.JSONDecodeError:
            assert reason == "bad_json"
        else:
            assert reason != "bad_json"
    assert got[1].document_id == 7 and got[3].document_id == 7


def test_deliverable_keeps_one_message_per_document(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in LINES], "value string")
    rows = sorted((r.document_id, r.storage_path) for r in Q.deliverable(Q.parse_messages(df)).collect())
    assert rows == [(7, "a"), (9, "a")]


def test_the_last_message_of_a_document_wins(spark, tmp_path):
    def message(path):
        return json.dumps({"DocumentId": 1, "StoragePath": path, "FileType": "TXT"}) + "\n"

    (tmp_path / "b.txt").write_text(message("z/old") + message("y/old"))
    os.utime(tmp_path / "b.txt", (1000, 1000))
    (tmp_path / "a.txt").write_text(message("x/mid") + message("a/new") + "bad\n")
    os.utime(tmp_path / "a.txt", (2000, 2000))
    lines, order = Q.numbered(Q.read_messages(spark, str(tmp_path)))
    [last] = Q.deliverable(Q.parse_messages(lines), order).collect()
    assert (order, last.storage_path) == (["sent", "line"], "a/new")


@pytest.fixture
def objects(tmp_path):
    root = tmp_path / "objects"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt").write_bytes("olá\r\nmundo".encode())
    (root / "sub" / "b.txt").write_bytes("olá".encode("latin-1"))
    (root / "big.txt").write_bytes(b"x" * 101)
    (root / "edge.txt").write_bytes(b"y" * 100)
    return str(root)


def test_objects_over_the_limit_are_listed_but_not_read(spark, objects):
    rows = {r.path: r for r in read_blobs(spark, objects, 100).collect()}
    assert set(rows) == {"a.txt", "sub/b.txt", "big.txt", "edge.txt"}
    assert rows["big.txt"].length == 101 and rows["big.txt"].content is None
    assert bytes(rows["edge.txt"].content) == b"y" * 100


def stores(spark, root, tmp_path):
    """The same objects with and without an inventory."""
    path = str(tmp_path / f"inventory-{uuid.uuid4().hex}")
    take_inventory(spark, root).write.parquet(path)
    return [ObjectStore(root), ObjectStore(root, spark.read.parquet(path))]


def test_only_wanted_objects_are_opened(spark, objects, tmp_path):
    names = ["a.txt", "big.txt", "gone.txt", None, "", "../objects/a.txt", "/a.txt", "sub", "a.txt", "sub/b.txt"]
    rows = spark.createDataFrame([(i, p, i != 8) for i, p in enumerate(names)], "id long, storage_path string, content_wanted boolean")
    text = "olá\r\nmundo".encode()
    for store in stores(spark, objects, tmp_path):
        found = fetch_objects(rows, store, 100, F.col("content_wanted"))
        got = {r.id: (r.length, None if r.content is None else bytes(r.content)) for r in found.collect()}
        assert got == {0: (11, text), 1: (101, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None),
                       6: (None, None), 7: (None, None), 8: (11, None), 9: (3, "olá".encode("latin-1"))}
        assert "content" not in found.select("id", "length").columns
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()


def test_ten_thousand_and_one_paths_are_opened_by_key(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "many")
    rows = spark.range(10_001).select(F.format_string("d%d/%d.txt", F.col("id") % 7, "id").alias("path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    inventory = put_objects(rows.repartition(4), root)
    inventory.write.parquet(str(tmp_path / "listed"))
    wanted = rows.select(F.col("path").alias("storage_path"))
    monkeypatch.setattr(type(spark.read), "format", lambda *_: pytest.fail("the store was listed"))
    for store in (ObjectStore(root), ObjectStore(root, spark.read.parquet(str(tmp_path / "listed")))):
        found = fetch_objects(wanted, store)
        assert found.where("decode(content, 'UTF-8') = regexp_extract(storage_path, '([0-9]+).txt', 1)").count() == 10_001


def test_tasks_are_dealt_equal_bytes_and_contents_stay_where_they_were_read(spark, objects, tmp_path):
    sizes = [(f"p{i}", 1 << (10 + i % 15)) for i in range(3000)]
    rows = spark.createDataFrame(sizes, "storage_path string, length long")
    parts = dealt_by_bytes(rows, F.col("length"), F.col("storage_path")).groupBy(F.spark_partition_id()).agg(F.sum("length")).collect()
    shares = [r[1] for r in parts]
    assert len(shares) == 4 and max(shares) < 1.2 * min(shares)
    messages = spark.createDataFrame([(1, "a.txt", "TXT"), (2, "sub/b.txt", "PDF")], "document_id long, storage_path string, file_type string")
    for store in stores(spark, objects, tmp_path):
        plan = process_documents(messages, store)._jdf.queryExecution().executedPlan().toString()
        reading = plan.index("MapInArrow")
        assert "Exchange" not in plan[:reading] and "Exchange" in plan[reading:]


def test_processing_stored_objects(spark, objects, tmp_path):
    messages = spark.createDataFrame(
        [(1, "a.txt", "TXT"), (2, "sub/b.txt", "txt"), (3, "big.txt", "TXT"), (4, "edge.txt", "TXT"),
         (5, "gone.txt", "TXT"), (6, None, "TXT"), (7, "a.txt", "PDF"), (8, "edge.txt", "CSV")],
        "document_id long, storage_path string, file_type string",
    )
    assert fetch(messages, read_blobs(spark, objects, 100)).count() == 8
    pages = spark.createDataFrame(
        [(7, 1, "", "scanned"), (99, 1, "elsewhere", "")],
        "document_id long, page int, page_text string, ocr_text string",
    )

    def run(**options):
        whole, *others = (
            process_documents(messages, blobs, pages, max_bytes=100, **options)
            for blobs in (read_blobs(spark, objects, 100), *stores(spark, objects, tmp_path))
        )
        rows = {r.document_id: r for r in whole.collect()}
        assert all({r.document_id: r for r in other.select(*whole.columns).collect()} == rows for other in others)
        return rows

    got = run()
    assert {i: (r.status, r.error, r.decoded_as) for i, r in got.items()} == {
        1: ("Processed", None, "utf-8"),
        2: ("Processed", None, "latin-1"),
        3: ("TextExtractionFailed", "too_large", None),
        4: ("Processed", None, "utf-8"),
        5: ("TextExtractionFailed", "not_found", None),
        6: ("TextExtractionFailed", "no_storage_path", None),
        7: ("Processed", None, None),
        8: ("TextExtractionFailed", "not_extracted", None),
    }
    assert got[1].text == "olá\nmundo" and got[2].text == "olá"
    assert got[7].text == "--- Página 1 (OCR) ---\nscanned"
    assert run(parity=True)[8].status == "Processed" and run(parity=True)[8].text == ""
    assert run(complete=True)[8].text == "y" * 100


def test_error_phrase_fails_only_in_parity(spark, tmp_path):
    (tmp_path / "e.txt").write_text(X.ERROR_MARKER + ": broken")
    messages = spark.createDataFrame(
        [(1, "e.txt", "TXT")], "document_id long, storage_path string, file_type string")
    blobs = read_blobs(spark, str(tmp_path))
    assert process_documents(messages, blobs).first().status == "Processed"
    row = process_documents(messages, blobs, parity=True).first()
    assert (row.status, row.error, row.text) == ("TextExtractionFailed", "extraction_error", None)


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "document_id long, content string"
    assert B.read_batches(spark, path, spark.createDataFrame([], schema).schema).count() == 0

    def put(rows, number):
        B.write_batch(spark.createDataFrame(rows, schema), path, number)

    put([(1, "a"), (1, "b"), (2, "c")], 0)
    put([(1, "z")], 3)
    put([(1, "z")], 3)
    put([], 4)
    rows = B.read_batches(spark, path, spark.createDataFrame([], schema).schema)
    assert rows.count() == 4
    last = B.latest_set(rows).orderBy("document_id").collect()
    assert [(r.document_id, r.content) for r in last] == [(1, "z"), (2, "c")]
    B.compact(rows, str(tmp_path / "new"), 3)
    put([(2, "y")], 5)  # a later batch of the old table does not matter to the new one
    folded = B.read_batches(spark, str(tmp_path / "new"), spark.createDataFrame([], schema).schema)
    assert sorted((r.document_id, r.content, r.batch_id) for r in folded.collect()) == [
        (1, "z", 3), (2, "c", 3)]


def test_queue_files(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "1.txt").write_text('{"DocumentId":1,"StoragePath":"p"}\nbad\n')
    parsed = Q.parse_messages(Q.read_messages(spark, str(tmp_path / "q")))
    assert sorted(r.route for r in parsed.collect()) == ["dead_letter", "valid"]
    assert parsed.where(F.col("document_id") == 1).count() == 1


def test_odd_names_and_roots_are_found(spark, tmp_path):
    root = tmp_path / "my store 50%20+é"
    names = ["a b.txt", "c+d%20é.txt", "plain.txt"]
    for name in names:
        (root / "x").mkdir(parents=True, exist_ok=True)
        (root / "x" / name).write_text(name)
    wanted = spark.createDataFrame([(f"x/{name}",) for name in names[:2]], "storage_path string")
    whole = fetch(wanted, read_blobs(spark, str(root), 100))
    for found in [whole, *(fetch_objects(wanted, store) for store in stores(spark, str(root), tmp_path))]:
        assert {(r.storage_path, bytes(r.content).decode()) for r in found.collect()} == {(f"x/{n}", n) for n in names[:2]}
