"""Keyed updates and inserts against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from folioflow.functions.embedding import vector_from_text, vector_to_text
from folioflow.operators import updates as U
from folioflow.schemas import CONTRACTS, migrated

NOW = dt.datetime(2024, 5, 1)


def test_last_value_that_is_not_null_wins_per_column(spark):
    rng = random.Random(2)
    changes = [(rng.choice([1, 1, 1, 1, 2, 3, 99]), t, rng.choice([None, f"s{t}"]), rng.choice([None, f"n{t}"]))
               for t in range(300)]
    state = {i: (f"old{i}", None if i == 3 else "keep") for i in range(1, 6)}
    want = dict(state)
    for key, _, status, note in changes:
        if key in want:
            want[key] = (status or want[key][0], note or want[key][1])
    df = spark.createDataFrame(changes, "id long, seq int, status string, notes string").repartition(7)
    base = spark.createDataFrame([(i, *v) for i, v in state.items()], "id long, status string, notes string")
    out = U.apply_updates(base, U.latest_changes(df, "id", ["seq"], ["status", "notes"]))
    assert {r.id: (r.status, r.notes) for r in out.collect()} == want
    assert out.columns == base.columns


def test_identities_are_dense_and_repeatable(spark):
    rows = spark.range(5000).select(F.col("id").alias("n"), F.lit("x").alias("v"))
    ids = U.assign_ids(rows.repartition(9), F.col("n"), F.lit(100))
    got = {r.n: r.id for r in ids.collect()}
    assert sorted(got.values()) == list(range(101, 5101))
    again = U.assign_ids(rows.repartition(3), F.col("n"), F.lit(100))
    assert got == {r.n: r.id for r in again.collect()}
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 2


def test_insert_fills_defaults(spark):
    table = spark.createDataFrame([(7,)], "id int")
    rows = spark.createDataFrame(
        [("test_document.pdf", "store", "test/path/document.pdf", "PDF", "TextExtractionFailed", 0,
          NOW - dt.timedelta(minutes=15))],
        "processed_file_name string, storage_provider string, storage_path string, file_type string,"
        " status string, retry_count int, updated_at timestamp_ntz")
    contract = migrated(CONTRACTS["documents"])
    new = U.insert(table, rows, contract, F.col("processed_file_name"), NOW)
    assert new.columns == contract.schema.fieldNames()
    row = new.first()
    assert row.id == 8 and row.status == "TextExtractionFailed"
    assert row.updated_at == NOW - dt.timedelta(minutes=15) and row.created_at == NOW
    assert (row.original_file_name, row.file_size, row.summary, row.processing_notes) == ("", 0, "", "")
    assert row.text_extracted is None and row.description is None


def test_identities_go_beyond_32_bits_and_keys_may_repeat(spark):
    table = spark.createDataFrame([(1 << 40,)], "id long")
    rows = spark.createDataFrame([("same",), ("same",), ("other",)], "processed_file_name string")
    new = U.insert(table, rows, migrated(CONTRACTS["documents"]), F.col("processed_file_name"), NOW)
    assert sorted(r.id for r in new.collect()) == [(1 << 40) + k for k in (1, 2, 3)]
    none = U.insert(table.limit(0), rows, migrated(CONTRACTS["documents"]), F.col("processed_file_name"), NOW)
    assert sorted(r.id for r in none.collect()) == [1, 2, 3]


def test_status_defaults_when_left_out(spark):
    rows = spark.createDataFrame([(1, "f")], "id int, processed_file_name string")
    row = U.with_defaults(rows, CONTRACTS["documents"], NOW).first()
    assert row.status == "Uploaded" and row.uploaded_at == NOW
    config = U.with_defaults(spark.createDataFrame([(1,)], "id int"), CONTRACTS["a_i_configurations"], NOW)
    assert (config.first().max_tokens, config.first().temperature) == ("4000", "0.7")
    provider = U.with_defaults(
        spark.createDataFrame([(1,)], "id int"), CONTRACTS["a_i_provider_configs"], NOW)
    assert provider.first().is_enabled is True


def test_vector_write_back_keeps_the_rest(spark):
    chunks = spark.createDataFrame(
        [(1, 0, None), (1, 1, [9.0])], "document_id long, chunk_index int, embedding array<float>")
    vectors = spark.createDataFrame(
        [(1, 0, [1.0, 2.0])], "document_id long, chunk_index int, embedding array<float>")
    out = U.write_vectors(chunks, vectors, ["document_id", "chunk_index"]).orderBy("chunk_index").collect()
    assert [r.embedding for r in out] == [[1.0, 2.0], [9.0]]


def test_vector_text(spark):
    df = spark.createDataFrame([([1.5, -0.25, 1e-7],)], "v array<double>")
    row = df.select(vector_to_text(F.col("v")).alias("t"), vector_from_text(vector_to_text(F.col("v"))).alias("b")).first()
    assert row.t == "[1.5,-0.25,1.0E-7]" and row.b == [1.5, -0.25, 1e-7]
