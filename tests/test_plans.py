"""The plans the operators should have, and results under heavy skew."""

import pytest
from pyspark.sql import functions as F

from folioflow.operators import chunks as C
from folioflow.operators import contracts as G
from folioflow.operators import embeddings as E
from folioflow.operators import lifecycle as L
from folioflow.operators import metrics as M
from folioflow.operators import updates as U
from folioflow.plans.fixtures import NOW
from folioflow.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """State tables as files, so that scans show what they read."""
    root = str(tmp_path_factory.mktemp("stored"))
    spark.sql(
        "SELECT id, 'TextExtractionFailed' AS status, CAST(id % 5 AS INT) AS retry_count,"
        " 'p' AS storage_path, 'PDF' AS file_type, repeat('x', 50) AS text_extracted,"
        " TIMESTAMP_NTZ'2024-01-01' AS updated_at, TIMESTAMP_NTZ'2024-01-01' AS processing_started_at"
        " FROM range(100)").write.parquet(f"{root}/documents")
    spark.sql("SELECT id AS document_id, 1 AS chunk_index, 'c' AS content,"
              " array(1.0f, 2.0f) AS embedding, 2 AS dim FROM range(100)").write.parquet(f"{root}/chunks")
    return spark.read.parquet(f"{root}/documents"), spark.read.parquet(f"{root}/chunks")


def test_metrics_read_no_texts(stored):
    docs, chunks = stored
    text = plan(M.metrics_snapshot(docs, chunks, NOW))
    assert not any(c in text for c in ["text_extracted", "content", "array<float>"])
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<status:string,retry_count:int" in text


def test_candidates_are_filtered_in_the_scan_and_never_fully_sorted(stored):
    docs, _ = stored
    text = plan(L.retry_candidates(docs, NOW, limit=10))
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(status,TextExtractionFailed)" in text and "LessThan(updated_at" in text
    assert "Sort" not in plan(L.retry_candidates(docs, NOW))
    assert "Exchange" not in plan(L.fail_stuck(docs, NOW))


def test_backlog_is_filtered_in_the_scan(stored):
    docs, chunks = stored
    text = plan(E.embedding_backlog(chunks, docs.withColumn("uploaded_by_user_id", F.lit("u"))))
    assert "IsNull(dim)" in text and "array<float>" not in text


def test_no_operator_multiplies_rows_blindly(stored):
    docs, chunks = stored
    for df in [M.metrics_snapshot(docs, chunks, NOW), C.chunk_sweep(docs, id_col="id", text_col="text_extracted")]:
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


@pytest.mark.parametrize("name,times", [
    ("chunk_sweep", 1), ("chunk_stats_by_lang", 1), ("build_chunk_table", 2), ("chunk_replace", 0),
    ("embed_hash", 1), ("backfill_vectors", 1), ("vector_write_back", 1), ("vector_topk_ivf", 1),
])
def test_batch_functions_run_once(spark, sf_dir, name, times):
    assert plan(QUERIES[name](spark, sf_dir)).count("ArrowEvalPython [") == times


def test_a_third_of_the_rows_on_one_key(spark):
    """Joins that split the hot key must still return everything."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
        chunks = spark.range(0, n, 1, 8).select(
            hot.alias("document_id"), F.col("id").cast("int").alias("chunk_index"),
            F.md5(F.col("id").cast("string")).alias("content"),
            F.lit(None).cast("array<float>").alias("embedding"))
        docs = spark.range(5000).select("id", (F.col("id") % 10).cast("string").alias("uploaded_by_user_id"))
        backlog = E.embedding_backlog(chunks, docs)
        assert backlog.count() == n and backlog.select("chunk_index").distinct().count() == n
        fresh = spark.createDataFrame([(5, 0, "new", None)], chunks.schema)
        kept = n - chunks.where("document_id = 5").count()
        assert C.replace_chunks(chunks, fresh).count() == kept + 1
        after, _ = G.delete_rows(
            {"documents": docs, "document_chunks": chunks.withColumn("id", F.col("chunk_index"))},
            "documents", docs.where("id = 7").select("id"))
        assert after["document_chunks"].count() == chunks.where("document_id <> 7").count()
        changes = chunks.select(F.col("document_id").alias("id"), F.col("chunk_index").alias("seq"),
                                F.col("content").alias("uploaded_by_user_id"))
        latest = U.latest_changes(changes, "id", ["seq"], ["uploaded_by_user_id"])
        assert "partial_max" in plan(latest)
        assert U.apply_updates(docs, latest).count() == 5000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
