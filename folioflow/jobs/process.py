"""One batch of messages to texts, chunks and states, written as batch folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.embedding import VECTOR, EmbedFn
from folioflow.operators.chunks import build_chunk_table
from folioflow.operators.lifecycle import STUCK_MINUTES, stuck_documents
from folioflow.operators.process import process_documents
from folioflow.operators.updates import apply_updates
from folioflow.schemas import EXTRACTING, EXTRACTION_FAILED, PROCESSED
from folioflow.session import instant
from folioflow.sources.batches import latest_set, read_batches, write_batch
from folioflow.sources.levels import fold_batches, last_sets, read_levels
from folioflow.sources.objects import ObjectStore
from folioflow.sources.queue import dead_letters, deliverable, numbered, parse_messages

Blobs = DataFrame | ObjectStore | Callable[[DataFrame], DataFrame | ObjectStore]

STATE = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("processing_started_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
TEXT = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
CHUNK = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("content", T.StringType()),
    T.StructField("embedding", VECTOR),
    T.StructField("dim", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
])
DEAD_LETTER = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def _states(rows: DataFrame, at: dict) -> DataFrame:
    return rows.withColumns(at).select(*STATE.fieldNames())


def store_outcomes(
    messages: DataFrame,
    batch_id: int,
    blobs: Blobs,
    out: str,
    now: dt.datetime,
    embed_fn: EmbedFn | None = None,
    pages: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Fetch, extract and chunk the messages; returns their outcomes as stored.

    Outcomes are written once and read back by the steps after them, so losing an
    executor later never repeats the fetching.
    """
    objects = blobs(messages) if callable(blobs) else blobs
    outcomes = write_batch(
        process_documents(messages, objects, pages, **options).withColumn("updated_at", instant(now)),
        f"{out}/outcomes",
        batch_id,
    )
    processed = outcomes.where(F.col("status") == PROCESSED)
    chunks = build_chunk_table(processed, embed_fn, now, "document_id")
    write_batch(chunks, f"{out}/chunks", batch_id)
    return outcomes


def process_batch(
    lines: DataFrame,
    batch_id: int,
    blobs: Blobs,
    out: str,
    started: dt.datetime,
    finished: dt.datetime | None = None,
    **options,
) -> None:
    """Run one batch to its end; a replay of the same batch writes the same folders.

    ``blobs`` is a store to fetch from by key, a table of contents, or a function from the
    messages at hand to either; for the other options see :func:`store_outcomes`. Chunks are complete before a document is reported as
    processed.
    """
    lines, order = numbered(lines)
    parsed = parse_messages(lines)
    write_batch(dead_letters(parsed).select("value", "reason"), f"{out}/dead_letters", batch_id)
    begun = deliverable(parsed, order).withColumns({
        "status": F.lit(EXTRACTING),
        "error": F.lit(None).cast("string"),
        "processing_started_at": instant(started),
        "updated_at": instant(started),
    })
    messages = write_batch(begun, f"{out}/started", batch_id).select(
        "document_id", "storage_path", "file_type"
    )
    finished = finished or started
    outcomes = store_outcomes(messages, batch_id, blobs, out, finished, **options)
    write_batch(
        _states(outcomes, {
            "processing_started_at": instant(started),
            "updated_at": instant(finished),
        }),
        f"{out}/states",
        batch_id,
    )


def _written_states(spark: SparkSession, out: str) -> DataFrame:
    steps = ["started", "states", "sweeps"]
    tables = [
        read_levels(spark, f"{out}/{name}", STATE).withColumn("step", F.lit(i))
        for i, name in enumerate(steps)
    ]
    return reduce(DataFrame.unionByName, tables)


def _latest_states(written: DataFrame) -> DataFrame:
    latest = F.max(F.struct("batch_id", "step", "status", "error", "processing_started_at",
                            "updated_at"))
    return (
        written.groupBy("document_id")
        .agg(latest.alias("s"))
        .select("document_id", "s.status", "s.error", "s.processing_started_at", "s.updated_at")
    )


def current_states(spark: SparkSession, out: str) -> DataFrame:
    """The last state of every document, a begun or swept one included."""
    return _latest_states(_written_states(spark, out))


def sweep_stuck(
    spark: SparkSession, out: str, batch_id: int, now: dt.datetime, minutes: int = STUCK_MINUTES
) -> None:
    """Fail the documents whose extraction began too long ago and never ended."""
    earlier = ~((F.col("step") == 2) & (F.col("batch_id") >= batch_id))
    states = _latest_states(_written_states(spark, out).where(earlier))
    stuck = stuck_documents(
        states.withColumnRenamed("document_id", "id"), now, minutes,
        columns=["id", "processing_started_at"],
    )
    write_batch(
        _states(stuck.withColumnRenamed("id", "document_id"), {
            "status": F.lit(EXTRACTION_FAILED),
            "error": F.lit("stuck"),
            "updated_at": instant(now),
        }),
        f"{out}/sweeps",
        batch_id,
    )


def current_chunks(spark: SparkSession, out: str) -> DataFrame:
    return latest_set(read_levels(spark, f"{out}/chunks", CHUNK))


def current_texts(spark: SparkSession, out: str) -> DataFrame:
    return latest_set(read_levels(spark, f"{out}/outcomes", TEXT).where("text IS NOT NULL"))


def fold_outputs(spark: SparkSession, out: str) -> None:
    """Fold older batches, so that reading the current state does not grow with their number."""
    by_document = last_sets(["document_id"])
    for name, schema, fold in [
        *[(step, STATE, by_document) for step in ("started", "states", "sweeps")],
        ("chunks", CHUNK, by_document),
        ("outcomes", TEXT, lambda rows: by_document(rows.where("text IS NOT NULL"))),
    ]:
        fold_batches(spark, f"{out}/{name}", schema, ["document_id"], fold)


def updated_documents(documents: DataFrame, out: str) -> DataFrame:
    """The documents table with the states, texts and summaries written so far."""
    spark = documents.sparkSession
    texts = current_texts(spark, out).select(
        "document_id", F.col("text").alias("text_extracted"), "summary"
    )
    changes = current_states(spark, out).join(texts, "document_id", "left").select(
        F.col("document_id").alias("id"), "status", "updated_at", "processing_started_at",
        "text_extracted", "summary",
    )
    known = [c for c in changes.columns if c in documents.columns]
    return apply_updates(documents, changes.select(*known))


def current_dead_letters(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/dead_letters", DEAD_LETTER)
