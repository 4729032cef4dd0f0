"""One state for all four roles, below a home folder.

    worker/    batches of the queue worker
    cycles/    batches of the retry cycles
    vectors/   batches of the embedding backfill

A role only appends its own batches and never rewrites another's. The current documents
and chunks are the base tables with all batches applied in the order of their moments, so
whatever one role writes every other role reads on its next turn.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.embedding import EmbedFn
from folioflow.functions.text import is_blank
from folioflow.jobs import process, reprocess
from folioflow.operators.embeddings import content_hash
from folioflow.operators.updates import apply_updates, latest_changes, write_vectors
from folioflow.sources.batches import latest_set
from folioflow.sources.levels import read_levels
from folioflow.streaming.jobs import VECTOR_KEY, Rows, backfill_pass, backfilled

ROLES = ["worker", "cycles"]


def _written(spark: SparkSession, home: str, name: str, schema, upto: int | None) -> DataFrame:
    """A table of the worker's and the cycles' batches; of cycles only those before ``upto``."""
    parts = [
        read_levels(spark, f"{home}/{role}/{name}", schema).withColumn("role", F.lit(k))
        for k, role in enumerate(ROLES)
    ]
    if upto is not None:
        parts[1] = parts[1].where(F.col("batch_id") < upto)
    return reduce(DataFrame.unionByName, parts)


def documents(
    base: DataFrame, home: str, upto: int | None = None, texts: bool = False
) -> DataFrame:
    """The base documents with what the worker and the cycles (before ``upto``) wrote.

    Extracted texts are joined in only when asked for.
    """
    spark = base.sparkSession
    worker = process.current_states(spark, f"{home}/worker").select(
        F.col("document_id").alias("id"), "status", "processing_started_at", "updated_at",
        F.lit(0).alias("role"),
    )
    cycles = reprocess.latest_states(
        spark, f"{home}/cycles", (1 << 62) if upto is None else upto
    ).select("id", *reprocess.CHANGED, F.lit(1).alias("role"))
    both = worker.unionByName(cycles, allowMissingColumns=True)
    columns = [c for c in both.columns if c not in ("id", "role") and c in base.columns]
    now = apply_updates(base, latest_changes(both, "id", ["updated_at", "role"], columns))
    if not texts:
        return now
    found = _written(spark, home, "outcomes", process.TEXT, upto).where("text IS NOT NULL")
    last = latest_set(found, order=["updated_at", "role", "batch_id"]).select(
        F.col("document_id").alias("id"), F.col("text").alias("text_extracted"), "summary"
    )
    return apply_updates(now, last.select("id", *[c for c in last.columns[1:] if c in now.columns]))


def _hashed_sets(spark: SparkSession, home: str) -> DataFrame:
    """All chunk sets. What is asked of a content is told in the scan, so that contents need not move for it."""
    sets = _written(spark, home, "chunks", process.CHUNK, None)
    return sets.withColumns({"content_hash": content_hash(), "blank": is_blank(F.col("content"))})


def _with_vectors(spark: SparkSession, home: str, sets: DataFrame) -> DataFrame:
    current = latest_set(sets, order=["created_at", "role", "batch_id"]).drop("role", "batch_id")
    vectors = backfilled(spark, f"{home}/vectors").where("dim IS NOT NULL")
    return write_vectors(current, vectors.drop("batch_id"), VECTOR_KEY)


def chunks(spark: SparkSession, home: str) -> DataFrame:
    """The last chunk set of every document, with the vectors made of its present contents."""
    return _with_vectors(spark, home, _hashed_sets(spark, home)).drop("content_hash", "blank")


def cycle(
    base: DataFrame, blobs: process.Blobs, home: str, number: int, now: dt.datetime, **options
) -> DataFrame:
    """One retry cycle over the shared documents, the worker's failures and dead attempts included."""
    return reprocess.run_cycle(
        documents(base, home, upto=number), blobs, f"{home}/cycles", number, now, whole=True,
        **options,
    )


def embed_missing(
    base: DataFrame, resolved: Rows, home: str, number: int, embed_fn: EmbedFn | None, **options
) -> DataFrame:
    """One backfill pass over the shared chunks."""
    spark = base.sparkSession
    sets = _hashed_sets(spark, home)
    return backfill_pass(
        _with_vectors(spark, home, sets.drop("content", "embedding")), base, resolved, f"{home}/vectors", number,
        embed_fn, contents=sets.select(*VECTOR_KEY, "content"), **options,
    )
