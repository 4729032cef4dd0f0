"""Document states: stuck detection, retries, permanent failure, statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.schemas import (
    EXTRACTING,
    EXTRACTION_FAILED,
    FAILED,
    FILE_TYPES,
    PROCESSED,
    STATUSES,
)
from folioflow.session import before, instant

STUCK_MINUTES = 30
COOL_DOWN_MINUTES = 10
MAX_RETRIES = 3
# Fixed value: the note a permanently failed document receives.
FAILURE_NOTE = (
    "\n[{now}] Documento marcado como permanentemente falhado"
    " após {attempts} tentativas de reprocessamento."
)


def domain_audit(docs: DataFrame) -> DataFrame:
    """Values outside the known states and file types, with their row counts."""
    pairs = F.array(
        F.struct(F.lit("status").alias("column"), F.col("status").alias("value")),
        F.struct(F.lit("file_type").alias("column"), F.col("file_type").alias("value")),
    )
    known = F.when(F.col("column") == "status", F.col("value").isin(STATUSES)).otherwise(
        F.col("value").isin(FILE_TYPES)
    )
    return (
        docs.select(F.inline(pairs))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("known", F.coalesce(known, F.lit(False)))
    )


def oldest_first(rows: DataFrame, limit: int | None) -> DataFrame:
    """The rows changed longest ago when limited; without a limit nothing needs sorting."""
    return rows if limit is None else rows.orderBy("updated_at", "id").limit(limit)


def stuck_documents(
    docs: DataFrame,
    now: dt.datetime,
    minutes: int = STUCK_MINUTES,
    limit: int | None = None,
    columns: Sequence[str] = ("id", "storage_path", "file_type", "updated_at"),
) -> DataFrame:
    rows = docs.where(
        (F.col("status") == EXTRACTING) & before(F.col("updated_at"), now, minutes)
    )
    return oldest_first(rows.select(*columns), limit)


def fail_stuck(
    docs: DataFrame, now: dt.datetime, minutes: int = STUCK_MINUTES
) -> DataFrame:
    """New snapshot with every stuck document failed: a projection, no join."""
    stuck = (F.col("status") == EXTRACTING) & before(F.col("updated_at"), now, minutes)
    return docs.withColumns({
        "status": F.when(stuck, F.lit(EXTRACTION_FAILED)).otherwise(F.col("status")),
        "updated_at": F.when(stuck, instant(now)).otherwise(F.col("updated_at")),
    })


def attempts() -> Column:
    return F.coalesce(F.col("retry_count"), F.lit(0))


def retry_candidates(
    docs: DataFrame,
    now: dt.datetime,
    max_retries: int = MAX_RETRIES,
    cool_down: int = COOL_DOWN_MINUTES,
    limit: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    rows = docs.where(
        (F.col("status") == EXTRACTION_FAILED)
        & before(F.col("updated_at"), now, cool_down)
        & (attempts() < max_retries)
    ).select(
        "id", "storage_path", "file_type", attempts().alias("retry_count"), "updated_at", *keep
    )
    return oldest_first(rows, limit)


def start_attempt(candidates: DataFrame, now: dt.datetime) -> DataFrame:
    """Count the attempt, and show the document as being extracted, before it is made."""
    return candidates.withColumns({
        "status": F.lit(EXTRACTING),
        "retry_count": (attempts() + 1).cast("int"),
        "updated_at": instant(now),
    })


def settle_attempts(
    attempted: DataFrame,
    now: dt.datetime,
    max_retries: int = MAX_RETRIES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Final state after an attempt.

    Needs ``id, retry_count`` (the attempt already counted), ``outcome`` (a state) and
    ``processing_notes``. Success is being Processed, nothing less.
    """
    gave_up = (F.col("outcome") != PROCESSED) & (F.col("retry_count") >= max_retries)
    note = F.concat(
        F.coalesce(F.col("processing_notes"), F.lit("")),
        F.lit(FAILURE_NOTE.format(now=now, attempts=max_retries)),
    )
    return attempted.select(
        "id",
        F.when(gave_up, F.lit(FAILED)).otherwise(F.col("outcome")).alias("status"),
        "retry_count",
        instant(now).alias("updated_at"),
        F.when(gave_up, note).otherwise(F.col("processing_notes")).alias("processing_notes"),
        *keep,
    )


def cycle_stats(settled: DataFrame) -> DataFrame:
    def tally(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")

    status = F.col("status")
    return settled.agg(
        F.count("*").alias("total_found"),
        tally(status == PROCESSED).alias("reprocessed_successfully"),
        tally(status != PROCESSED).alias("reprocessing_failed"),
        tally(status == FAILED).alias("permanently_failed"),
    )


def exhausted_limbo(docs: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed extractions with no attempts left that were never marked Failed."""
    return docs.where(
        (F.col("status") == EXTRACTION_FAILED) & (attempts() >= max_retries)
    ).select("id", attempts().alias("retry_count"), "updated_at")


def fail_exhausted(
    docs: DataFrame, now: dt.datetime, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """New snapshot with the documents of :func:`exhausted_limbo` marked Failed."""
    lost = (F.col("status") == EXTRACTION_FAILED) & (attempts() >= max_retries)
    return docs.withColumns({
        "status": F.when(lost, F.lit(FAILED)).otherwise(F.col("status")),
        "updated_at": F.when(lost, instant(now)).otherwise(F.col("updated_at")),
    })
