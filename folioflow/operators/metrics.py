"""Monitoring figures over documents and chunks.

Every document figure follows from one table of counts per (state, attempts):
a single narrow scan and one shuffle of a few rows per task.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.embedding import vector_marker
from folioflow.operators.lifecycle import MAX_RETRIES, attempts
from folioflow.schemas import EXTRACTION_FAILED, FAILED, PROCESSED
from folioflow.session import instant

# Report formats.
REPORT_FORMAT = (
    "Métricas de processamento: Total de documentos: %d, Processados: %d, Falhas: %d, "
    "Reprocessáveis: %d, Tempo médio: %.2fs, Chunks: %d, Embeddings: %d (%.2f%%)"
)
RETRY_FORMAT = "%d docs com %d tentativas"


def micros_between(end: Column, start: Column) -> Column:
    """Elapsed microseconds between time stamps without a zone, whatever the session's."""
    return ((end - start).cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("bigint")


def seconds_between(end: Column, start: Column) -> Column:
    return micros_between(end, start) / 1e6


def processing_micros() -> Column:
    """How long a processed document took; NULL for all others."""
    return F.when(
        F.col("status") == PROCESSED,
        micros_between(F.col("updated_at"), F.col("processing_started_at")),
    )


def timing(took: Column) -> list[Column]:
    """Exact sums: whole seconds apart from the rest, so no number of rows overflows."""
    return [
        F.sum(F.floor(took / 1_000_000)).alias("took_seconds"),
        F.sum(F.pmod(took, F.lit(1_000_000))).alias("took_rest"),
        F.count(took).alias("n_timed"),
    ]


def mean_seconds(seconds: Column, rest: Column, n: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(seconds + rest / 1e6, n), F.lit(0.0)), 6)


def percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))


def document_cells(docs: DataFrame) -> DataFrame:
    """Counts and summed processing time per (status, attempts)."""
    return docs.groupBy("status", attempts().alias("retry_count")).agg(
        F.count("*").alias("n"), *timing(processing_micros())
    )


def count_documents(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("total_documents"))


def docs_by_status(docs: DataFrame) -> DataFrame:
    return docs.groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "status")


def failed_by_retry(docs: DataFrame) -> DataFrame:
    return (
        docs.where(F.col("status") == EXTRACTION_FAILED)
        .groupBy(attempts().alias("retry_count"))
        .agg(F.count("*").alias("n"))
        .orderBy("retry_count")
    )


def reprocessable(docs: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    return docs.where(
        (F.col("status") == EXTRACTION_FAILED) & (attempts() < max_retries)
    ).agg(F.count("*").alias("reprocessable_documents"))


def mean_processing_time(docs: DataFrame) -> DataFrame:
    timed = docs.where(
        (F.col("status") == PROCESSED) & F.col("processing_started_at").isNotNull()
    ).agg(*timing(processing_micros()))
    return timed.select(
        mean_seconds(F.col("took_seconds"), F.col("took_rest"), F.col("n_timed")).alias(
            "avg_processing_time_seconds"
        )
    )


def total_failed(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("status").isin(FAILED, EXTRACTION_FAILED)).agg(
        F.count("*").alias("total_failed")
    )


def status_by_retry(docs: DataFrame) -> DataFrame:
    """Failure states by raw attempt count; rows never retried keep their NULL."""
    return (
        docs.where(F.col("status").isin(FAILED, EXTRACTION_FAILED))
        .groupBy("status", "retry_count")
        .agg(F.count("*").alias("n"))
    )


def embedding_progress(chunks: DataFrame, vector_col: str | None = None) -> DataFrame:
    """Chunk and vector counts; see :func:`vector_marker` for the column counted."""
    return chunks.agg(
        F.count("*").alias("total_chunks"),
        F.count(vector_col or vector_marker(chunks)).alias("chunks_with_embeddings"),
    ).withColumn(
        "embedding_completion_percent",
        F.round(percent(F.col("chunks_with_embeddings"), F.col("total_chunks")), 6),
    )


def status_count_map(docs: DataFrame) -> DataFrame:
    return document_summary(document_cells(docs)).select("status_counts", "failed_by_retry_count")


def document_summary(cells: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """One record from the counts per (status, attempts): a handful of rows.

    Documents without a status count in the total only; a map has no NULL key.
    """
    status, n = F.col("status"), F.col("n")
    failed = status == EXTRACTION_FAILED

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    by_status = cells.groupBy("status").agg(
        F.sum("n").alias("n"),
        F.sum("took_seconds").alias("took_seconds"),
        F.sum("took_rest").alias("took_rest"),
        F.sum("n_timed").alias("n_timed"),
        total(failed & (F.col("retry_count") < max_retries)).alias("reprocessable"),
        F.array_sort(F.collect_list(F.when(failed, F.struct("retry_count", "n")))).alias("retries"),
    )
    return by_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_documents"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(status.isNotNull(), F.struct("status", "n"))))).alias(
            "status_counts"
        ),
        F.map_from_entries(
            F.coalesce(
                F.max(F.when(failed, F.col("retries"))),
                F.array().cast("array<struct<retry_count:int,n:bigint>>"),
            )
        ).alias("failed_by_retry_count"),
        total(status == PROCESSED).alias("processed_documents"),
        total(status.isin(FAILED, EXTRACTION_FAILED)).alias("failed_documents"),
        F.coalesce(F.sum("reprocessable"), F.lit(0)).alias("reprocessable_documents"),
        mean_seconds(F.sum("took_seconds"), F.sum("took_rest"), F.sum("n_timed")).alias(
            "avg_processing_time_seconds"
        ),
    )


def metrics_snapshot(
    docs: DataFrame,
    chunks: DataFrame,
    now: dt.datetime,
    max_retries: int = MAX_RETRIES,
    vector_col: str | None = None,
) -> DataFrame:
    """All figures in one record: one narrow pass over each table."""
    figures = document_summary(document_cells(docs), max_retries)
    return joined_record(figures, embedding_progress(chunks, vector_col)).select(
        instant(now).alias("timestamp"), "*"
    )


def joined_record(*records: DataFrame) -> DataFrame:
    """Single rows of different figures as one row."""
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)
    return parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])


def report_lines(snapshot: DataFrame) -> DataFrame:
    """The figures as the two lines an operator reads in the log."""
    retries = F.transform(
        F.array_sort(F.map_entries("failed_by_retry_count")),
        lambda e: F.format_string(RETRY_FORMAT, e["value"], e["key"]),
    )
    return snapshot.select(
        F.format_string(
            REPORT_FORMAT,
            "total_documents", "processed_documents", "failed_documents",
            "reprocessable_documents", "avg_processing_time_seconds", "total_chunks",
            "chunks_with_embeddings", "embedding_completion_percent",
        ).alias("report"),
        F.array_join(retries, ", ").alias("retry_detail"),
    )
