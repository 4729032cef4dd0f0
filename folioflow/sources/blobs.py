"""Stored objects as rows ``(path, length, content)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import MAX_FILE_BYTES


def read_blobs(spark: SparkSession, root: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Every object below ``root``, keyed by its path relative to ``root``.

    For work on a whole store. The length filter reaches the scan, so objects over the
    limit are listed without their bytes ever being read. Single objects are fetched by
    key, see :mod:`folioflow.sources.objects`.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")

    def key(path: Column) -> Column:
        return F.regexp_replace(path, rf"^[^:]+:/+\Q{base}\E/", "")

    small = files.where(F.col("length") <= max_bytes).select(
        key(F.col("path")).alias("path"), "length", "content"
    )
    large = files.where(F.col("length") > max_bytes).select(
        key(F.col("path")).alias("path"), "length", F.lit(None).cast("binary").alias("content")
    )
    return small.unionByName(large)


def fetch(messages: DataFrame, blobs: DataFrame) -> DataFrame:
    """Messages with ``length`` and ``content``; both NULL where nothing is stored."""
    return messages.join(
        blobs.withColumnRenamed("path", "storage_path"), "storage_path", "left"
    )
