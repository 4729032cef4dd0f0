"""A table kept in buckets of its key, where a change rewrites only the buckets it touches.

The new contents of the touched buckets are written beside the table first, whole, and then put
in place by a dynamic partition overwrite. A job that dies in between leaves a complete draft,
which the next change, or :func:`recover`, puts in place again: nothing is lost and nothing is
applied by halves for good. One job changes a table at a time; for readers that must never
see a change half made there are the snapshots of :mod:`folioflow.sources.levels`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.sources import files

BUCKETS = 256


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _laid_out(rows: DataFrame, key: str) -> DataFrame:
    """A file per bucket, sorted by key; a bucket of far more rows than others is split."""
    return rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", key)


def write_buckets(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write the table anew."""
    placed = rows.withColumn("bucket", bucket_of(F.col(key), buckets))
    _laid_out(placed, key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(whole).parquet(path)


def recover(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Put complete drafts in place, oldest first, and drop the others."""
    for name in sorted(files.names(spark, f"{path}/_drafts")):
        draft = f"{path}/_drafts/{name}"
        if "_SUCCESS" in files.names(spark, draft):
            _place(read_buckets(spark, draft, schema), path)
        files.remove(spark, draft)


def _place(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)


def replace_in_buckets(fresh: DataFrame, path: str, key: str, number: int, buckets: int = BUCKETS) -> list[int]:
    """Swap all rows of the keys that ``fresh`` brings for its rows; returns the buckets rewritten.

    Keys without fresh rows keep theirs. Applying the same change again changes nothing. ``fresh`` is
    read three times: pass it as stored.
    """
    spark, schema = fresh.sparkSession, fresh.schema
    recover(spark, path, schema)
    placed = fresh.withColumn("bucket", bucket_of(F.col(key), buckets))
    touched = sorted(r.bucket for r in placed.select("bucket").distinct().collect())  # at most BUCKETS numbers
    if not touched:
        return []
    old = read_buckets(spark, path, schema).where(F.col("bucket").isin(touched))
    kept = old.join(placed.select("bucket", key).distinct(), ["bucket", key], "left_anti").select(*placed.columns)
    draft = f"{path}/_drafts/{number:012d}"
    _laid_out(kept.unionByName(placed), key).write.mode("overwrite").partitionBy("bucket").parquet(draft)
    recover(spark, path, schema)
    return touched
