"""Written intermediate tables and whole files in the cluster's shared folder."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioflow.session import workspace


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame as a shared table and read it back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = workspace(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def write_file(store: fs.FileSystem, path: str, content: bytes) -> None:
    """Publish a file under its final name only once it is complete.

    Names and contents are functions of the input, so a task that is retried or runs
    twice replaces a file by the same bytes.
    """
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write(content)
    store.move(temporary, path)


def extended(schema: StructType, fields: str) -> StructType:
    """A schema with more fields, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(fields).fields])


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A batch function that hands the memory it freed back to the system when it ends.

    Python workers serve one task after another, of all operators; what the allocators hold
    back adds up over them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run


def running_totals(frame: DataFrame, order: str, value: str, name: str, bucket: int = 4096) -> DataFrame:
    """The sum of ``value`` over all rows of a smaller ``order``, a unique whole number from 0 on.

    Rows are summed by buckets of numbers first, so no task orders more than a bucket, or the buckets.
    """
    numbered = frame.withColumn("_bucket", F.floor(F.col(order) / bucket))
    sums = numbered.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_bucket")) - F.col("_sum")
    within = F.sum(value).over(Window.partitionBy("_bucket").orderBy(order)) - F.col(value)
    return numbered.join(sums.select("_bucket", before.alias("_before")), "_bucket").withColumn(
        name, F.col("_before") + within
    ).drop("_bucket", "_before")
