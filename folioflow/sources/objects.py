"""Stored objects fetched by key: a task opens the objects it is dealt, and no others.

Nothing lists the store and contents never cross a shuffle. With an inventory, a table of
paths and lengths, wanted paths are joined to it and dealt so that every task reads about the
same number of bytes; without one the store is asked for each wanted path where it is read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.text import MAX_FILE_BYTES

#: What opening an object costs, in bytes read meanwhile, when tasks are dealt their share.
OPENING = 64 << 10
BUCKETS = 4096
BATCH_BYTES = 32 << 20


@dataclass(frozen=True)
class ObjectStore:
    """Objects below ``root``, a folder or a URI that every executor can reach.

    ``inventory`` is a table ``(path, length)`` with paths relative to the root; objects it
    does not have count as missing.
    """

    root: str
    inventory: DataFrame | None = None


def take_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of everything below ``root``, by listing; no object is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    key = F.regexp_replace("path", rf"^[^:]+:/+\Q{base}\E/", "")
    return files.select(key.alias("path"), "length")


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    if "://" not in root:
        return fs.LocalFileSystem(), os.path.abspath(root.split(":", 1)[-1] if root.startswith("file:") else root)
    return fs.FileSystem.from_uri(root)


def located(folder: str, key: str | None) -> str | None:
    """Where an object lies; None for keys that name nothing below the root."""
    if not key or key.startswith("/") or ".." in key.split("/"):
        return None
    return f"{folder.rstrip('/')}/{key}"


def dealt_by_bytes(rows: DataFrame, length: Column, key: Column) -> DataFrame:
    """Rows in as many partitions as shuffles have, each of about the same number of bytes.

    A row's partition follows from the bytes before it in the order of (bucket, key): bucket
    sums give offsets, and rows are summed inside their bucket only.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weighed = rows.withColumn("_weight", F.coalesce(length, F.lit(0)) + OPENING).withColumn(
        "_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    ).withColumn("_key", key)
    sums = weighed.groupBy("_bucket").agg(F.sum("_weight").alias("_sum"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        "_bucket", (F.sum("_sum").over(Window.orderBy("_bucket")) - F.col("_sum")).alias("_offset"),
        F.sum("_sum").over(everything).alias("_total"),
    )
    before = F.sum("_weight").over(Window.partitionBy("_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1))
    placed = weighed.withColumn("_before", F.coalesce(before, F.lit(0))).join(F.broadcast(offsets), "_bucket")  # at most BUCKETS rows
    part = F.least(F.floor((F.col("_offset") + F.col("_before")) / F.col("_total") * tasks), F.lit(tasks - 1)).cast("int")
    return placed.withColumn("_part", part).repartitionById(tasks, "_part").select(*rows.columns)


def _reader(root: str, at: int, wanted: int, known: int | None, max_bytes: int, names: list[str]):
    """A batch function that adds ``length`` and ``content`` of the object named in a column."""

    def one(store: fs.FileSystem, place: str | None, content: bool, length: int | None) -> tuple[int | None, bytes | None]:
        if place is None or (known is not None and length is None):
            return None, None
        if length is not None and (length > max_bytes or not content):
            return length, None
        try:
            if not content:
                info = store.get_file_info(place)
                return (info.size, None) if info.is_file else (None, None)
            with store.open_input_file(place) as file:
                size = file.size()
                return size, file.read(size) if size <= max_bytes else None
        except FileNotFoundError:
            return None, None
        except OSError:
            if store.get_file_info(place).is_file:
                raise
            return None, None  # a folder, or gone meanwhile

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_root(root)
        for batch in batches:
            columns = [batch[k].to_pylist() for k in (at, wanted)]
            lengths = batch[known].to_pylist() if known is not None else [None] * batch.num_rows
            begin, found, held = 0, [], 0
            for row, (key, content, length) in enumerate(zip(*columns, lengths, strict=True)):
                found.append(one(store, located(folder, key), content, length))
                held += len(found[-1][1] or b"")
                if held >= BATCH_BYTES or row + 1 == batch.num_rows:
                    part = batch.slice(begin, row + 1 - begin)
                    sizes, contents = zip(*found, strict=True)
                    kept = [part[k] for k in range(part.num_columns) if k not in (wanted, known)]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array(sizes, pa.int64()), pa.array(contents, pa.binary())], names=names
                    )
                    begin, found, held = row + 1, [], 0

    return read


def fetch_objects(
    rows: DataFrame, store: ObjectStore, max_bytes: int = MAX_FILE_BYTES, content: Column | None = None
) -> DataFrame:
    """Rows with the ``length`` and ``content`` of the object that ``storage_path`` names.

    Both are NULL where nothing is stored. Objects over ``max_bytes``, and those of rows where
    ``content`` does not hold, are not read.
    """
    asked = rows.withColumn("_content", F.lit(True) if content is None else F.coalesce(content, F.lit(False)))
    fields = T.StructType([*rows.schema.fields, T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    if store.inventory is None:
        dealt = asked.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    else:
        known = store.inventory.select(F.col("path").alias("storage_path"), F.col("length").cast("long").alias("_length"))
        sized = asked.join(known, "storage_path", "left").select(*asked.columns, "_length")
        read = F.when(F.col("_content") & (F.col("_length") <= max_bytes), F.col("_length"))
        dealt = dealt_by_bytes(sized, read, F.coalesce("storage_path", F.lit("")))
    names = dealt.columns
    run = _reader(
        store.root, names.index("storage_path"), names.index("_content"),
        names.index("_length") if "_length" in names else None, max_bytes, fields.names,
    )
    return dealt.mapInArrow(run, fields)


def put_objects(rows: DataFrame, root: str) -> DataFrame:
    """Store ``content`` at ``path`` below ``root``; ``(path, length)`` of what was written.

    Each object appears under its name only when it is complete; a task that runs again
    replaces it by the same bytes. Nothing is written until the result is used.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_root(root)
        made: set[str] = set()
        for batch in batches:
            lengths = []
            for key, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                place = located(folder, key)
                if place is None:
                    raise ValueError(f"no place for {key!r}")
                parent = place.rsplit("/", 1)[0]
                if parent not in made:
                    store.create_dir(parent)
                    made.add(parent)
                temporary = f"{place}.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(temporary, compression=None) as out:
                    out.write(content or b"")
                store.move(temporary, place)
                lengths.append(len(content or b""))
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(lengths, pa.int64())], names=["path", "length"])

    return rows.select("path", "content").mapInArrow(write, "path string, length long")
