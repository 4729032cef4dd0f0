"""Keyed updates, inserts and vector write-back as joins over snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.schemas import NOW, Contract
from folioflow.session import instant

ID_BUCKET_DIGITS = 4  # 16^4 buckets: the offset table has at most 65536 rows


def latest_changes(
    changes: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Per key and column the last value that is not NULL.

    A maximum over (order, value) pairs combines on the map side, so a key that
    holds most of the changes still reaches its reducer as one row per task.
    """
    latest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("value"))))["value"]
        .alias(c)
        for c in columns
    ]
    return changes.groupBy(key).agg(*latest)


def apply_updates(state: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """New snapshot: changed values where present, old ones elsewhere.

    ``changes`` has one row per key (see :func:`latest_changes`); a NULL leaves the
    old value in place and unknown keys are ignored. The join strategy is left to
    the optimizer, which broadcasts the changes only when they measure small.
    """
    touched = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"new_{c}") for c in touched])
    return state.join(renamed, key, "left").select(*[
        F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) if c in touched else F.col(c)
        for c in state.columns
    ])


def write_vectors(chunks: DataFrame, vectors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chunks with ``embedding`` (and ``dim``) replaced wherever ``vectors`` brings one."""
    brought = [c for c in ("embedding", "dim") if c in chunks.columns and c in vectors.columns]
    fresh = vectors.select(*keys, *[F.col(c).alias(f"new_{c}") for c in brought])
    return chunks.join(fresh, list(keys), "left").select(*[
        F.coalesce(f"new_{c}", c).alias(c) if c in brought else c for c in chunks.columns
    ])


def default_value(expression: str, now: dt.datetime, dtype: T.DataType) -> Column:
    value = instant(now) if expression == NOW else F.expr(expression)
    return value.cast(dtype)


def with_defaults(rows: DataFrame, contract: Contract, now: dt.datetime) -> DataFrame:
    """All contract columns: those supplied, and defaults for those left out."""
    out = []
    for f in contract.schema:
        dtype = T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType
        if f.name in rows.columns:
            value = F.col(f.name).cast(dtype)
        elif f.name in contract.defaults:
            value = default_value(contract.defaults[f.name], now, dtype)
        else:
            value = F.lit(None).cast(dtype)
        out.append(value.alias(f.name))
    return rows.select(*out)


def assign_ids(rows: DataFrame, key: Column, start: Column, id_col: str = "id") -> DataFrame:
    """Dense 64-bit identities following ``start``, without a global sort.

    Rows fall into buckets by a digest of ``key``; bucket sizes give every bucket its offset,
    and rows are numbered inside their bucket only, those of equal keys in the order of a hash
    of all their columns. ``rows`` is read twice: pass it as stored.
    """
    bucketed = rows.withColumn("_key", key.cast("string")).withColumn(
        "_bucket", F.substring(F.md5("_key"), 1, ID_BUCKET_DIGITS)
    )
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "_bucket",
            (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_offset"),
        )
    )
    order = Window.partitionBy("_bucket").orderBy("_key", F.xxhash64(*rows.columns))
    number = F.row_number().over(order).cast("long")
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(id_col, start + F.col("_offset") + number)
        .drop("_key", "_bucket", "_offset")
    )


def insert(
    table: DataFrame, rows: DataFrame, contract: Contract, key: Column, now: dt.datetime
) -> DataFrame:
    """The inserted rows with 64-bit identities above the table's highest.

    Nothing runs before the result is used; the highest identity is a subquery of it.
    """
    top = table.select(F.coalesce(F.max("id"), F.lit(0)).cast("long")).scalar()
    numbered = assign_ids(rows, key, top)
    wide = replace(contract, schema=T.StructType([
        T.StructField("id", T.LongType()) if f.name == "id" else f for f in contract.schema
    ]))
    return with_defaults(numbered, wide, now)
