"""Append-only tables written batch by batch, and their current contents.

A batch owns the folder ``batch_id=N`` and replaces exactly that folder when it is
replayed, so a lost driver or executor costs a rerun and never a duplicate. An
update costs as much as its batch, not as much as the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write one batch and return it as stored, free of what it was derived from."""
    folder = f"{path}/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches, with their ``batch_id``; no rows where none was written yet."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def latest_set(
    rows: DataFrame, key: Sequence[str] = ("document_id",), order: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """Of every key, only the rows of the batch that wrote it last.

    The last batches come from a few narrow columns combined before their shuffle; the
    wide rows are joined to them once.
    """
    last = rows.groupBy(*key).agg(F.max(F.struct(*order)).alias("_last"))
    return rows.join(last.select(*key, "_last.*"), [*key, *order], "left_semi")


def compact(rows: DataFrame, path: str, upto: int) -> None:
    """Fold the batches up to ``upto`` into one, in a new table at ``path``.

    Readers move to the new table and later batches are written there; the old one is
    never overwritten while it is read.
    """
    kept = latest_set(rows.where(F.col("batch_id") <= upto))
    write_batch(kept.drop("batch_id"), path, upto)
