"""Document messages: reading, validating and routing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "DocumentId: STRING, StoragePath: STRING, FileType: STRING"
JSON_SPACE = " \t\r\n"
VALID, FAILED, DEAD = "valid", "failed", "dead_letter"


def _with_origin(lines: DataFrame) -> DataFrame:
    """Lines with ``sent``: the place in the queue of the piece of file they were read from."""
    origin = F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines.select("value", origin.alias("sent"))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """One JSON message per line."""
    return _with_origin(spark.read.text(path))


def stream_messages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return _with_origin(
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    )


def numbered(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """Lines of a batch with their row number, and the columns that tell their order.

    Row numbers ascend within a piece of a file, and ``sent`` orders the pieces.
    """
    rows = lines.withColumn("line", F.monotonically_increasing_id())
    return rows, [c for c in ("sent", "line") if c in rows.columns]


def parse_messages(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``document_id, storage_path, file_type, route, reason`` to each line.

    Every line keeps a row: ``valid`` ones go on, ``failed`` ones name a document
    without a path, and ``dead_letter`` ones name no document at all. Works the same
    on a stream.
    """
    value = F.col(value_col)
    # Inside brackets, text after the first JSON value is an error instead of ignored.
    listed = F.concat(F.lit("["), value, F.lit("]"))
    kept = [F.col(c) for c in lines.columns]
    rows = lines.select(
        *kept, F.from_json(listed, f"array<struct<{MESSAGE}>>").alias("_messages")
    ).select(
        *kept,
        F.when((F.size("_messages") == 1) & F.ltrim(value, F.lit(JSON_SPACE)).startswith("{"),
               F.col("_messages")[0]).alias("_m"),
    ).select(
        *kept,
        F.col("_m").isNotNull().alias("_usable"),
        F.col("_m.DocumentId").alias("_id"),
        F.col("_m.StoragePath").alias("storage_path"),
        F.col("_m.FileType").alias("file_type"),
    )
    # Only lines that are no message are parsed again, to tell why.
    other = F.coalesce(F.size(F.from_json(listed, "array<string>")), F.lit(-1)) == 1
    number = F.expr("try_cast(_id AS BIGINT)")
    absent = F.col("_id").isNull() | F.col("_id").isin("", "0", "0.0", "false", "[]", "{}")
    reason = (
        F.when(~F.col("_usable"), F.when(other, "not_an_object").otherwise("bad_json"))
        .when(absent, "no_document_id")
        .when(number.isNull(), "bad_document_id")
        .when(F.coalesce(F.col("storage_path"), F.lit("")) == "", "no_storage_path")
    )
    return rows.withColumn("reason", reason).select(
        *[c for c in lines.columns],
        F.when(~absent, number).alias("document_id"),
        "storage_path",
        "file_type",
        F.when(F.col("reason").isNull(), VALID)
        .when(F.col("reason") == "no_storage_path", FAILED)
        .otherwise(DEAD)
        .alias("route"),
        "reason",
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("route") == DEAD)


def deliverable(parsed: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One message per document, the last in ``order``: a later upload replaces an earlier one.

    The maximum combines before the shuffle, however often a document is queued.
    """
    return (
        parsed.where(F.col("route") != DEAD)
        .groupBy("document_id")
        .agg(F.max(F.struct(*order, "storage_path", "file_type")).alias("m"))
        .select("document_id", "m.storage_path", "m.file_type")
    )
