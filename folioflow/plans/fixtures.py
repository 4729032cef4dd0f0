"""Document-state, chunk and provider frames derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folioflow.schemas import FILE_TYPES, STATUSES

NOW = dt.datetime(2024, 1, 1, 12, 0, 0)
DAY = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once, not for every scan."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _names(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


STATE_COLUMNS = [
    "doc_id AS id",
    f"element_at(array({_names(STATUSES)}), CAST(doc_id % 15 AS INT) + 1) AS status",
    f"element_at(array({_names(FILE_TYPES)}),"
    " CAST((doc_id + doc_id div 15) % 18 AS INT) + 1) AS file_type",
    "CASE WHEN doc_id % 97 <> 0 THEN concat('objects/', source, '/', CAST(doc_id AS STRING))"
    " END AS storage_path",
    "CAST(doc_id % 50 AS STRING) AS uploaded_by_user_id",
    "CASE WHEN (doc_id div 15) % 5 <> 4 THEN CAST((doc_id div 15) % 5 AS INT)"
    " END AS retry_count",
    f"timestampadd(MINUTE, CAST((doc_id * 37) % 1440 AS INT), {DAY}) AS updated_at",
    "CASE WHEN (doc_id div 15) % 3 <> 0 THEN timestampadd(SECOND,"
    f" CAST((doc_id * 37) % 1440 * 60 - (doc_id % 600 + 1) AS INT), {DAY})"
    " END AS processing_started_at",
    "CASE WHEN doc_id % 2 <> 0 THEN 'note' END AS processing_notes",
    "n_chars AS file_size",
]
CHUNK_COLUMNS = [
    "conv_id AS document_id",
    "CAST(turn AS INT) AS chunk_index",
    "text AS content",
    "CASE WHEN (conv_id * 31 + turn) % 4 <> 0 THEN (conv_id * 31 + turn) % 500 END AS vec_id",
]


def document_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*STATE_COLUMNS)


def chunk_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(*CHUNK_COLUMNS)


def configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per customer; every sixtieth is (wrongly) owned by user 0."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_custkey % 60 = 0 THEN '0' ELSE CAST(c_custkey AS STRING) END AS user_id",
        "element_at(array('openai', 'OpenAI', 'vendor_b', 'openai'),"
        " CAST(c_custkey % 4 AS INT) + 1) AS default_provider",
    )


def provider_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey", "explode(array(0, 1, 2)) AS k")
        .selectExpr(
            "c_custkey * 10 + k AS id",
            "c_custkey AS a_i_configuration_id",
            "element_at(array('openai', 'OpenAI', 'vendor_b'), k + 1) AS provider",
            "(c_custkey + k) % 4 <> 0 AS is_enabled",
        )
    )
