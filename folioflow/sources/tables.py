"""Table scans: files or a JDBC database behind the same call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lowest: int,
    highest: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Parallel scan by ranges of an integer key (the driver jar is the cluster's)."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=key,
            lowerBound=lowest,
            upperBound=highest,
            numPartitions=partitions,
            **options,
        )
        .load()
    )
