"""Small files and folders on the driver, in any store that Spark itself can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing where there is none."""
    place, store = _path(spark, path)
    if not store.exists(place):
        return []
    return [status.getPath().getName() for status in store.listStatus(place)]


def read_text(spark: SparkSession, path: str) -> str:
    place, store = _path(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a complete file appear at once; False, and no change, where one is already."""
    place, store = _path(spark, path)
    if store.exists(place):
        return False
    draft, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.draft")
    stream = store.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return bool(store.rename(draft, place))


def remove(spark: SparkSession, path: str) -> None:
    place, store = _path(spark, path)
    store.delete(place, True)
