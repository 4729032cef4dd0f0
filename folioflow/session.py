"""Session defaults, time literals and the shared working folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("folioflow")
    for key, value in {**DEFAULTS, "spark.driver.memory": "8g", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="folioflow-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def instant(now: dt.datetime) -> Column:
    """A UTC wall-clock literal that no session time zone can shift."""
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP_NTZ'{now.isoformat(sep=' ', timespec='microseconds')}'")


def before(moment: Column, now: dt.datetime, minutes: int) -> Column:
    """True where ``moment`` lies strictly more than ``minutes`` before ``now``."""
    return moment < F.lit(instant(now - dt.timedelta(minutes=minutes)))
