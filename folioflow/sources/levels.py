"""Batch tables whose current contents stay cheap to read, however many batches were written.

Batches are appended as ``batch_id=N`` (see :mod:`folioflow.sources.batches`). From time to
time the older ones are folded into a run, a folder of rows sorted by their key that keeps of every key only
what later reads can ask for. Runs are tiered: ``FANOUT`` runs of a level, or batches, make one run of the
next level, so a row is rewritten once a level, and a table of n batches is read from about
``FANOUT * log(n)`` runs.

    batch_id=7/  batch_id=8/     batches not folded yet
    _runs/NAME/                  runs, with the number of every row's batch as a column
    _manifests/000012.json       snapshots: the runs, and the batches they hold

A snapshot is one immutable file, and the one of the greatest number counts: a fold becomes
visible at once or, if it dies, never. Readers keep the snapshot they began with; folders that
the last ``KEEP`` snapshots don't need are removed. The newest batch is never folded, since a
replay may still replace it. One job folds a table; any number may read it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.sources import files
from folioflow.sources.batches import latest_set

FANOUT, KEEP = 4, 2

Fold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Snapshot:
    """``runs`` are (level, folder name, last batch); ``covered`` the batches they hold that still have folders."""

    number: int = 0
    runs: tuple[tuple[int, str, int], ...] = ()
    covered: frozenset[int] = field(default_factory=frozenset)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(spark, f"{path}/_manifests") if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Snapshot:
    said = json.loads(files.read_text(spark, f"{path}/_manifests/{number:06d}.json"))
    return Snapshot(number, tuple(map(tuple, said["runs"])), frozenset(said["covered"]))


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The table's last snapshot; an empty one where nothing was folded yet."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else Snapshot()


def batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in files.names(spark, path) if n.startswith("batch_id="))


def _rows(spark: SparkSession, path: str, schema: T.StructType, runs: Sequence[str], tail: Sequence[int]) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    parts = []
    if runs:
        parts.append(spark.read.schema(whole).parquet(*[f"{path}/_runs/{name}" for name in runs]))
    if tail:
        reader = spark.read.schema(whole).option("basePath", path)
        parts.append(reader.parquet(*[f"{path}/batch_id={n}" for n in tail]))
    if not parts:
        return spark.createDataFrame([], whole)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_levels(spark: SparkSession, path: str, schema: T.StructType, since: int | None = None) -> DataFrame:
    """Rows of the last snapshot's runs and of all later batches, with their ``batch_id``.

    With ``since`` only those of this batch and later ones; runs and batches before it are not opened.
    """
    now, least = snapshot(spark, path), -1 if since is None else since
    tail = [n for n in batches(spark, path) if n not in now.covered and n >= least]
    rows = _rows(spark, path, schema, [name for _, name, last in now.runs if last >= least], tail)
    return rows if since is None else rows.where(F.col("batch_id") >= since)


def fold_batches(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], fold: Fold, fanout: int = FANOUT
) -> bool:
    """Fold the older batches into a run if there are ``fanout`` of them; True where it did.

    ``fold`` keeps ``batch_id`` and every row that a later read of the folded rows and newer ones
    could want. Runs of a level that is full, too, are folded in the same pass.
    """
    now, there = snapshot(spark, path), batches(spark, path)
    waiting = [n for n in there[:-1] if n not in now.covered]
    if len(waiting) < fanout:
        return False
    level, taken, left = 1, [], list(now.runs)
    while sum(run[0] == level for run in left) + 1 >= fanout:
        taken += [run for run in left if run[0] == level]
        left = [run for run in left if run[0] != level]
        level += 1
    name = f"l{level}-{waiting[0]}-{waiting[-1]}-{uuid.uuid4().hex}"
    rows = fold(_rows(spark, path, schema, [run[1] for run in taken], waiting))
    last = max([waiting[-1], *(run[2] for run in taken)])
    rows.repartitionByRange(*key).sortWithinPartitions(*key).write.parquet(f"{path}/_runs/{name}")
    covered = (now.covered | set(waiting)) & set(there)
    said = json.dumps({"runs": [*left, (level, name, last)], "covered": sorted(covered)})
    if not files.publish(spark, f"{path}/_manifests/{now.number + 1:06d}.json", said):
        raise RuntimeError(f"another job folds {path}")
    tidy(spark, path)
    return True


def tidy(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove what none of the last ``keep`` snapshots reads: batches, runs, older snapshots."""
    numbers = _numbers(spark, path)
    kept = [_load(spark, path, n) for n in numbers[-keep:]]
    if not kept:
        return
    for n in set.intersection(*(set(s.covered) for s in kept)) if len(kept) == keep else ():
        files.remove(spark, f"{path}/batch_id={n}")
    used = {run[1] for s in kept for run in s.runs}
    for name in files.names(spark, f"{path}/_runs"):
        if name not in used:
            files.remove(spark, f"{path}/_runs/{name}")
    for n in numbers[:-keep]:
        files.remove(spark, f"{path}/_manifests/{n:06d}.json")


def last_sets(key: Sequence[str]) -> Fold:
    """Keeps of every key the rows of its last batch."""
    return lambda rows: latest_set(rows, key)


def last_values(key: str, columns: Sequence[str]) -> Fold:
    """Keeps of every key the rows that hold the last value, not NULL, of some column."""

    def fold(rows: DataFrame) -> DataFrame:
        marks = [F.max(F.when(F.col(c).isNotNull(), F.col("batch_id"))).alias(f"_{c}") for c in columns]
        last = rows.groupBy(key).agg(F.max("batch_id").alias("_any"), *marks)
        needed = F.array("_any", *[f"_{c}" for c in columns])
        return rows.join(last, key).where(F.array_contains(F.array_compact(needed), F.col("batch_id"))).select(*rows.columns)

    return fold
