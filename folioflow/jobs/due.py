"""An index of retries by the time they are due: a timer wheel of partitions.

    begun/batch_id=N/bucket=B/     attempts of turn N, due for a look when they must have died
    settled/batch_id=N/bucket=B/   what turn N's outcomes ask for: another try, or no look
    filed/batch_id=N/bucket=B/     failures from outside the cycles
    turns/N, turns/N.settled       marks: what turn N begun or settled counts

An entry lies in the bucket of the minutes in which it is due, so a turn reads the buckets
between the turn before it and now, however many documents wait or have failed for good.
Outcomes never touch the entry they answer: they file a cancellation into its bucket, and
the turn that reads the bucket reads both. Whatever a limit leaves over is filed again.

A turn counts from its mark on. What one wrote that died before is removed by the next one,
what died after it goes on from what had begun. Turns have ascending numbers and moments.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.operators import lifecycle as L
from folioflow.schemas import EXTRACTING, EXTRACTION_FAILED
from folioflow.session import instant
from folioflow.sources.batches import read_batches
from folioflow.sources.files import names, publish, read_text, remove

BUCKET_MINUTES = 10
RETRY, WATCH, CANCEL = "retry", "watch", "cancel"
STATE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("storage_path", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("processing_notes", T.StringType()),
])
ENTRY = T.StructType([
    *STATE.fields,
    T.StructField("kind", T.StringType()),
    T.StructField("due", T.TimestampNTZType()),
    T.StructField("bucket", T.LongType()),
])
TABLES = ["begun", "settled", "filed"]


class Turn(NamedTuple):
    number: int
    now: dt.datetime


def bucket_of(moment: Column) -> Column:
    """Bucket of a moment without zone, the same in every session zone."""
    minutes = F.unix_date(moment.cast("date")) * 1440 + F.hour(moment) * 60 + F.minute(moment)
    return F.floor(minutes / BUCKET_MINUTES).cast("long")


def bucket_at(moment: dt.datetime) -> Column:
    return bucket_of(F.lit(instant(moment)))


def later(moment: Column, minutes: int) -> Column:
    return moment + F.expr(f"INTERVAL {minutes} MINUTES")


def turns(spark: SparkSession, wheel: str) -> list[int]:
    return sorted(int(n) for n in names(spark, f"{wheel}/turns") if n.isdigit())


def turn(spark: SparkSession, wheel: str, number: int) -> Turn:
    return Turn(number, dt.datetime.fromisoformat(read_text(spark, f"{wheel}/turns/{number}")))


def last_turn(spark: SparkSession, wheel: str, number: int) -> Turn | None:
    """The last turn before ``number`` that counts."""
    earlier = [n for n in turns(spark, wheel) if n < number]
    return turn(spark, wheel, earlier[-1]) if earlier else None


def _write(entries: DataFrame, wheel: str, name: str, number: int) -> None:
    """Entries by bucket. A turn's entries fall due within minutes, so into a few buckets."""
    entries.select(*ENTRY.fieldNames()).write.mode("overwrite").partitionBy("bucket").parquet(
        f"{wheel}/{name}/batch_id={number}"
    )


def read_due(spark: SparkSession, wheel: str, last: Turn | None, number: int, now: dt.datetime) -> DataFrame:
    """Live entries due since the last turn and before ``now``: only their buckets are read."""
    parts = [read_batches(spark, f"{wheel}/{name}", ENTRY) for name in TABLES]
    upto = -1 if last is None else last.number
    begun, settled, filed = (
        rows.where((F.col("bucket") <= bucket_at(now)) & (F.col("batch_id") <= bound))
        for rows, bound in zip(parts, (upto, upto, number))
    )
    entries = begun.unionByName(settled).unionByName(filed).where(F.col("due") < F.lit(instant(now)))
    if last is not None:
        since = F.lit(instant(last.now))
        entries = entries.where((F.col("bucket") >= bucket_at(last.now)) & (F.col("due") >= since))
    gone = entries.where(F.col("kind") == CANCEL).select("id", "due")
    live = entries.where(F.col("kind") != CANCEL).join(gone, ["id", "due"], "left_anti")
    return live.select(*STATE.fieldNames(), "kind")


def file_states(states: DataFrame, wheel: str, number: int, now: dt.datetime, max_retries: int) -> None:
    """File failures and running attempts from outside the cycles, for turn ``number`` on.

    The first turn does this with the whole table. Later on these must be documents of which
    no entry is waiting; what is due already is filed where turn ``number`` looks. Other
    states, and rows without a moment of change, are left out.
    """
    last = last_turn(states.sparkSession, wheel, number)
    failed = (F.col("status") == EXTRACTION_FAILED) & (L.attempts() < max_retries)
    running = F.col("status") == EXTRACTING
    wait = F.when(running, later(F.col("updated_at"), L.STUCK_MINUTES)).otherwise(
        later(F.col("updated_at"), L.COOL_DOWN_MINUTES)
    )
    if last is not None:
        wait = F.greatest(wait, F.lit(instant(last.now)))
    first = bucket_at(now if last is None else last.now)
    rows = states.where((failed | running) & F.col("updated_at").isNotNull()).select(
        *[F.col(f.name).cast(f.dataType) for f in STATE.fields if f.name != "retry_count"],
        L.attempts().cast("int").alias("retry_count"),
        F.when(running, WATCH).otherwise(RETRY).alias("kind"),
        wait.alias("due"),
    )
    _write(rows.withColumn("bucket", F.greatest(bucket_of(F.col("due")), first)), wheel, "filed", number)


def clear_dead(spark: SparkSession, wheel: str, number: int) -> Turn | None:
    """Remove what turns after the last one that counts left behind; returns that one.

    Filings stay, but for those of a first turn that never came to count.
    """
    last = last_turn(spark, wheel, number)
    for name in TABLES if last is None else TABLES[:2]:
        for folder in names(spark, f"{wheel}/{name}"):
            batch = int(folder.removeprefix("batch_id=")) if folder.startswith("batch_id=") else None
            if batch is not None and batch <= number and (last is None or batch > last.number):
                remove(spark, f"{wheel}/{name}/{folder}")
    return last


def begin(
    due: DataFrame, wheel: str, number: int, now: dt.datetime, max_retries: int, limit: int | None
) -> None:
    """Start an attempt for what is due, file a look at it, and let the turn count."""
    ready = due.where(F.col("retry_count") < max_retries)
    picked = L.oldest_first(ready, limit)
    entries = L.start_attempt(picked, now).select(
        *STATE.fieldNames(), F.lit(WATCH).alias("kind"),
        later(F.lit(instant(now)), L.STUCK_MINUTES).alias("due"),
    )
    if limit is not None:
        left = ready.join(picked.select("id"), "id", "left_anti")
        entries = entries.unionByName(left.withColumns({
            "kind": F.lit(RETRY), "due": F.lit(instant(now)),
        }))
    _write(entries.withColumn("bucket", bucket_of(F.col("due"))), wheel, "begun", number)
    publish(due.sparkSession, f"{wheel}/turns/{number}", now.isoformat())


def begun(spark: SparkSession, wheel: str, number: int) -> DataFrame:
    """The attempts of a turn."""
    rows = read_batches(spark, f"{wheel}/begun", ENTRY)
    return rows.where((F.col("batch_id") == number) & (F.col("kind") == WATCH)).select(
        *STATE.fieldNames(), F.lit(EXTRACTING).alias("status")
    )


def settle(settled: DataFrame, wheel: str, at: Turn, max_retries: int) -> None:
    """File the next try of what failed again, and cancel the look at every settled attempt."""
    now = F.lit(instant(at.now))
    again = (F.col("status") == EXTRACTION_FAILED) & (L.attempts() < max_retries)
    kinds = F.array(
        F.struct(F.lit(CANCEL).alias("kind"), later(now, L.STUCK_MINUTES).alias("due")),
        F.when(again, F.struct(F.lit(RETRY).alias("kind"), later(now, L.COOL_DOWN_MINUTES).alias("due"))),
    )
    entries = settled.withColumn("_entry", F.explode(F.array_compact(kinds))).select(
        *STATE.fieldNames(), "_entry.kind", "_entry.due"
    )
    _write(entries.withColumn("bucket", bucket_of(F.col("due"))), wheel, "settled", at.number)
    publish(settled.sparkSession, f"{wheel}/turns/{at.number}.settled", at.now.isoformat())


def is_settled(spark: SparkSession, wheel: str, number: int) -> bool:
    return f"{number}.settled" in names(spark, f"{wheel}/turns")


def prune(spark: SparkSession, wheel: str) -> None:
    """Drop the entries of turns so old that everything they filed has been read."""
    known = turns(spark, wheel)
    if not known:
        return
    newest = turn(spark, wheel, known[-1])
    span = dt.timedelta(minutes=L.STUCK_MINUTES + BUCKET_MINUTES)
    for number in known[:-1]:
        if turn(spark, wheel, number).now + span >= newest.now:
            return
        for place in (f"begun/batch_id={number}", f"settled/batch_id={number}",
                      f"turns/{number}.settled", f"turns/{number}"):
            remove(spark, f"{wheel}/{place}")
