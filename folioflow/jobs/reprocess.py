"""Retry failed documents: one cycle, or cycles at an interval.

    python -m folioflow.jobs.reprocess --documents PATH --blobs ROOT --out PATH --run-once
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.jobs import due as D
from folioflow.jobs.process import Blobs, fold_outputs, store_outcomes
from folioflow.operators import lifecycle as L
from folioflow.operators.contracts import add_columns
from folioflow.operators.updates import apply_updates, latest_changes
from folioflow.schemas import EXTRACTING, EXTRACTION_FAILED, MIGRATION
from folioflow.session import before
from folioflow.sources.batches import write_batch
from folioflow.sources.files import names, remove
from folioflow.sources.levels import fold_batches, last_values, read_levels
from folioflow.sources.objects import ObjectStore
from folioflow.sources.tables import read_table

log = logging.getLogger("folioflow.reprocess")

CHANGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("storage_path", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("processing_notes", T.StringType()),
])
CHANGED = ["status", "retry_count", "updated_at", "processing_notes"]


def latest_states(spark: SparkSession, out: str, cycle: int) -> DataFrame:
    """The last state of every document touched by a cycle before ``cycle``."""
    begun = read_levels(spark, f"{out}/attempts", CHANGE).withColumn("step", F.lit(0))
    ended = read_levels(spark, f"{out}/settled", CHANGE).withColumn("step", F.lit(1))
    earlier = begun.unionByName(ended).where(F.col("batch_id") < cycle)
    columns = [c for c in CHANGE.fieldNames() if c != "id"]
    return latest_changes(earlier, "id", ["batch_id", "step"], columns)


def current_documents(base: DataFrame, out: str, cycle: int) -> DataFrame:
    """The base table with the changes of every cycle before ``cycle``."""
    return apply_updates(base, latest_states(base.sparkSession, out, cycle).select("id", *CHANGED))


def died(now: dt.datetime) -> Column:
    """Attempts begun long ago and never settled: their cycle died."""
    return (F.col("status") == EXTRACTING) & before(F.col("updated_at"), now, L.STUCK_MINUTES)


def _dead_as_failed(rows: DataFrame, now: dt.datetime) -> DataFrame:
    failed = F.when(died(now), F.lit(EXTRACTION_FAILED)).otherwise(F.col("status"))
    return rows.withColumn("status", failed)


def candidates(
    base: DataFrame, out: str, cycle: int, now: dt.datetime, max_retries: int, limit: int | None
) -> DataFrame:
    """Documents to retry, without joining the whole table to its changes.

    The base table is filtered in its scan; documents a cycle has touched are known
    in full from the cycles' own records. Attempts that died count as failed ones.
    """
    touched = latest_states(base.sparkSession, out, cycle)

    def due(rows: DataFrame) -> DataFrame:
        return L.retry_candidates(rows, now, max_retries, keep=["processing_notes"])

    fresh = due(base).join(touched.select("id"), "id", "left_anti")
    return L.oldest_first(fresh.unionByName(due(_dead_as_failed(touched, now))), limit)


def _indexed(
    base: DataFrame, out: str, cycle: int, now: dt.datetime, max_retries: int, limit: int | None
) -> tuple[DataFrame, DataFrame, D.Turn]:
    """Attempts of this cycle, what it must give up, and its turn, from the buckets that are due.

    The first turn files the whole table; a later one reads neither it nor the cycles' records.
    """
    spark, wheel = base.sparkSession, f"{out}/wheel"
    rerun = cycle in D.turns(spark, wheel)
    last = D.last_turn(spark, wheel, cycle) if rerun else D.clear_dead(spark, wheel, cycle)
    if last is not None and not D.is_settled(spark, wheel, last.number) and "_SUCCESS" in names(
        spark, f"{out}/settled/batch_id={last.number}"
    ):  # it died between its outcomes and their entries
        stored = spark.read.schema(CHANGE).parquet(f"{out}/settled/batch_id={last.number}")
        D.settle(stored, wheel, last, max_retries)
    at = D.turn(spark, wheel, cycle) if rerun else D.Turn(cycle, now)
    if not rerun:
        if last is None:
            touched = latest_states(spark, out, cycle).select(*CHANGE.fieldNames())
            fresh = base.where(F.col("status") == EXTRACTION_FAILED).join(touched.select("id"), "id", "left_anti")
            D.file_states(fresh.unionByName(touched, allowMissingColumns=True), wheel, cycle, now, max_retries)
    entries = D.read_due(spark, wheel, last, cycle, at.now)
    if not rerun:
        D.begin(entries, wheel, cycle, at.now, max_retries, limit)
    lost = entries.where((F.col("kind") == D.WATCH) & (L.attempts() >= max_retries))
    return D.begun(spark, wheel, cycle), lost, at


def run_cycle(
    documents: DataFrame,
    blobs: Blobs,
    out: str,
    cycle: int,
    now: dt.datetime,
    max_retries: int = L.MAX_RETRIES,
    limit: int | None = None,
    whole: bool = False,
    indexed: bool = False,
    **options,
) -> DataFrame:
    """One cycle over all candidates at once; returns its statistics (one row).

    ``documents`` is the base table; what earlier cycles changed is read from ``out``,
    which belongs to the cycles alone. With ``whole`` the table has all changes already,
    those of other roles included, and alone says what is due. The candidate set is
    written before anything is attempted: it is read twice, and its attempts count even if
    the cycle dies. Documents whose last allowed attempt died are settled as given up, and counted, here. Texts
    and chunks of the documents that come through are stored like those of any batch.
    Rerunning a cycle replaces its folders.

    With ``indexed`` a cycle after the first reads only what is due (:mod:`folioflow.jobs.due`):
    neither the base table, which must not change meanwhile, nor the records of earlier cycles. A
    rerun keeps the moment and the attempts of the turn it repeats. For the options see :func:`store_outcomes`.
    """
    if whole and indexed:
        raise ValueError("an index by due time belongs to the cycles alone")
    if indexed:
        attempts, given_up, turn = _indexed(documents, out, cycle, now, max_retries, limit)
        attempts, now = attempts.select(*CHANGE.fieldNames()), turn.now
    elif whole:
        due = L.retry_candidates(
            _dead_as_failed(documents, now), now, max_retries, limit=limit, keep=["processing_notes"]
        )
    else:
        due = candidates(documents, out, cycle, now, max_retries, limit)
    if not indexed:
        attempts = L.start_attempt(due, now).select(*CHANGE.fieldNames())
    attempted = write_batch(attempts, f"{out}/attempts", cycle)

    messages = attempted.select(F.col("id").alias("document_id"), "storage_path", "file_type")
    outcomes = store_outcomes(messages, cycle, blobs, out, now, **options).select(
        F.col("document_id").alias("id"), F.col("status").alias("outcome")
    )
    columns = [c for c in CHANGE.fieldNames() if c != "status"]
    if not indexed:
        known = documents if whole else latest_states(documents.sparkSession, out, cycle)
        given_up = known.where(died(now) & (L.attempts() >= max_retries))
    lost = given_up.select(
        *columns, F.lit(EXTRACTION_FAILED).alias("outcome")
    )
    settled = L.settle_attempts(
        attempted.select(*columns).join(outcomes, "id").unionByName(lost), now, max_retries,
        keep=["storage_path", "file_type"],
    )
    stored = write_batch(settled, f"{out}/settled", cycle)
    if indexed:
        D.settle(stored, f"{out}/wheel", turn, max_retries)
        D.prune(documents.sparkSession, f"{out}/wheel")
    return L.cycle_stats(stored)


def fold_cycles(spark: SparkSession, out: str) -> None:
    """Fold the records of older cycles."""
    columns = [c for c in CHANGE.fieldNames() if c != "id"]
    for name in ("attempts", "settled"):
        fold_batches(spark, f"{out}/{name}", CHANGE, ["id"], last_values("id", columns))
    fold_outputs(spark, out)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Retry documents whose extraction failed")
    parser.add_argument("--documents", required=True, help="documents table")
    parser.add_argument("--blobs", required=True, help="root folder of the stored objects")
    parser.add_argument("--inventory", help="table (path, length) of the stored objects")
    place = parser.add_mutually_exclusive_group(required=True)
    place.add_argument("--out", help="folder for the cycles' results")
    place.add_argument("--home", help="shared state of all roles, see folioflow.jobs.shared")
    parser.add_argument("--interval", type=int, default=30, help="minutes between cycles")
    parser.add_argument("--max-retries", type=int, default=L.MAX_RETRIES)
    parser.add_argument("--limit", type=int, default=None, help="documents per cycle")
    parser.add_argument("--due-index", action="store_true", help="with --out: read only what is due")
    parser.add_argument("--rebuild", action="store_true", help="file a changed table into the index anew")
    parser.add_argument("--run-once", action="store_true")
    parser.add_argument("--verbose", action="store_true")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)

    if args.due_index and not args.out:
        parser.error("--due-index needs --out")

    spark = spark or SparkSession.builder.getOrCreate()
    if args.rebuild and args.out:
        remove(spark, f"{args.out}/wheel")
    while True:
        base = add_columns(read_table(spark, args.documents), MIGRATION)  # its files of this cycle
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        cycle = int(time.time())
        limits = {"max_retries": args.max_retries, "limit": args.limit}

        inventory = read_table(spark, args.inventory) if args.inventory else None
        blobs = ObjectStore(args.blobs, inventory)
        if args.home:
            from folioflow.jobs import shared  # it builds on this module

            stats = shared.cycle(base, blobs, args.home, cycle, now, **limits).first()
        else:
            stats = run_cycle(base, blobs, args.out, cycle, now, indexed=args.due_index, **limits).first()
        log.info("cycle %d: %s", cycle, stats.asDict())
        fold_cycles(spark, f"{args.home}/cycles" if args.home else args.out)
        if args.run_once:
            return
        time.sleep(args.interval * 60)


if __name__ == "__main__":
    main()
