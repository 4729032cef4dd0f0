"""Record the metrics once, or at an interval.

    python -m folioflow.jobs.monitor --documents PATH --chunks PATH --out PATH
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import time

from pyspark.sql import DataFrame, SparkSession

from folioflow.jobs import ledger
from folioflow.operators.contracts import add_columns
from folioflow.operators.metrics import metrics_snapshot, report_lines
from folioflow.schemas import MIGRATION
from folioflow.sources.batches import write_batch
from folioflow.sources.tables import read_table

log = logging.getLogger("folioflow.monitor")


def record_metrics(
    docs: DataFrame, chunks: DataFrame, out: str, number: int, now: dt.datetime, **options
) -> DataFrame:
    """Write snapshot ``number`` to the history and return it."""
    return write_batch(metrics_snapshot(docs, chunks, now, **options), out, number)


def record_ledger(
    base: DataFrame, home: str, out: str, number: int, now: dt.datetime, **options
) -> DataFrame:
    """Snapshot ``number`` of the shared state, from what was written since the one before."""
    ledger_at = ledger.advance(base, home, number)
    return write_batch(ledger.snapshot(base.sparkSession, ledger_at, now, **options), out, number)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Record processing metrics")
    parser.add_argument("--documents", required=True)
    place = parser.add_mutually_exclusive_group(required=True)
    place.add_argument("--chunks")
    place.add_argument("--home", help="shared state of all roles; only what is new is read, see folioflow.jobs.ledger")
    parser.add_argument("--rebuild", action="store_true", help="start the ledger anew, for a changed documents table")
    parser.add_argument("--out", required=True)
    parser.add_argument("--interval", type=int, default=60, help="seconds between snapshots")
    parser.add_argument("--run-once", action="store_true")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)

    spark = spark or SparkSession.builder.getOrCreate()
    if args.home and args.rebuild:
        ledger.open_ledger(add_columns(read_table(spark, args.documents), MIGRATION), f"{args.home}/ledger")
    while True:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        number = int(now.timestamp())
        docs = read_table(spark, args.documents)
        if args.home:
            snapshot = record_ledger(add_columns(docs, MIGRATION), args.home, args.out, number, now)
        else:
            snapshot = record_metrics(docs, read_table(spark, args.chunks), args.out, number, now)
        lines = report_lines(snapshot).first()
        log.info(lines.report)
        if lines.retry_detail:
            log.info("Detalhes de falhas na extração: %s", lines.retry_detail)
        if args.run_once:
            return
        time.sleep(args.interval)


if __name__ == "__main__":
    main()
