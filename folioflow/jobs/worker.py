"""Process queue messages as they arrive.

    python -m folioflow.jobs.worker --queue PATH --blobs ROOT --out PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from folioflow.functions.embedding import hashing_embedder
from folioflow.sources.objects import ObjectStore
from folioflow.sources.queue import stream_messages
from folioflow.sources.tables import read_table
from folioflow.streaming.jobs import ingest


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Process queued documents")
    parser.add_argument("--queue", required=True, help="folder of message files, a message a line")
    parser.add_argument("--blobs", required=True, help="root folder of the stored objects")
    parser.add_argument("--inventory", help="table (path, length) of the stored objects")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--seconds", type=int, default=5, help="seconds between micro-batches")
    parser.add_argument("--run-once", action="store_true", help="process what is queued and stop")
    parser.add_argument("--parity", action="store_true", help="count empty extractions as processed")
    parser.add_argument("--embed", action="store_true", help="attach hashed vectors to chunks")
    args = parser.parse_args(argv)

    spark = spark or SparkSession.builder.getOrCreate()
    ingest(
        stream_messages(spark, args.queue),
        ObjectStore(args.blobs, read_table(spark, args.inventory) if args.inventory else None),
        args.out,
        args.checkpoint,
        seconds=None if args.run_once else args.seconds,
        embed_fn=hashing_embedder() if args.embed else None,
        parity=args.parity,
    ).awaitTermination()


if __name__ == "__main__":
    main()
