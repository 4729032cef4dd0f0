"""Embed chunks that have no vector.

    python -m folioflow.jobs.backfill --home PATH --documents PATH --configurations PATH
        --providers PATH

Every pass looks through the shared chunks again. With ``--chunks``, ``--out`` and
``--checkpoint`` instead of ``--home``, the chunks of one folder are embedded as they arrive.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from folioflow.functions.embedding import BACKFILL_DIM, hashing_embedder, imported_model
from folioflow.jobs import shared
from folioflow.operators.embeddings import resolve_providers
from folioflow.sources.tables import read_table
from folioflow.streaming.jobs import backfill, fold_vectors


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Backfill missing embeddings")
    for name in ["documents", "configurations", "providers"]:
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--home", help="shared state of all roles, see folioflow.jobs.shared")
    for name in ["chunks", "out", "checkpoint"]:
        parser.add_argument(f"--{name}", help="without --home")
    parser.add_argument("--model", help="module:function on the workers that loads the model")
    parser.add_argument("--reference", default="", help="what that function is to load")
    parser.add_argument("--fallback", action="store_true", help="a shared credential exists")
    parser.add_argument("--parity", action="store_true", help="zeros where no vector can be made")
    parser.add_argument("--seconds", type=int, default=1, help="seconds between batches")
    parser.add_argument("--run-once", action="store_true")
    args = parser.parse_args(argv)
    if not args.home and not (args.chunks and args.out and args.checkpoint):
        parser.error("give --home, or --chunks, --out and --checkpoint")

    spark = spark or SparkSession.builder.getOrCreate()

    def documents() -> DataFrame:
        return read_table(spark, args.documents)

    def resolved() -> DataFrame:
        return resolve_providers(
            read_table(spark, args.configurations), read_table(spark, args.providers)
        )

    if args.model:
        embedder = imported_model(args.model, args.reference)
    else:
        embedder = hashing_embedder(BACKFILL_DIM)
    options = {"has_fallback": args.fallback, "parity": args.parity}
    while args.home:
        number = int(time.time())
        shared.embed_missing(documents(), resolved, args.home, number, embedder, **options)
        fold_vectors(spark, f"{args.home}/vectors")
        if args.run_once:
            return
        time.sleep(args.seconds)
    schema = read_table(spark, args.chunks).schema
    backfill(
        spark.readStream.schema(schema).parquet(args.chunks),
        documents,
        resolved,
        args.out,
        args.checkpoint,
        embedder,
        **options,
        seconds=None if args.run_once else args.seconds,
    ).awaitTermination()


if __name__ == "__main__":
    main()
