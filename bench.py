"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from folioflow.plans.queries import QUERIES
from folioflow.session import local_session

HEADLINE = [
    "chunk_documents",
    "chunk_sweep",
    "chunk_stats_by_lang",
    "build_chunk_table",
    "chunk_replace",
    "decode_bytes",
    "assemble_pages",
    "queue_parse",
    "process_outcome",
    "status_merge",
    "retry_candidates",
    "retry_outcome",
    "metrics_snapshot",
    "metrics_report",
    "embed_hash",
    "backfill_vectors",
    "vector_topk",
    "vector_topk_ivf",
    "pk_audit",
    "fk_orphans",
    "cascade_delete",
    "stream_ingest",
    "stream_stuck",
    "reprocess_cycle_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    QUERIES["chunk_stats_by_lang"](spark, sf_dir).collect()  # start the JVM and the workers
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }))


if __name__ == "__main__":
    main()
