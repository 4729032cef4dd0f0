"""The monitor's figures kept up to date from what was written since the last time.

The ledger remembers of every document the state that its figures were taken from, and of
every chunk whether it is current and has a vector, both in buckets. A turn reads the batches
since the last one, looks up the documents they change, and adds to the counts what these are
now and takes away what they were. It reads the new batches and the touched buckets only.

A turn first writes down what it will change, old values and new ones, and only then changes
anything; one that dies is finished by the next. The last batch read is read again by the next
turn, since a replay may have replaced it: a change that is known already counts nothing.
Batches have to be numbered in the order they are written.

    staged/         a turn's changes: documents before and after, chunks after, what they add up to
    documents/      remembered states, by bucket         chunks/      remembered chunks, by bucket
    cells/          counts per (state, attempts)         totals/      chunk counts; a batch a turn
    _turns/         what each turn had read
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.jobs import process, reprocess
from folioflow.operators import metrics as M
from folioflow.operators.embeddings import content_hash
from folioflow.session import instant
from folioflow.sources import files
from folioflow.sources.batches import latest_set, write_batch
from folioflow.sources.buckets import bucket_of, read_buckets, replace_in_buckets, write_buckets
from folioflow.sources.levels import batches, read_levels
from folioflow.streaming.jobs import VECTOR_KEY, VECTORS

BUCKETS = 256
LONG, INT, STRING, MOMENT = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()
VALUES = {"status": STRING, "retry_count": INT, "processing_started_at": MOMENT, "updated_at": MOMENT}


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


STATE = _fields(id=LONG, **{c: _fields(at=MOMENT, role=INT, value=kind) for c, kind in VALUES.items()})
SEEN = _fields(document_id=LONG, chunk_index=INT, content_hash=LONG, current=INT, embedded=INT, at=MOMENT, role=INT)
CELLS = _fields(status=STRING, retry_count=INT, n=LONG, took_seconds=LONG, took_rest=LONG, n_timed=LONG)
TOTALS = _fields(total_chunks=LONG, chunks_with_embeddings=LONG)
WORKER, CYCLES = ("started", "states", "sweeps"), ("attempts", "settled")


def _last(spark: SparkSession, out: str, kind: str) -> int:
    numbers = [int(n.split(".")[0]) for n in files.names(spark, f"{out}/_turns") if n.endswith(f".{kind}.json")]
    return max(numbers, default=-1)


def _read_mark(spark: SparkSession, out: str, number: int) -> dict[str, int]:
    return json.loads(files.read_text(spark, f"{out}/_turns/{number:012d}.staged.json")) if number >= 0 else {}


def _mark(spark: SparkSession, out: str, number: int, kind: str, read: dict[str, int]) -> None:
    files.publish(spark, f"{out}/_turns/{number:012d}.{kind}.json", json.dumps(read))


def _touched(rows: DataFrame, key: str) -> list[int]:
    """The buckets of the keys at hand: at most BUCKETS numbers."""
    return [r.bucket for r in rows.select(bucket_of(F.col(key), BUCKETS).alias("bucket")).distinct().collect()]


def _plain(which: str) -> list[Column]:
    return [F.col(f"{which}.{c}.value").alias(c) for c in VALUES]


def _changes(spark: SparkSession, home: str, since: dict[str, int]) -> DataFrame:
    """Per document and column the last value of the new batches, with its moment and role."""
    written = [
        read_levels(spark, f"{home}/worker/{name}", process.STATE, since.get(f"worker/{name}", 0)).withColumn("step", F.lit(k))
        for k, name in enumerate(WORKER)
    ]
    worker = process._latest_states(reduce(DataFrame.unionByName, written)).select(
        F.col("document_id").alias("id"), "status", "processing_started_at", "updated_at", F.lit(0).alias("role")
    )
    cycled = [
        read_levels(spark, f"{home}/cycles/{name}", reprocess.CHANGE, since.get(f"cycles/{name}", 0)).select(
            "id", "status", "retry_count", "updated_at", F.lit(1).alias("role"), "batch_id", F.lit(k).alias("step")
        )
        for k, name in enumerate(CYCLES)
    ]
    both = worker.withColumns({"batch_id": F.lit(0).cast("long"), "step": F.lit(0)}).unionByName(
        reduce(DataFrame.unionByName, cycled), allowMissingColumns=True
    )

    def last(name: str, kind: T.DataType) -> Column:
        value = F.struct(F.col("updated_at").alias("at"), "role", "batch_id", "step", F.col(name).cast(kind).alias("value"))
        return F.max(F.when(F.col(name).isNotNull(), value)).alias(name)

    found = both.groupBy("id").agg(*[last(c, kind) for c, kind in VALUES.items()])
    return found.select("id", *[F.when(F.col(c).isNotNull(), F.struct(f"{c}.at", f"{c}.role", f"{c}.value")).alias(c) for c in VALUES])


def _stage_documents(spark: SparkSession, home: str, out: str, number: int, since: dict[str, int]) -> None:
    changes = write_batch(_changes(spark, home, since), f"{out}/staged/changes", number)
    seen = read_buckets(spark, f"{out}/documents", STATE).where(F.col("bucket").isin(_touched(changes, "id"))).drop("bucket")
    both = seen.alias("o").join(changes.alias("n"), "id").select(
        "id", F.struct(*[F.col(f"o.{c}").alias(c) for c in VALUES]).alias("old"),
        # a struct's moment comes first, and the base table's is NULL: any change is later
        F.struct(*[F.greatest(f"o.{c}", f"n.{c}").alias(c) for c in VALUES]).alias("new"),
    )
    write_batch(both.where("old IS DISTINCT FROM new"), f"{out}/staged/documents", number)


def _stage_chunks(spark: SparkSession, home: str, out: str, number: int, since: dict[str, int]) -> None:
    sets = reduce(DataFrame.unionByName, [
        read_levels(spark, f"{home}/{role}/chunks", process.CHUNK, since.get(f"{role}/chunks", 0)).withColumn("role", F.lit(k))
        for k, role in enumerate(("worker", "cycles"))
    ])
    # hashed in the scan, so that contents never move
    hashed = sets.withColumn("content_hash", content_hash())
    fresh = latest_set(hashed, order=["created_at", "role", "batch_id"]).select(
        "document_id", "chunk_index", "content_hash", F.lit(1).alias("current"),
        F.col("dim").isNotNull().cast("int").alias("embedded"), F.col("created_at").alias("at"), "role",
    )
    vectors = read_levels(spark, f"{home}/vectors", VECTORS, since.get("vectors", 0)).where("dim IS NOT NULL").select(
        *VECTOR_KEY, F.lit(0).alias("current"), F.lit(1).alias("embedded"),
        F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(None).cast("int").alias("role"),
    )
    news = write_batch(fresh.unionByName(vectors), f"{out}/staged/news", number)
    seen = read_buckets(spark, f"{out}/chunks", SEEN).where(F.col("bucket").isin(_touched(news, "document_id"))).drop("bucket")
    old = seen.join(news.select("document_id").distinct(), "document_id", "left_semi")
    known = old.where("current = 1").groupBy("document_id").agg(F.max(F.struct("at", "role")).alias("known"))
    sets = news.where("current = 1").groupBy("document_id").agg(F.max(F.struct("at", "role")).alias("brought"))
    # a set read again may have been followed by a later one
    taken = sets.join(known, "document_id", "left").where("known IS NULL OR brought >= known").select("document_id", F.lit(1).alias("taken"))

    def with_taken(rows: DataFrame) -> DataFrame:
        return rows.join(taken, "document_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))

    rows = with_taken(news).withColumn("current", F.col("current") * F.col("taken")).unionByName(
        with_taken(old).withColumn("current", F.col("current") * (1 - F.col("taken")))
    )
    moment = F.max(F.when(F.col("current") == 1, F.struct("at", "role")))
    merged = rows.groupBy(*VECTOR_KEY).agg(
        F.max("current").alias("current"), F.max("embedded").alias("embedded"), moment["at"].alias("at"), moment["role"].alias("role")
    )
    new = write_batch(merged.where("current = 1 OR embedded = 1").select(*SEEN.fieldNames()), f"{out}/staged/chunks", number)

    def totals(part: DataFrame, sign: int) -> DataFrame:
        return part.agg(
            F.coalesce(F.sum(F.col("current") * sign), F.lit(0)).alias("total_chunks"),
            F.coalesce(F.sum(F.col("current") * F.col("embedded") * sign), F.lit(0)).alias("chunks_with_embeddings"),
        )

    both = totals(new, 1).union(totals(old, -1))
    write_batch(both.agg(*[F.sum(c).cast("long").alias(c) for c in TOTALS.fieldNames()]), f"{out}/staged/totals", number)


def _folder(spark: SparkSession, path: str, number: int, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/batch_id={number}")


def _apply(spark: SparkSession, out: str, number: int) -> None:
    """Bring counts and memory up to a staged turn; may be done any number of times."""
    before = _last(spark, out, "done")
    staged = _folder(spark, f"{out}/staged/documents", number)
    change = M.document_cells(staged.select(*_plain("new")))
    undone = M.document_cells(staged.select(*_plain("old")))
    numbers = ["n", "took_seconds", "took_rest", "n_timed"]
    parts = [
        _folder(spark, f"{out}/cells", before, CELLS), change,
        undone.select("status", "retry_count", *[(-F.col(c)).alias(c) for c in numbers]),
    ]
    cells = reduce(DataFrame.unionByName, parts).groupBy("status", "retry_count").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in numbers]
    )
    write_batch(cells.where("n <> 0").coalesce(1), f"{out}/cells", number)
    both = _folder(spark, f"{out}/totals", before, TOTALS).unionByName(_folder(spark, f"{out}/staged/totals", number, TOTALS))
    write_batch(both.agg(*[F.sum(c).alias(c) for c in TOTALS.fieldNames()]), f"{out}/totals", number)
    fresh = staged.select("id", *[F.col(f"new.{c}").alias(c) for c in VALUES])
    replace_in_buckets(fresh, f"{out}/documents", "id", number, BUCKETS)
    replace_in_buckets(_folder(spark, f"{out}/staged/chunks", number, SEEN), f"{out}/chunks", "document_id", number, BUCKETS)
    _mark(spark, out, number, "done", {})
    for name in files.names(spark, f"{out}/staged"):  # earlier turns are over
        for old in batches(spark, f"{out}/staged/{name}"):
            if old < number:
                files.remove(spark, f"{out}/staged/{name}/batch_id={old}")


def open_ledger(base: DataFrame, out: str) -> None:
    """Start a ledger from the documents as they are; again, to take up a changed base table."""
    spark = base.sparkSession
    files.remove(spark, out)
    nothing = (F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(-1).alias("role"))
    states = base.select(
        F.col("id").cast("long").alias("id"),
        *[F.struct(*nothing, (F.col(c) if c in base.columns else F.lit(None)).cast(kind).alias("value")).alias(c) for c, kind in VALUES.items()],
    )
    write_buckets(states, f"{out}/documents", "id", BUCKETS)
    write_buckets(spark.createDataFrame([], SEEN), f"{out}/chunks", "document_id", BUCKETS)
    seen = read_buckets(spark, f"{out}/documents", STATE)
    cells = M.document_cells(seen.select(*[F.col(f"{c}.value").alias(c) for c in VALUES]))
    filled = cells.select("status", "retry_count", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "took_seconds", "took_rest", "n_timed")])
    write_batch(filled.coalesce(1), f"{out}/cells", 0)
    write_batch(spark.createDataFrame([(0, 0)], TOTALS), f"{out}/totals", 0)
    _mark(spark, out, 0, "staged", {})
    _mark(spark, out, 0, "done", {})


def advance(base: DataFrame, home: str, number: int) -> str:
    """Bring the ledger below ``home`` up to date as turn ``number`` (from 1 on); returns its folder.

    Starts one from ``base`` where there is none, and first finishes a turn that died.
    """
    spark, out = base.sparkSession, f"{home}/ledger"
    done, staged = _last(spark, out, "done"), _last(spark, out, "staged")
    if done < 0:
        open_ledger(base, out)
        done = staged = 0
    if staged > done:
        _apply(spark, out, staged)
        done = staged
    if number <= done:
        return out
    since = _read_mark(spark, out, done)
    tables = [*[f"worker/{t}" for t in (*WORKER, "chunks")], *[f"cycles/{t}" for t in (*CYCLES, "chunks")], "vectors"]
    upto = {t: max(batches(spark, f"{home}/{t}"), default=since.get(t, 0)) for t in tables}
    _stage_documents(spark, home, out, number, since)
    _stage_chunks(spark, home, out, number, since)
    _mark(spark, out, number, "staged", {t: max(n, since.get(t, 0)) for t, n in upto.items()})
    _apply(spark, out, number)
    return out


def snapshot(spark: SparkSession, out: str, now: dt.datetime, **options) -> DataFrame:
    """The record of all figures as of the ledger's last turn: a handful of rows are read."""
    number = _last(spark, out, "done")
    totals = _folder(spark, f"{out}/totals", number, TOTALS).withColumn(
        "embedding_completion_percent", F.round(M.percent(F.col("chunks_with_embeddings"), F.col("total_chunks")), 6)
    )
    figures = M.document_summary(_folder(spark, f"{out}/cells", number, CELLS), **options)
    return M.joined_record(figures, totals).select(instant(now).alias("timestamp"), "*")
