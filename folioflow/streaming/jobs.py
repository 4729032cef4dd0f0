"""Continuous twins of the batch jobs: ingest, stuck detection, embedding backfill.

Each micro-batch writes its own batch folder through ``foreachBatch``. The engine's
checkpoint replays an interrupted micro-batch under the same number, which replaces
that folder, so results do not depend on failures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from folioflow.functions.embedding import VECTOR, EmbedFn
from folioflow.jobs.process import Blobs, fold_outputs, process_batch, sweep_stuck
from folioflow.operators.embeddings import (
    OPEN,
    content_hash,
    embedding_backlog,
    plan_backfill,
    run_backfill,
)
from folioflow.operators.lifecycle import STUCK_MINUTES
from folioflow.schemas import EXTRACTING, EXTRACTION_FAILED
from folioflow.sources.batches import latest_set, read_batches, write_batch
from folioflow.sources.levels import fold_batches, last_sets, read_levels

SWEEP_EVERY = 20
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
Clock = Callable[[], dt.datetime]

STUCK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("stuck_since", T.TimestampNTZType()),
])
VECTORS = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("embedding", VECTOR),
    T.StructField("embed_status", T.StringType()),
    T.StructField("credential_source", T.StringType()),
    T.StructField("dim", T.IntegerType()),
    T.StructField("content_hash", T.LongType()),
])
CHUNK_KEY = ["document_id", "chunk_index"]
VECTOR_KEY = [*CHUNK_KEY, "content_hash"]
Rows = DataFrame | Callable[[], DataFrame]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _start(
    rows: DataFrame,
    handle: Callable,
    checkpoint: str,
    seconds: int | None,
    settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """``seconds`` between micro-batches, or everything available once when None.

    A stateful query keeps the ``settings`` it first starts with; the session gets its own back.
    """
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    conf = rows.sparkSession.conf
    usual = {key: conf.get(key, None) for key in settings or {}}
    try:
        for key, value in (settings or {}).items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in usual.items():
            conf.unset(key) if value is None else conf.set(key, value)


def ingest(
    lines: DataFrame,
    blobs: Blobs,
    out: str,
    checkpoint: str,
    seconds: int | None = 5,
    clock: Clock = utc_now,
    sweep_every: int = SWEEP_EVERY,
    **options,
) -> StreamingQuery:
    """Process a stream of queue messages; see :func:`process_batch`.

    Every ``sweep_every`` micro-batches the states written so far are swept for
    documents whose extraction began long ago and never ended, and older batches are folded.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, blobs, out, clock(), **options)
        if (batch_id + 1) % sweep_every == 0:
            sweep_stuck(batch.sparkSession, out, batch_id, clock())
            fold_outputs(batch.sparkSession, out)

    return _start(lines, handle, checkpoint, seconds)


def _last_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch only the last change of each document: a combine before the shuffle."""
    for batch in batches:
        ordered = pa.Table.from_batches([batch]).sort_by([
            ("micros", "ascending"), ("status", "ascending")
        ])
        columns = ["status", "updated_at", "micros"]
        last = ordered.group_by("id", use_threads=False).aggregate([(c, "last") for c in columns])
        yield from last.select(["id", *[f"{c}_last" for c in columns]]).rename_columns(
            ["id", *columns]
        ).to_batches()


class StuckWatch(StatefulProcessor):
    """Remembers a document's last news and whether its extraction began, with a timer each.

    Of an ended extraction the moment stays until older news can no longer come, so that such news
    never raises an alarm: until the watermark has passed it or, on the clock, as long as a stuck
    one would take. Timers clear both; a time to live would also forget extractions that began
    before the query stood still. Moments are in microseconds, timers in milliseconds.
    """

    def __init__(self, minutes: int, event_time: bool) -> None:
        self.patience, self.event_time = minutes * 60_000, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.news = handle.getValueState("news", "micros bigint, begun boolean, due bigint")

    def _remember(self, moment: int, begun: bool, timers: TimerValues) -> None:
        now = timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()
        wait = self.patience if begun or not self.event_time else 0
        due = max(moment // 1000 + wait, now + 1)  # one in the past is due next
        self.news.update((moment, begun, due))
        self.handle.registerTimer(due)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        moment, status = max(zip(initialState["micros"].tolist(), initialState["status"].tolist(), strict=True))
        self._remember(moment, status == EXTRACTING, timerValues)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        moment, status = max(
            max(zip(frame["micros"].tolist(), frame["status"].tolist(), strict=True)) for frame in rows
        )
        known = self.news.get()
        if known is not None and known[0] > moment:
            return iter(())
        if known is not None:
            self.handle.deleteTimer(known[2])
        self._remember(moment, status == EXTRACTING, timerValues)
        return iter(())

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        known = self.news.get()
        if known is None or known[2] > expiredTimerInfo.getExpiryTimeInMs():
            return iter(())
        self.news.clear()
        return iter([pd.DataFrame({"id": [key[0]], "since": [known[0]]})] if known[1] else ())

    def close(self) -> None:
        pass


def _moments(changes: DataFrame) -> DataFrame:
    moment = F.col("updated_at").cast("timestamp")
    return changes.select(
        "id", "status", moment.alias("updated_at"), F.unix_micros(moment).alias("micros")
    )


def stuck_stream(
    changes: DataFrame, minutes: int = STUCK_MINUTES, lateness: str | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Documents whose extraction began more than ``minutes`` ago and brought no news.

    ``changes`` is ``(id, status, updated_at)``. A document is kept in state, in RocksDB, while it
    is being extracted, and after its end until older news can no longer come, so the
    state is as large as the work in progress, not as the table. With ``lateness``
    time is event time behind that watermark, which gives the same result on every
    replay; without, it is the clock. ``known`` is a table like ``changes`` of documents that
    were under extraction before the stream began; it is read when the query first starts.
    """
    rows = _moments(changes)
    rows = rows.mapInArrow(_last_changes, rows.schema)
    if lateness is not None:
        rows = rows.withWatermark("updated_at", lateness)
    begun = None
    if known is not None:
        begun = _moments(known.where(F.col("status") == EXTRACTING)).select("id", "status", "micros").groupBy("id")
    found = rows.groupBy("id").transformWithStateInPandas(
        StuckWatch(minutes, lateness is not None), "id bigint, since bigint", "append",
        "processingTime" if lateness is None else "eventTime", begun,
    )
    return found.select(
        "id",
        F.lit(EXTRACTION_FAILED).alias("status"),
        F.timestamp_micros("since").cast("timestamp_ntz").alias("stuck_since"),
    )


def watch_stuck(
    changes: DataFrame,
    out: str,
    checkpoint: str,
    seconds: int | None = 5,
    minutes: int = STUCK_MINUTES,
    lateness: str | None = None,
    partitions: int | None = None,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Record the findings of :func:`stuck_stream`, batch by batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id)

    return _start(
        stuck_stream(changes, minutes, lateness, known), handle, checkpoint, seconds, STATE_STORE | (
            {} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)}
        )
    )


def found_stuck(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, out, STUCK)


def backfill(
    chunks: DataFrame,
    docs: Rows,
    resolved: Rows,
    out: str,
    checkpoint: str,
    embed_fn: EmbedFn | None,
    has_fallback: bool = False,
    parity: bool = False,
    seconds: int | None = 1,
    vector_col: str | None = None,
) -> StreamingQuery:
    """Embed chunks as they arrive without a vector.

    ``docs`` and ``resolved`` may be functions that read the tables as they are now;
    frames keep the files they began with. A chunk whose document is not there yet is
    written as pending; :func:`backfill_pass` tries it and other open ones again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _embed_missing(
            batch, docs, resolved, out, batch_id, embed_fn, has_fallback, parity, vector_col
        )

    return _start(chunks, handle, checkpoint, seconds)


def _embed_missing(
    chunks: DataFrame, docs: Rows, resolved: Rows, out: str, number: int, embed_fn: EmbedFn | None,
    has_fallback: bool, parity: bool, vector_col: str | None, contents: DataFrame | None = None,
) -> DataFrame:
    owners, credentials = (rows() if callable(rows) else rows for rows in (docs, resolved))
    backlog = embedding_backlog(chunks, owners, vector_col=vector_col, keep_unowned=True)
    plan = plan_backfill(backlog, credentials, has_fallback)
    if contents is not None:
        plan = plan.join(contents.dropDuplicates(VECTOR_KEY), VECTOR_KEY, "left")
    return write_batch(run_backfill(plan, embed_fn, parity), out, number)


def backfill_pass(
    chunks: DataFrame,
    docs: Rows,
    resolved: Rows,
    out: str,
    number: int,
    embed_fn: EmbedFn | None,
    has_fallback: bool = False,
    parity: bool = False,
    vector_col: str | None = None,
    contents: DataFrame | None = None,
) -> DataFrame:
    """Look for missing vectors in the whole table, and write those found as batch ``number``.

    What an earlier pass settled for the same content is left alone; open chunks, which
    waited for their document or a credential or met an error, are tried again.

    With ``contents``, ``(document_id, chunk_index, content_hash, content)``, the chunks have
    ``content_hash`` and ``blank`` instead of contents. These then move only once, when
    everything else about the open chunks is known.
    """
    done = read_levels(chunks.sparkSession, out, VECTORS).where(
        (F.col("batch_id") < number)
        & (~F.col("embed_status").isin(OPEN) | F.col("dim").isNotNull())
    )
    hashed = chunks if contents is not None else chunks.withColumn("content_hash", content_hash())
    waiting = hashed.join(
        done.select(*VECTOR_KEY).distinct(), VECTOR_KEY, "left_anti"
    )
    return _embed_missing(
        waiting, docs, resolved, out, number, embed_fn, has_fallback, parity, vector_col, contents
    )


def backfilled(spark: SparkSession, out: str) -> DataFrame:
    """The last word on every chunk and content."""
    return latest_set(read_levels(spark, out, VECTORS), VECTOR_KEY)


def fold_vectors(spark: SparkSession, out: str) -> None:
    """Fold the vectors of older passes."""
    fold_batches(spark, out, VECTORS, VECTOR_KEY, last_sets(VECTOR_KEY))
