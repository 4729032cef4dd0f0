"""Documents to chunk rows, and the statistics over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE, chunk_array
from folioflow.functions.embedding import EmbedFn, dimension, embed
from folioflow.session import instant

# The three settings the splitter is demonstrated with.
SWEEP = [(500, 100, "small"), (1000, 200, "medium"), (1500, 300, "large")]


def spread(scan: DataFrame) -> DataFrame:
    """Use every core for a CPU-bound stage over a table of few files.

    A scan that already yields a split per core, or files enough to feed a quarter of
    them, passes through unshuffled; so does every large table.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores or 4 * len(scan.inputFiles()) > cores:
        return scan
    return scan.repartition(cores)


def chunk_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows ``(document_id, chunk_index, content)`` plus ``keep``; no shuffle.

    ``chunk_index`` is dense per document, counted after tiny chunks are dropped.
    """
    chunks = docs.select(
        F.col(id_col).alias("document_id"),
        *keep,
        chunk_array(F.col(text_col), size, overlap).alias("chunks"),
    )
    # From an inner explode the optimizer infers a filter on the array below it, which would
    # run the splitter a second time. The outer one keeps filters on other columns pushable.
    return chunks.select(
        "document_id", *keep, F.posexplode_outer("chunks").alias("chunk_index", "content")
    ).where(F.col("chunk_index").isNotNull())


def chunk_sweep(
    docs: DataFrame,
    settings: Sequence[tuple[int, int, str]] = SWEEP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Chunk every text under each setting; the text crosses to Python only once."""
    wide = docs.select(
        F.col(id_col).alias("document_id"),
        *[
            chunk_array(F.col(text_col), size, overlap).alias(f"s{i}")
            for i, (size, overlap, _) in enumerate(settings)
        ],
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("setting"), F.col(f"s{i}").alias("chunks"))
        for i, (_, _, name) in enumerate(settings)
    ])
    return wide.select("document_id", F.inline(rows)).select(
        "document_id", "setting", F.posexplode("chunks").alias("chunk_index", "content")
    )


def chunk_stats(chunks: DataFrame, *by: str) -> DataFrame:
    """Chunk count and length statistics per group; partial sums before the shuffle."""
    size = F.length("content")
    return chunks.groupBy(*by).agg(
        F.count("*").alias("n_chunks"),
        F.min(size).alias("min_chars"),
        F.max(size).alias("max_chars"),
        F.sum(size).alias("total_chars"),
        F.round(F.sum(size) / F.count("*"), 6).alias("avg_chars"),
    )


def chunk_preview(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "document_id",
        "chunk_index",
        F.length("content").alias("n_chars"),
        X.preview(F.col("content")).alias("preview"),
    )


def build_chunk_table(
    docs: DataFrame,
    embed_fn: EmbedFn | None,
    now: dt.datetime,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Chunks with their vectors; a chunk whose vector fails is kept without one.

    ``dim`` repeats the vector's length, so that later counts need not read vectors.
    """
    chunks = chunk_documents(docs, id_col, text_col).withColumn(
        "embedding", embed(F.col("content"), embed_fn)
    )
    return chunks.withColumns({
        "dim": dimension(F.col("embedding")), "created_at": instant(now)
    })


def replace_chunks(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """All chunks after swapping out every document that has fresh ones.

    Documents without a fresh chunk keep theirs. Applying the same set twice
    changes nothing. ``fresh`` is read twice: pass it as stored, not as derived.
    """
    replaced = fresh.select("document_id").distinct()
    return current.join(replaced, "document_id", "left_anti").unionByName(
        fresh, allowMissingColumns=True
    )
