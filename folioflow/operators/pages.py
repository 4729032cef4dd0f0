"""Assemble page texts into document texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X

MIN_DIRECT_CHARS = 50
PAGES_PER_BLOCK = 64


def page_part(page: Column, direct: Column, recognised: Column) -> Column:
    """One page with its header; recognised text where the direct text is too short."""
    enough = F.length(X.strip(F.coalesce(direct, F.lit("")))) >= MIN_DIRECT_CHARS
    number = page.cast("string")
    return F.when(
        enough, F.concat(F.lit("\n--- Página "), number, F.lit(" ---\n"), direct, F.lit("\n"))
    ).otherwise(
        F.concat(
            F.lit("\n--- Página "), number, F.lit(" (OCR) ---\n"),
            F.coalesce(recognised, F.lit("")), F.lit("\n"),
        )
    )


def assemble_pages(
    pages: DataFrame,
    max_chars: int = X.MAX_TEXT_CHARS,
    pages_per_block: int = PAGES_PER_BLOCK,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """``(document_id, page, page_text, ocr_text)`` to ``(document_id, text, n_pages)``.

    Texts longer than ``max_chars`` end in the truncation marker, so pages far beyond
    the limit never have to meet in one group: lengths are summed per block of pages
    first, and only blocks that begin within the limit are collected. A document of
    any number of pages thus gathers at most ``max_chars`` characters plus one block.

    With ``wanted``, a frame of ``document_id``, only those documents are assembled.
    They are picked among the blocks: joining the pages by document would bring all
    pages of a hot document to one task.
    """
    part = F.col("part")
    parts = pages.select(
        "document_id",
        "page",
        F.floor(F.col("page") / pages_per_block).alias("block"),
        page_part(F.col("page"), F.col("page_text"), F.col("ocr_text")).alias("part"),
    )
    whole_document = Window.partitionBy("document_id")
    so_far = whole_document.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # Headers are never blank: white space ends the text only after the last page, and
    # at its start there is just the newline before the first header.
    last_tail = F.max_by("tail", "block").over(whole_document)
    starts = (
        parts.groupBy("document_id", "block")
        .agg(
            F.sum(F.length(part)).alias("chars"),
            F.count("*").alias("pages"),
            F.max_by(F.length(part) - F.length(X.rstrip(part)), "page").alias("tail"),
        )
        .select(
            "document_id",
            "block",
            (F.sum("chars").over(so_far) - F.col("chars")).alias("start"),
            F.sum("pages").over(whole_document).alias("n_pages"),
            (F.sum("chars").over(whole_document) - last_tail - 1).alias("n_chars"),
        )
        .where(F.col("start") <= max_chars + 1)
    )
    if wanted is not None:
        starts = starts.join(wanted.select("document_id"), "document_id", "left_semi")
    kept = (
        parts.join(starts, ["document_id", "block"])
        .groupBy("document_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("page", "part"))).alias("kept"),
            F.max("n_pages").alias("n_pages"),
            F.max("n_chars").alias("n_chars"),
        )
    )
    whole = F.array_join(F.transform("kept", lambda p: p["part"]), "")
    return kept.select(
        "document_id",
        F.when(
            F.col("n_chars") > max_chars,
            F.concat(F.substring(whole, 2, max_chars), F.lit(X.TRUNCATION_MARKER)),
        )
        .otherwise(X.strip(whole))
        .alias("text"),
        "n_pages",
    )
