"""From messages and stored objects to texts and final states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators.pages import assemble_pages
from folioflow.schemas import EXTRACTION_FAILED, PROCESSED
from folioflow.sources.blobs import fetch
from folioflow.sources.objects import ObjectStore, fetch_objects


def route(messages: DataFrame, complete: bool = False) -> DataFrame:
    return messages.withColumn(
        "extension", X.file_extension(F.col("file_type"), complete)
    ).withColumn("extractor", X.extractor(F.col("extension")))


def extracted_texts(
    messages: DataFrame,
    pages: DataFrame | None,
    recognised: DataFrame | None,
    max_chars: int = X.MAX_TEXT_CHARS,
) -> DataFrame | None:
    """``(document_id, text)`` of the paged and image documents among ``messages``.

    Only the pages of documents at hand are assembled, so a retry of a few documents
    does not put the whole page table together.
    """
    wanted = messages.where(F.col("extractor") != "text").select("document_id")
    parts = []
    if pages is not None:
        assembled = assemble_pages(pages, max_chars, wanted=wanted)
        parts.append(assembled.select("document_id", "text"))
    if recognised is not None:
        parts.append(
            recognised.join(wanted, "document_id", "left_semi").select("document_id", "text")
        )
    return reduce(DataFrame.unionByName, parts) if parts else None


def process_documents(
    messages: DataFrame,
    blobs: DataFrame | ObjectStore,
    pages: DataFrame | None = None,
    recognised: DataFrame | None = None,
    max_bytes: int = X.MAX_FILE_BYTES,
    max_chars: int = X.MAX_TEXT_CHARS,
    parity: bool = False,
    complete: bool = False,
) -> DataFrame:
    """Outcome of every message: state, text, summary and a typed error.

    ``blobs`` is a table of contents or, better for more than a few, a store that objects
    are fetched from by key: then contents are decoded by the task that read them.
    ``pages`` is the page table of paged documents, ``recognised`` brings
    ``(document_id, text)`` from an outside recogniser; a document is in one of them.
    With ``parity`` a paged or image document without text counts as processed and
    empty, and a text that begins with the error phrase counts as failed; otherwise
    the reverse.
    """
    routed = route(messages, complete)
    plain = F.col("extractor") == "text"
    extracted = extracted_texts(routed, pages, recognised, max_chars)

    def with_extracted(rows: DataFrame) -> DataFrame:
        if extracted is None:
            return rows.withColumn("_extracted", F.lit(None).cast("string"))
        return rows.join(extracted.withColumnRenamed("text", "_extracted"), "document_id", "left")

    if isinstance(blobs, ObjectStore):
        # of other documents only the length is asked for: their texts come from elsewhere
        read = fetch_objects(routed.where(plain), blobs, max_bytes)
        rest = fetch_objects(routed.where(~plain), blobs, max_bytes, content=F.lit(False))
        rows = read.withColumn("_extracted", F.lit(None).cast("string")).unionByName(with_extracted(rest))
    else:
        # contents move last, and only once; of one too large nothing but its length is used
        usable = blobs.withColumn("content", F.when(F.col("length") <= max_bytes, F.col("content")))
        rows = fetch(with_extracted(routed), usable)
    # One step per column: a later step then refers to a value instead of deriving it again.
    rows = rows.withColumn(
        "decoded_as", F.when(plain, X.decoded_as(F.col("content")))
    ).withColumn(
        "raw",
        F.when(plain, X.decode_text(F.col("content"), F.col("decoded_as"))).otherwise(
            F.coalesce(F.col("_extracted"), F.lit(""))
        ),
    )
    error = (
        F.when(F.coalesce(F.col("storage_path"), F.lit("")) == "", "no_storage_path")
        .when(F.col("length").isNull(), "not_found")
        .when(F.col("length") > max_bytes, "too_large")
    )
    if parity:
        error = error.when(X.is_error_text(F.col("raw")), "extraction_error")
    else:
        error = error.when(~plain & F.col("_extracted").isNull(), "not_extracted")
    judged = rows.withColumn("error", error).withColumn(
        "text", X.truncate(F.col("raw"), max_chars)
    )
    fine = F.col("error").isNull()
    return judged.select(
        "document_id",
        "storage_path",
        "file_type",
        F.when(fine, F.lit(PROCESSED)).otherwise(F.lit(EXTRACTION_FAILED)).alias("status"),
        F.when(fine, F.col("text")).alias("text"),
        F.when(fine, X.summarize(F.col("text"))).alias("summary"),
        F.when(fine, F.col("decoded_as")).alias("decoded_as"),
        "error",
    )
