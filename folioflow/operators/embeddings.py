"""Embedding backlog, credentials and the backfill over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.embedding import (
    BACKFILL_DIM,
    MODEL_DIM,
    EmbedFn,
    dimension,
    embed,
    vector_marker,
    zero_vector,
)
from folioflow.functions.text import is_blank

VENDOR = "openai"


#: States in which a chunk is tried again by a later pass.
PENDING, OPEN = "pending", ["pending", "no_credential", "error"]


def embedding_backlog(
    chunks: DataFrame,
    docs: DataFrame,
    limit: int | None = None,
    vector_col: str | None = None,
    keep_unowned: bool = False,
) -> DataFrame:
    """Chunks without a vector, with the owner of their document.

    Chunks whose document is not there are left out, or kept with ``owned`` false. Chunks
    may bring ``content_hash`` and ``blank``, what is asked of a content, in its place.
    """
    owners = docs.select(F.col("id").alias("document_id"), "uploaded_by_user_id")
    brought = [c for c in ("content", "content_hash", "blank") if c in chunks.columns]
    missing = chunks.where(F.col(vector_col or vector_marker(chunks)).isNull()).select(
        "document_id", "chunk_index", *brought
    )
    if keep_unowned:
        owners = owners.withColumn("owned", F.lit(True))
        rows = missing.join(owners, "document_id", "left").withColumn(
            "owned", F.coalesce("owned", F.lit(False))
        )
    else:
        rows = missing.join(owners, "document_id")
    return rows if limit is None else rows.orderBy("document_id", "chunk_index").limit(limit)


def content_hash() -> Column:
    """Tells whether a vector was made of a chunk's present content."""
    return F.xxhash64(F.coalesce("content", F.lit("")))


def resolve_providers(configurations: DataFrame, providers: DataFrame) -> DataFrame:
    """The provider entry each user's requests go through: ``(user_id, provider_config_id)``.

    The entry must match the user's default exactly, be enabled, and be of the one
    vendor whatever its case. Of several entries the lowest id wins; a minimum
    combines before the shuffle where a window could not.
    """
    usable = providers.where(F.col("is_enabled") & (F.lower("provider") == VENDOR)).select(
        F.col("id").alias("provider_config_id"), "a_i_configuration_id", "provider"
    )
    wanted = configurations.select(
        F.col("id").alias("a_i_configuration_id"),
        "user_id",
        F.col("default_provider").alias("provider"),
    )
    return (
        wanted.join(usable, ["a_i_configuration_id", "provider"])
        .groupBy("user_id")
        .agg(F.min("provider_config_id").alias("provider_config_id"))
    )


def plan_backfill(backlog: DataFrame, resolved: DataFrame, has_fallback: bool) -> DataFrame:
    """Which credential serves each chunk. Key values never appear in the data."""
    source = (
        F.when(F.col("provider_config_id").isNotNull(), "user")
        .when(F.lit(has_fallback), "fallback")
        .otherwise("none")
    )
    blank = F.col("blank") if "blank" in backlog.columns else is_blank(F.col("content"))
    status = F.when(blank, "blank")
    if "owned" in backlog.columns:
        status = status.when(~F.col("owned"), PENDING)
    status = (
        status
        .when(F.col("credential_source") == "none", "no_credential")
        .otherwise("ready")
    )
    return (
        backlog.join(
            resolved.withColumnRenamed("user_id", "uploaded_by_user_id"),
            "uploaded_by_user_id",
            "left",
        )
        .withColumn("credential_source", source)
        .withColumn("embed_status", status)
    )


def run_backfill(
    plan: DataFrame, embed_fn: EmbedFn | None, parity: bool = False, dim: int = BACKFILL_DIM
) -> DataFrame:
    """Vectors for the planned chunks.

    Chunks that cannot be embedded keep NULL and say why in ``embed_status``; with
    ``parity`` they get a vector of zeros, as if it were real.
    """
    ready = F.col("embed_status") == "ready"
    done = plan.withColumn("_vector", embed(F.when(ready, F.col("content")), embed_fn))
    status = (
        F.when(~ready, F.col("embed_status"))
        .when(F.col("_vector").isNull(), "error")
        .otherwise("embedded")
    )
    vector = F.coalesce(F.col("_vector"), zero_vector(dim)) if parity else F.col("_vector")
    return done.select(
        "document_id",
        "chunk_index",
        vector.alias("embedding"),
        status.alias("embed_status"),
        "credential_source",
        content_hash().alias("content_hash"),
    ).withColumn("dim", dimension(F.col("embedding")))


def dimension_audit(
    vectors: DataFrame, expected: int = MODEL_DIM, vector_col: str = "embedding"
) -> DataFrame:
    """Vectors per dimension, flagging any but the expected one."""
    return (
        vectors.groupBy(dimension(F.col(vector_col)).alias("dim"))
        .agg(F.count("*").alias("n"))
        .withColumn("unexpected", F.coalesce(F.col("dim") != expected, F.lit(False)))
    )
