"""From raw documents to token files: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import decontaminate, jaccard, language, mixing, wavelet
from folioflow.llm.store import fold, materialise

#: Unlike texts must be told from chance: the noise of a cosine is 1 / sqrt(DIMENSIONS) = 0.022.
DIMENSIONS = 2048
#: The workers also serve the other stages, so the last one takes small shards and remembers few pieces.
SHARD_BYTES, MEMORY = 8 << 20, 24 << 20


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or less like every language than the texts learned are at their length."""
    known = docs.where(fold(F.col("doc_id"), 3) != 1)
    _, prototypes = language.learn(known, "text", "lang", DIMENSIONS)
    least = language.limits(known.where("lang IS NOT NULL"), "text", prototypes)
    return language.speaking(docs, "text", prototypes, least)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return jaccard.deduplicate(docs, "doc_id", "text")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, "text", items, "item_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target asks."""
    return mixing.mixed(docs, "doc_id", "text", "source")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids as wavelet shards; one row per document read back from them."""
    vocabulary = str(public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.token_table(docs, "doc_id", "text", vocabulary, shard_bytes=SHARD_BYTES, memory=MEMORY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify),
    ("deduplicate", deduplicate),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("tokens", tokens),
]

#: No stage but the last writes anything SQL could rebuild: prototypes, MinHash and sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
