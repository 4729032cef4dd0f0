"""The operators of this subpackage over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import chat, decontaminate, jaccard, language, mixing, multiindex, projections, quality, repair, runs, secrets, warc, wavelet
from folioflow.llm.store import fold

VOCABULARY = "byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; the network learns from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    sample = quality.training_sample(docs, table(spark, sf_dir, "labels"), "text", "doc_id", "quality", ~held_out)
    scored = quality.score(docs, "text", [F.col("doc_id")], quality.train(*sample))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class and its number of links."""
    return jaccard.join(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "class_id", "n_links", "exact_id", "kept")


@query
def op3_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return projections.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query
def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as wavelet shards and read every shard back."""
    return wavelet.token_table(table(spark, sf_dir, "documents"), "doc_id", "text", str(public_tokenizers.path(VOCABULARY)))


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, packed and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = chat.PROBE
    probe = spark.createDataFrame([(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)], rows.schema)
    return chat.formatted(rows.union(probe), "conv_id", "turn", "role", "text", str(public_tokenizers.path(VOCABULARY)))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a source is an owner, its texts of one language a repository."""
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text", F.col("source"), repository)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return decontaminate.hits(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text"
    )


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict every document's language; prototypes learn from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    names, prototypes = language.learn(docs.where(~held_out), "text", "lang")
    return language.predict(docs, "text", [F.col("doc_id")], names, prototypes).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC files and read them back."""
    return warc.archive(table(spark, sf_dir, "pages"), "page_id", "url", "html")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the sources' target weights."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults planted by a digest of conversation and turn; NULLs become a space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    plain = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    return plain.where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage every conversation and repair it; those that lost all rows have no faults and no audit."""
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(rows), "conv_id", "turn", "role", "text")
    every = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "_every")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_every").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a digest of the id, the end repeats a few words."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \t-\r]+"), lambda w: w != "")
    planted = docs.select("doc_id", "text", (digest % 10 == 0).alias("hit"), F.floor(digest / 10).alias("g")).withColumn(
        "w", F.when(F.col("hit"), words).otherwise(F.array().cast("array<string>"))
    ).withColumn("n", F.size("w"))
    at = planted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    )
    place = "transform(w, (x, i) -> element_at(w, cast(if(i < a, i, a + (i - a) % p) AS INT) + 1))"
    return at.select("doc_id", F.when(F.col("hit") & (F.col("n") > 0), F.expr(f"array_join({place}, ' ')")).otherwise(F.col("text")).alias("text"))


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which get looping ends."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(looped(docs), "text")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[k].alias(k) for k in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        runs.run_digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one, among all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = multiindex.build(rows, "vec_id", "embedding", 10)
    return multiindex.search(index, rows.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
