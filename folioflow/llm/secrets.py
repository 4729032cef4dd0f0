"""Secrets in texts, told apart by who owns copies of them.

All of it is DataFrame functions. Base findings are leftmost non-overlapping matches of
three patterns. Wider candidates, long runs of token characters, become findings of kind
``owned`` when they look live and belong to few owners: the digests of all candidates are
counted by distinct owner and repository over the whole corpus, and what many owners hold
is a widely copied example. Copies within a repository count once, so a value that a third
of all rows repeat is a few rows after the first aggregation.

A match's place follows from the lengths of the pieces between matches, added up per text
in a window; lengths are in code points. Only digests of candidates are stored.

NULL and empty texts have no finding. A NULL owner or repository counts as one. Rows with
equal or NULL ids are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.store import materialise

#: Fixed patterns: kind, pattern, group of the value, least length of the value, and a pattern
#: that every text with a finding has.
PATTERNS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18, r"AKIA[A-Z0-9]{14}"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
    ("owned", r"[A-Za-z0-9+/_-]{20,}", 0, 20, r"[A-Za-z0-9+/_-]{20}"),
]
BASE = [kind for kind, *_ in PATTERNS[:3]]
#: A value held by this many owners is an example; a live one has this many distinct characters.
EXAMPLE_OWNERS, LIVE_CHARACTERS = 3, 8


def looks_live(value: Column) -> Column:
    """Letters and digits mixed, and not a few characters repeated."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS)


def matches(text: Column, number: int) -> Column:
    """All matches of a pattern: kind, gap before, length, value's digest and two tests of it."""
    _, pattern, group, least, quick = PATTERNS[number]
    whole, value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    rows = F.transform(zipped, lambda m, k: F.struct(
        F.lit(number).alias("kind"), k.alias("place"), F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("size"),
        F.md5(m["value"]).alias("digest"), (F.length(m["value"]) >= least).alias("long"), looks_live(m["value"]).alias("live"),
    ))
    return F.when(text.rlike(quick), rows).otherwise(F.array().cast("array<struct<kind:int,place:int,gap:int,size:int,digest:string,long:boolean,live:boolean>>"))


def candidates(docs: DataFrame, key: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """Every row of ``docs`` with its row number, owner and matches, found in one pass over the texts."""
    named = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return named.select("row", "doc_id", "owner", "repository", F.concat(*[matches(F.col("text"), k) for k in range(len(PATTERNS))]).alias("found"))


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, owners, repositories) of every candidate value."""
    per_repository = spans.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repository.groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(docs: DataFrame, key: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and the counts of the method.

    n_owned counts added findings, n_examples candidates that many owners hold, n_live
    owner-specific ones that look live.
    """
    stored = materialise(candidates(docs, key, text, owner, repository), "secrets-found")
    rows = stored.where(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("m")).select("row", "owner", "repository", "m.*")
    order = Window.partitionBy("row", "kind").orderBy("place")
    ended = F.sum(F.col("gap") + F.col("size")).over(order)
    spans = materialise(
        rows.withColumn("end", ended).withColumn("start", F.col("end") - F.col("size")).where("long")
        .select("row", "owner", "repository", "kind", "start", "end", "digest", "live"), "secrets-spans",
    )
    held = ownership(spans)
    judged = spans.join(held, "digest").select(
        "row", "kind", "start", "end", (F.col("owners") >= EXAMPLE_OWNERS).alias("example"), "live"
    )
    # an added finding inside a base finding says nothing new
    base = F.col("kind") < len(BASE)
    reach = F.max(F.when(base, F.col("end"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    added = F.col("live") & ~F.col("example") & (F.coalesce("reach", F.lit(-1)) < F.col("end"))
    kept = judged.withColumn("reach", reach).withColumn("kept", base | added)
    name = F.element_at(F.array(*[F.lit(kind) for kind, *_ in PATTERNS]), F.col("kind") + 1)
    entry = F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("name"))
    per_row = kept.groupBy("row").agg(
        *[F.count_if((F.col("kind") == k) & F.col("kept")).alias(f"n_{kind}") for k, (kind, *_) in enumerate(PATTERNS)],
        F.count_if("example").alias("n_examples"), F.count_if(F.col("live") & ~F.col("example")).alias("n_live"),
        F.sort_array(F.collect_list(F.when(base, entry))).alias("base"), F.sort_array(F.collect_list(F.when(F.col("kept"), entry))).alias("all"),
    )
    counts = [f"n_{kind}" for kind, *_ in PATTERNS] + ["n_examples", "n_live"]
    joined = stored.select("row", "doc_id").join(per_row, "row", "left")
    listed = {name: F.coalesce(F.array_join(F.col(f"{name}.name"), ","), F.lit("")) for name in ("base", "all")}
    return joined.select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[:3]], F.sha2(listed["base"], 256).alias("base_sha256"),
        listed["all"].alias("spans"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[3:]],
    )
