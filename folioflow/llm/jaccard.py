"""N-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

Two texts link when the Jaccard similarity of their sets of ``size``-word shingles is at
least ``threshold``. Texts of the same words are one class, found by a digest; only one
text per class is hashed into bands. The numbers of bands and rows are the cheapest that
reach the target recall at the threshold.

Buckets never become pairs of rows. They only tell which texts may belong together: the
texts of a candidate component are dealt into blocks of bounded size, every two blocks
meet once in one task, and there the pairs that share a band are compared exactly and
counted. A task emits per text the number of its links and one edge towards each local
cluster, so the output grows with the texts and not with the pairs.

NULL and empty texts, or texts of white space only, link with nothing. A text of fewer
words than a shingle has one shingle of all its words. Rows with equal or NULL ids are
rows of their own; of equal ids the first by row order is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from folioflow.llm.blocks import meetings, tally, whole_groups
from folioflow.llm.components import components
from folioflow.llm.store import extended, lean, materialise, shuffle_width
from folioflow.llm.words import WordHasher, mix, numbers, shingles, slices

SIZE, THRESHOLD, RECALL = 5, 0.8, 0.9999
U64 = np.uint64


def banding(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the most selective banding within ``most_hashes`` that reaches the recall."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("no banding reaches the recall with so few hashes")


def signatures(items: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 32-bit number per text and band; texts must have shingles."""
    words = (items >> U64(32)).astype(np.uint32)
    first = bounds[:-1]
    out = np.zeros((len(first), bands), U64)
    factor, offset = (numbers(seed, bands * rows).astype(np.uint32) for seed in (3, 4))
    fold = numbers(5, rows) | U64(1)
    for band in range(bands):
        for row in range(rows):
            k = band * rows + row
            least = np.minimum.reduceat(words * (factor[k] | np.uint32(1)) + offset[k], first)
            out[:, band] += least.astype(U64) * fold[row]
    return (mix(out) >> U64(32)).astype(np.int64)


def sign(docs: DataFrame, key: str, text: str, carry: list[Column], size: int, bands: int, rows: int) -> DataFrame:
    """Every row with a row number, its compressed text, the digest of its words, and its band numbers.

    ``carry`` are columns to keep with the row; they come back in the struct ``carried``.
    """
    source = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
        F.struct(F.lit(True).alias("here"), *carry).alias("carried"),
    )
    kept = source.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, compress = WordHasher(), zstandard.ZstdCompressor().compress
        for batch in batches:
            for start, stop, data, bounds in slices(batch.column(0)):
                begin, end, at = hasher.spans(data, bounds)
                words = hasher.hashes(data, begin, end)
                digest = np.zeros((stop - start, 2), np.int64)
                some = np.flatnonzero(np.diff(at))
                found = np.zeros((stop - start, bands), np.int64)
                if len(some):
                    place = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))
                    for k in (0, 1):
                        term = mix(words * U64(2 * k + 1) + mix(place.astype(U64) + U64(k << 60)))
                        digest[some, k] = np.add.reduceat(term, at[some]).view(np.int64)
                    items, bound = shingles(words, at, size)
                    found[some] = signatures(items, np.append(bound[some], len(items)), bands, rows)
                raw = data.tobytes()
                packed = [compress(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                part = batch.slice(start, stop - start)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(stop - start + 1) * bands, pa.int32()), pa.array(found.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(packed, pa.binary()), pa.array(np.diff(bounds)), pa.array(np.diff(at)),
                     pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists],
                    names=[*kept.names, "packed", "size", "words", "d1", "d2", "bands"],
                )

    return source.mapInArrow(lean(run), extended(kept, "packed binary, size long, words long, d1 long, d2 long, bands array<long>"))


def candidates(texts: DataFrame) -> DataFrame:
    """(node, root): the components of texts that share a band, joined through each bucket's least text."""
    buckets = texts.select("class", F.posexplode("bands").alias("band", "value")).select(
        "class", ((F.col("band").cast("long") * (1 << 32)) + F.col("value")).alias("bucket")
    )
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("class").alias("lead")).where("n > 1").select("bucket", "lead")
    edges = buckets.join(shared, "bucket").select(F.col("class").alias("a"), F.col("lead").alias("b"))
    return components(edges, "jaccard-candidates")


def shared_counts(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many items each set of ``rows`` shares with each of ``cols``, by slices of the items in both."""
    used = np.concatenate([rows, cols])
    sizes = np.array([len(sets[k]) for k in used])
    _, item = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    owner = np.repeat(np.arange(len(used)), sizes)
    top = owner < len(rows)
    both = (np.bincount(item[top], minlength=item.max() + 1) > 0) & (np.bincount(item[~top], minlength=item.max() + 1) > 0)
    number = np.cumsum(both) - 1
    keep = both[item]
    item, owner = number[item[keep]], owner[keep]
    order = np.argsort(item, kind="stable")
    item, owner = item[order], owner[order]
    out = np.zeros((len(rows), len(cols)), np.float32)
    total = int(both.sum())
    for low in range(0, total, width):
        part = slice(*np.searchsorted(item, [low, low + width]))
        has = np.zeros((len(used), min(width, total - low)), np.float32)
        has[owner[part], item[part] - low] = 1
        out += has[:len(rows)] @ has[len(rows):].T
    return out


def linked(texts: pa.Array, bands: np.ndarray, block: np.ndarray, low: int, high: int, size: int, threshold: float, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left, right) of a meeting's rows that share a band and reach the threshold."""
    sets: list[np.ndarray] = []
    for _, _, data, bounds in slices(texts):
        begin, end, at = hasher.spans(data, bounds)
        items, bound = shingles(hasher.hashes(data, begin, end), at, size)
        sets += [np.unique(items[a:b]) for a, b in zip(bound[:-1], bound[1:], strict=True)]
    length = np.array([len(s) for s in sets])
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    lefts, rights = [], []
    for at in range(0, len(left), 256):
        some = left[at:at + 256]
        may = np.zeros((len(some), len(right)), bool)
        for band in range(bands.shape[1]):
            may |= bands[some, band][:, None] == bands[right, band]
        if low == high:
            may &= some[:, None] < right
        rows, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
        if not len(rows):
            continue
        common = shared_counts(sets, some[rows], right[cols])
        union = length[some[rows]][:, None] + length[right[cols]] - common
        r, c = np.nonzero(may[np.ix_(rows, cols)] & (common >= threshold * union - 1e-6))
        lefts.append(some[rows[r]])
        rights.append(right[cols[c]])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *lefts]), np.concatenate([empty, *rights])


def verify(members: DataFrame, size: int, threshold: float) -> DataFrame:
    """(class, links, root) per text and meeting with links: the copies it links to, and its local cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, decompress = WordHasher(), zstandard.ZstdDecompressor().decompress
        for (low, high), table in whole_groups(batches, ("root", "low", "high")):
            ids, copies = table["class"].to_numpy(), table["copies"].to_numpy()
            lists = table["bands"].combine_chunks()
            bands = lists.flatten().to_numpy().reshape(len(ids), -1)
            texts = pa.array([decompress(text) for text in table["packed"].to_pylist()], pa.binary())
            left, right = linked(texts, bands, table["block"].to_numpy(), low, high, size, threshold, hasher)
            if not len(left):
                continue
            yield tally(ids, copies, left, right)

    spark = members.sparkSession
    dealt = members.repartition(shuffle_width(spark), "root", "low", "high").sortWithinPartitions("root", "low", "high", "class")
    return dealt.mapInArrow(lean(run), "class long, links long, root long")


def join(docs: DataFrame, key: str, text: str, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, class_id, n_links, exact_id, kept (see ``decide``)."""
    stored = materialise(sign(docs, key, text, [], size, *banding(threshold, recall)), "jaccard-signed")
    return decide(stored, size, threshold).drop("row")


def deduplicate(docs: DataFrame, key: str, text: str, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays per class."""
    others = [F.col(c) for c in docs.columns if c != text]
    carry = [F.struct(*others).alias("others"), F.col(text).isNull().alias("none")]
    stored = materialise(sign(docs, key, text, carry, size, *banding(threshold, recall)), "jaccard-signed")
    gone = decide(stored, size, threshold).where("NOT kept").select("row")
    rest = stored.select("row", "packed", "carried").hint("merge").join(gone, "row", "left_anti").select("packed", "carried")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [decompress(text).decode() for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], names=["text", "carried"])

    whole = rest.mapInArrow(lean(unpack), StructType([StructField("text", StringType()), rest.schema["carried"]]))
    return whole.select(*[
        (F.when(~F.col("carried.none"), F.col("text")) if c == text else F.col(f"carried.others.`{c}`")).alias(c) for c in docs.columns
    ])


def decide(stored: DataFrame, size: int, threshold: float) -> DataFrame:
    """Per signed row: row, doc_id, class_id, n_links, exact_id, kept.

    class_id is the least id reachable by links, exact_id the least id of the same words,
    n_links the number of other rows linked directly, kept marks one row per class.
    """
    known = stored.where("words > 0").groupBy("d1", "d2").agg(
        F.min("row").alias("class"), F.min("doc_id").alias("exact_id"), F.count("*").alias("copies")
    )
    classes = materialise(known, "jaccard-classes")
    texts = stored.select(F.col("row").alias("class"), "bands").join(classes.select("class"), "class", "left_semi")
    roots = materialise(candidates(texts), "jaccard-roots")
    sized = stored.select(F.col("row").alias("class"), "size").join(roots.withColumnRenamed("node", "class"), "class")
    members = materialise(sized.join(classes.select("class", "copies"), "class"), "jaccard-members")
    # the only shuffle of texts; merged at every size, so that a table's growth never changes the plan
    whole = stored.select(F.col("row").alias("class"), "packed", "bands").hint("merge")
    dealt = meetings(members, "root", "class", "size").join(whole, "class")
    found = materialise(verify(dealt.drop("size"), size, threshold), "jaccard-links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    linked_roots = materialise(components(found.select(F.col("class").alias("a"), F.col("root").alias("b")), "jaccard-linked"), "jaccard-linked-roots")
    of_class = (
        classes.join(links, "class", "left").join(linked_roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class")).withColumn("links", F.coalesce("links", F.lit(0)))
    )
    placed = materialise(
        stored.select("row", "doc_id", "d1", "d2", "words").where("words > 0").join(of_class, ["d1", "d2"])
        .select("row", "doc_id", "root", "exact_id", (F.col("links") + F.col("copies") - 1).alias("n_links")),
        "jaccard-placed",
    )
    lead = placed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("keep")
    )
    grouped = placed.join(lead, "root").select("row", "doc_id", "class_id", "n_links", "exact_id", (F.col("row") == F.col("keep")).alias("kept"))
    alone = stored.where("words = 0").select(
        "row", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("exact_id"), F.lit(True).alias("kept")
    )
    return grouped.union(alone)
