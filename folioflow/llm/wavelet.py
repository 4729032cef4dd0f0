"""Token ids in wavelet matrices, one compressed file a shard.

A shard holds the ids of a range of documents as bit planes, highest bit first: every
plane keeps the order of the plane above with all zeros moved before all ones. With the
number of ones before each block of bits, single ids can be read (access), counted (rank)
and found (select) without unpacking the rest.

File: ``WMX1``, the length of a JSON header (little-endian unsigned 32 bits), the header,
then zstd frames: the documents' ids, their token counts, and for every plane its bits in
blocks of ``BLOCK`` bits. The header has the frames' lengths and the ones before each block.

NULL texts are empty; every document ends with the end id. NULL ids sort first, repeated
ids by their text's digest; equal rows are equal anyway. An empty table has no shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.store import lean, open_store, running_totals, write_file
from folioflow.llm.words import WordHasher, slices
from folioflow.session import workspace

MAGIC = b"WMX1"
BLOCK = 1 << 19
LEVEL = 1
CACHE_BYTES, SHARD_BYTES = 48 << 20, 8 << 20
#: Memory of a remembered piece, and bytes of text encoded at once.
PIECE_BYTES, ENCODE_BYTES = 64, 1 << 19
#: Tasks that write shards; beyond so many shards a task writes several, one after the other.
MOST_TASKS = 20_000


class Pieces:
    """A hash table from 64-bit hashes to numbers, for many at once; 0 is no hash."""

    def __init__(self, most: int) -> None:
        self.room = most
        size = 1 << max(4, (2 * most).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers, -1 for unknown hashes."""
        found, open_, slot = np.full(len(hashes), -1, np.int32), np.arange(len(hashes)), hashes & self.mask
        while len(open_):
            held = self.keys[slot]
            same = held == hashes[open_]
            found[open_[same]] = self.values[slot[same]]
            more = ~same & (held != 0)
            open_, slot = open_[more], (slot[more] + np.uint64(1)) & self.mask
        return found

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Distinct unknown hashes."""
        slot = hashes & self.mask
        while len(hashes):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] == 0]
            self.keys[slot[first]], self.values[slot[first]] = hashes[first], values[first]
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            hashes, values, slot = hashes[rest], values[rest], (slot[rest] + np.uint64(1)) & self.mask


def _grown(array: np.ndarray, need: int) -> np.ndarray:
    """The array, or a longer one that begins with it."""
    if need <= len(array):
        return array
    longer = np.empty(max(need, 2 * len(array)), array.dtype)
    longer[:len(array)] = array
    return longer


class Encoder:
    """Whole texts to ids of a byte-level BPE file, by way of the distinct pieces between spaces.

    Special strings become their own ids, as the library does by default; with ``plain`` they
    are text like any other.

    The tokenizer never merges across the start of ``space + non-space``, so a text's ids are
    those of its pieces in a row, and the library encodes a piece it has met before only
    once. Spaces before other white space are not such starts, nor are, to be safe, those
    before the lead bytes of wide spaces. New pieces are encoded many in a row; a piece's ids
    are those that cover its bytes. Known pieces are told by a 64-bit hash of their bytes.
    """

    def __init__(self, path: str, memory: int, plain: bool = True) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {} if plain else {t.content: n for n, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {text: np.array([number]) for text, number in special.items()}
        longest = sorted(map(re.escape, special), key=len, reverse=True)
        self.between = re.compile(f"({'|'.join(longest)})") if special else None
        self.marks = [text.encode() for text in special]
        self.tokenizer.encode_special_tokens = True  # of what stands between them, and of all when plain
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)  # one character a byte
        self.kind = np.uint16 if len(self.width) <= 1 << 16 else np.uint32
        self.words = WordHasher()
        self.pieces = Pieces(memory // PIECE_BYTES)
        # the pieces' ids in a row and where each begins; what lies behind the counts is scratch
        self.store, self.held = np.empty(1 << 16, self.kind), 0
        self.begin, self.size, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0
        lead = np.arange(256)
        self.opens = (lead > 32) & (lead != 127) & ~np.isin(lead, [0xC2, 0xE1, 0xE2, 0xE3])

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and how many each has."""
        groups = [new[k:k + 512] for k in range(0, len(new), 512)]
        ids, sizes = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        for group, encoded in zip(groups, self._encode([" " + " ".join(g) for g in groups]), strict=True):
            ends = np.cumsum([len(piece.encode()) + 1 for piece in group])
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.width[encoded]), ends) + 1, prepend=0))
            ids.append(encoded)
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Every text's ids."""
        if self.between is not None and any(map(self.between.search, texts)):
            parts = [self.between.split(text) for text in texts]  # text, special, text, ...
            encoded = iter(self._plain([part for of in parts for part in of[::2]]))
            return [
                np.concatenate([self.special[part].astype(self.kind) if k % 2 else next(encoded) for k, part in enumerate(of)])
                for of in parts
            ]
        return self._plain(texts)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        raw = [text.encode() for text in texts]
        bounds = np.concatenate([[0], np.cumsum([len(one) for one in raw], dtype=np.int64)])
        ids, at = self._pieces(np.frombuffer(b"".join(raw), np.uint8), bounds)
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of some texts in a row and how many each has, for all texts of a column."""
        for start, stop, data, bounds in slices(texts, ENCODE_BYTES):
            if self.marks and any(map(data.tobytes().__contains__, self.marks)):
                found = self(texts.slice(start, stop - start).to_pylist())
                yield np.concatenate(found), np.array([len(one) for one in found])
            else:
                ids, at = self._pieces(data, bounds)
                yield ids, np.diff(at)

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the n + 1 bounds of the texts among them."""
        follows = np.zeros(len(data), bool)
        follows[:-1] = self.opens[data[1:]]
        last = bounds[1:][np.diff(bounds) > 0] - 1
        follows[last] = False  # the next byte is another text's
        cut = np.flatnonzero((data == 32) & follows)
        at = np.searchsorted(cut, bounds)  # each text's first piece after its beginning
        ends = np.concatenate([cut[1:], bounds[-1:]])[:len(cut)]
        has = at[1:] > at[:-1]
        ends[at[1:][has] - 1] = bounds[1:][has]
        first_ends = bounds[1:].copy()
        first_ends[has] = cut[at[:-1][has]]

        raw = data.tobytes()
        hashes = np.maximum(self.words.hashes(data, cut, ends), np.uint64(1))
        number = self.pieces.find(hashes)
        unknown = np.flatnonzero(number < 0)
        fresh, where, back = np.unique(hashes[unknown], return_index=True, return_inverse=True)
        some = unknown[where]
        learned, sizes = self._learn([raw[a:b].decode() for a, b in zip((cut[some] + 1).tolist(), ends[some].tolist(), strict=True)])
        firsts = self._encode([raw[a:b].decode() for a, b in zip(bounds[:-1].tolist(), first_ends.tolist(), strict=True)])

        # known pieces, then new ones, then the texts' beginnings
        lengths = np.array([len(one) for one in firsts], np.int64)
        base, behind = self.held + len(learned), self.count + len(sizes)
        self.store = _grown(self.store, base + int(lengths.sum()))
        self.store[self.held:base] = learned
        if len(firsts):
            self.store[base:base + int(lengths.sum())] = np.concatenate(firsts)
        self.begin, self.size = _grown(self.begin, behind), _grown(self.size, behind)
        self.begin[self.count:behind] = self.held + np.cumsum(sizes) - sizes
        self.size[self.count:behind] = sizes
        number[unknown] = self.count + back
        take_begin = np.insert(self.begin[number], at[:-1], base + np.cumsum(lengths) - lengths)
        take_size = np.insert(self.size[number], at[:-1], lengths)
        past = np.concatenate([[0], np.cumsum(take_size)])
        ids = self.store[np.repeat(take_begin - past[:-1], take_size) + np.arange(past[-1])]

        keep = min(len(fresh), self.pieces.room)  # remember no more: the frequent ones come early
        if keep:
            self.pieces.room -= keep
            self.pieces.add(fresh[:keep], np.arange(self.count, self.count + keep, dtype=np.int32))
            self.count += keep
            self.held += int(sizes[:keep].sum())
        return ids, past[np.concatenate([at[:-1] + np.arange(len(at) - 1), [len(past) - 1]])]


def encoder(path: str, memory: int = CACHE_BYTES, plain: bool = True) -> Encoder:
    """The worker's encoder of a file: the pieces it knows, ``memory`` bytes, outlive a task."""
    home = sys.modules.setdefault("folioflow_worker", types.ModuleType("folioflow_worker"))
    if not hasattr(home, "encoders"):
        home.encoders = {}
    if (path, memory, plain) not in home.encoders:
        home.encoders[path, memory, plain] = Encoder(path, memory, plain)
    return home.encoders[path, memory, plain]


class WaveletMatrix:
    """Succinct sequence of ids over ``depth`` bit planes."""

    def __init__(self, planes: list[np.ndarray], size: int) -> None:
        self.planes, self.size = planes, size  # planes: packed bits
        self.zeros = [size - int(np.bitwise_count(p).sum()) for p in planes]
        self.before = [np.concatenate([[0], np.cumsum(np.bitwise_count(p), dtype=np.int64)]) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        planes, now = [], ids.astype(np.uint16 if len(ids) == 0 or ids.max() < 1 << 16 else np.uint32)
        for k in reversed(range(depth_of(ids))):
            one = (now & now.dtype.type(1 << k)) != 0
            planes.append(np.packbits(one))
            now = np.concatenate([now.compress(~one), now.compress(one)])
        return cls(planes, len(ids))

    def rank(self, plane: int, end: int) -> int:
        """Ones among the first ``end`` bits of a plane."""
        byte, bit = divmod(end, 8)
        extra = int(self.planes[plane][byte] >> (8 - bit)).bit_count() if bit else 0
        return int(self.before[plane][byte]) + extra

    def bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3] >> (7 - (at & 7))) & 1

    def access(self, at: int) -> int:
        value = 0
        for plane, zeros in enumerate(self.zeros):
            one = self.bit(plane, at)
            value = value << 1 | one
            ones = self.rank(plane, at)
            at = zeros + ones if one else at - ones
        return value

    def interval(self, value: int, end: int) -> tuple[int, int]:
        """Where the value's entries among the first ``end`` lie below the last plane."""
        low = 0
        for plane, zeros in enumerate(self.zeros):
            ones = (self.rank(plane, low), self.rank(plane, end))
            if value >> (len(self.zeros) - 1 - plane) & 1:
                low, end = zeros + ones[0], zeros + ones[1]
            else:
                low, end = low - ones[0], end - ones[1]
        return low, end

    def count(self, value: int, end: int | None = None) -> int:
        """How often a value occurs among the first ``end`` ids."""
        if value >> len(self.planes):
            return 0
        low, high = self.interval(value, self.size if end is None else end)
        return high - low

    def locate(self, value: int, nth: int) -> int:
        """Position of the nth occurrence (from 0)."""
        low, high = self.interval(value, self.size)
        if value >> len(self.planes) or not 0 <= nth < high - low:
            raise IndexError("no such occurrence")
        at = low + nth
        for plane in reversed(range(len(self.planes))):
            one = value >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, at - self.zeros[plane] if one else at, one)
        return at

    def _select(self, plane: int, nth: int, one: int) -> int:
        """Position of the nth bit (from 0) equal to ``one``."""
        before = self.before[plane] if one else np.arange(len(self.before[plane])) * 8 - self.before[plane]
        byte = int(np.searchsorted(before, nth, "right")) - 1
        for bit in range(8):
            if self.bit(plane, byte * 8 + bit) == one:
                nth -= 1 if before[byte] < nth + 1 else 0
                if nth < before[byte]:
                    return byte * 8 + bit
        raise AssertionError

    def all(self) -> np.ndarray:
        """Every id in order: the planes undone from the lowest."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.size, kind)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            one = np.unpackbits(plane, count=self.size).view(bool)
            above = np.empty(self.size, kind)
            above[np.flatnonzero(~one)] = now[:zeros]
            above[np.flatnonzero(one)] = now[zeros:] | kind(1 << k)
            now = above
        return now.astype(np.uint32)


def depth_of(ids: np.ndarray) -> int:
    return max(1, int(ids.max()).bit_length()) if len(ids) else 1


def pack(matrix: WaveletMatrix, doc_ids: list[int | None], counts: np.ndarray) -> bytes:
    """The bytes of a shard's file."""
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    members, ones = [compress(json.dumps(doc_ids).encode()), compress(counts.astype("<i8").tobytes())], []
    for plane, before in zip(matrix.planes, matrix.before, strict=True):
        ones.append([int(before[at]) for at in range(0, len(plane), BLOCK // 8)])
        members += [compress(plane[at:at + BLOCK // 8].tobytes()) for at in range(0, len(plane), BLOCK // 8)]
    header = json.dumps({"size": matrix.size, "planes": len(matrix.planes), "members": [len(m) for m in members], "ones": ones}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *members])


def unpack(content: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    if content[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    (length,) = struct.unpack("<I", content[4:8])
    header, at = json.loads(content[8:8 + length]), 8 + length
    members = []
    decompress = zstandard.ZstdDecompressor().decompress
    for size in header["members"]:
        members.append(decompress(content[at:at + size]))
        at += size
    doc_ids, counts = json.loads(members[0]), np.frombuffer(members[1], "<i8")
    per = len(header["ones"][0])
    planes = [np.frombuffer(b"".join(members[2 + k * per:2 + (k + 1) * per]), np.uint8) for k in range(header["planes"])]
    return WaveletMatrix(planes, header["size"]), doc_ids, counts


def stored_ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def write_shards(docs: DataFrame, key: str, text: str, folder: str, vocabulary: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES, memory: int = CACHE_BYTES) -> DataFrame:
    """Write the documents' ids in ascending order of ``key``; one row per shard (part, piece, name, docs, tokens).

    Texts are dealt by range of the key into shards of about ``shard_bytes``; a task holds
    the ids of one shard, 2 bytes each, and publishes its file when it is complete. Shards
    follow each other by (part, piece), as numbers.
    """
    source = stored_ids(docs, key, text)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(max(1, min(MOST_TASKS, -(-total // shard_bytes))))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary, memory, plain=False)
        part, piece = TaskContext.get().partitionId(), 0
        store, path = open_store(folder)
        ids, doc_ids, counts, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{piece:06d}.wm"
            joined = np.concatenate(ids)
            ids.clear()
            write_file(store, f"{path}/{name}", pack(WaveletMatrix.build(joined), doc_ids, np.concatenate(counts)))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "piece": piece, "name": name, "docs": len(doc_ids), "tokens": len(joined)}], _shard_rows()
            )

        for batch in batches:
            names, done = batch.column(0).to_pylist(), 0
            for found, lengths in encode.column(batch.column(1)):
                ends = np.cumsum(lengths)
                ids.append(np.insert(found, ends, end_id))
                doc_ids += names[done:done + len(lengths)]
                counts.append(lengths + 1)
                done += len(lengths)
                size += len(found)
                if 2 * size > shard_bytes:  # a range of more than its share
                    yield close()
                    piece, size = piece + 1, 0
                    doc_ids.clear()
                    counts.clear()
        if doc_ids:
            yield close()

    store, path = open_store(folder)
    store.create_dir(path)
    order = ["doc_id", F.xxhash64("text")]
    dealt = source.repartitionByRange(tasks, *order).sortWithinPartitions("doc_id", F.xxhash64("text"), F.sha2("text", 256))
    return dealt.mapInArrow(lean(write), SHARD)


SHARD = "part long, piece long, name string, docs long, tokens long"


def _shard_rows() -> pa.Schema:
    return pa.schema([("part", pa.int64()), ("piece", pa.int64()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def placed(shards: DataFrame) -> DataFrame:
    """Shards with ``start``, the number of ids in all shards before, in the order of (part, piece)."""
    parts = running_totals(shards.groupBy("part").agg(F.sum("tokens").alias("all")), "part", "all", "before")
    within = F.sum("tokens").over(Window.partitionBy("part").orderBy("piece")) - F.col("tokens")
    return shards.join(parts.drop("all"), "part").withColumn("start", F.col("before") + within).drop("before")


def read_shards(spark: SparkSession, shards: DataFrame, folder: str, rows: Callable, schema: str) -> DataFrame:
    """``rows(shard row, matrix, doc_ids, counts)`` of every shard, each file read whole by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                with store.open_input_stream(f"{path}/{shard['name']}") as file:
                    yield rows(shard, *unpack(file.read()))

    return shards.mapInArrow(lean(read), schema)


def token_table(docs: DataFrame, key: str, text: str, vocabulary: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES, memory: int = CACHE_BYTES) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the written shards.

    ``memory`` bounds the pieces a worker remembers: fewer save memory and cost time.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "wavelet")
    manifest = f"{folder}-manifest"
    write_shards(docs, key, text, folder, vocabulary, end_id, shard_bytes, memory).write.parquet(manifest)
    shards = spark.read.schema(SHARD).parquet(manifest)

    def rows(shard: dict, matrix: WaveletMatrix, doc_ids: list, counts: np.ndarray) -> pa.RecordBatch:
        ids = matrix.all().astype("<u4")
        ends = np.cumsum(counts)
        crc = [zlib.crc32(ids[e - c:e].tobytes()) for c, e in zip(counts, ends, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(shard["start"] + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    dealt = placed(shards).repartition(max(1, min(MOST_TASKS, shards.count())))
    return read_shards(spark, dealt, folder, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")
