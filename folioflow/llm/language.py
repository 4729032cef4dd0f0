"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of ±1. A trigram's vector is the product of its
letters' vectors, each rotated by its place; a text's vector is the sum over its trigrams,
and a language's prototype the sum over its texts. A text belongs to the language whose
prototype has the largest cosine with it.

NULL texts and texts without a letter are ``und`` with score 0. Ties go to the smallest
language by code point. Without any prototype everything is ``und``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.store import extended, lean
from folioflow.llm.words import SLICE_BYTES, numbers, slices

DIMENSIONS = 512
SYMBOLS = 64
UNDETERMINED = "und"
#: Rows counted at once: the table of counts has a row for each of them.
COUNT_ROWS = 512
#: Dimensions computed at once: more of them cost time, not memory.
DIMENSIONS_AT_ONCE = 512
#: Texts of fewer letters are too short to tell any language from chance.
LEAST_LETTERS = 32
#: So many texts at least are needed to know how near a language's texts are.
LEAST_TEXTS = 100
BEGINNINGS = (64, 128, 256, 512, 1024)


def symbol_table() -> bytes:
    """The symbol of every code point, compressed: 0 for gaps, a-z 1-26, other letters hashed to 27-63."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % 37
    return zlib.compress(table.tobytes(), 6)


def letter_vectors(dimensions: int) -> np.ndarray:
    """±1 vectors of the symbols; the gap symbol has one too and marks word ends."""
    bits = numbers(8, SYMBOLS * dimensions) >> np.uint64(63)
    return (bits.astype(np.float32) * 2 - 1).reshape(SYMBOLS, dimensions)


def trigram_vectors(codes: np.ndarray, letters: np.ndarray, part: slice = slice(None)) -> np.ndarray:
    """Bind: the first letter rotated by two, the second by one, the third as it is; some dimensions of it."""
    first, second = np.roll(letters, 2, axis=1)[:, part], np.roll(letters, 1, axis=1)[:, part]
    return first[codes >> 12] * second[(codes >> 6) & 63] * letters[:, part][codes & 63]


def parts(dimensions: int) -> list[slice]:
    return [slice(k, k + DIMENSIONS_AT_ONCE) for k in range(0, dimensions, DIMENSIONS_AT_ONCE)]


def trigrams(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams around a letter, and the row of each."""
    symbols = table[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    size = np.diff(points)
    rows = np.repeat(np.arange(len(size)), size)
    padded = np.zeros(len(symbols) + 2 * len(size), np.int32)  # two gaps around each text
    padded[np.arange(len(symbols)) + 2 * rows + 1] = symbols
    codes = (padded[:-2] << 12) | (padded[1:-1] << 6) | padded[2:]
    at = np.arange(len(symbols)) + 2 * rows
    keep = symbols != 0
    return codes[at[keep]], rows[keep]


def count_matrix(codes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, and how often each row has each of them."""
    seen = np.zeros(SYMBOLS**3, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(SYMBOLS**3, np.int32)
    place[distinct] = np.arange(len(distinct))
    counts = np.bincount(rows * len(distinct) + place[codes], minlength=n_rows * len(distinct))
    return distinct, counts.reshape(n_rows, len(distinct))


def learn(docs: DataFrame, text: str, lang: str, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The languages and their prototypes, from all rows with a language.

    Tasks sum their rows' vectors; one row per language, task and dimension is shuffled, and
    languages x dimensions numbers reach the driver.
    """
    packed = symbol_table()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(packed), np.uint8)
        letters = letter_vectors(dimensions)
        sums: dict[str, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(list(sums), object), dimensions), pa.string()),
                    pa.array(np.tile(np.arange(dimensions), len(sums)), pa.int64()),
                    pa.array(np.concatenate([*sums.values(), np.zeros(0)]).astype(np.int64)),
                ],
                names=["lang", "place", "total"],
            )
            sums.clear()
            return out

        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for start, stop, data, bounds in slices(batch.column(0)):
                codes, row = trigrams(data, bounds, table)
                kinds, of = np.unique(names[start:stop].astype(str), return_inverse=True)
                distinct, counts = count_matrix(codes, of[row], len(kinds))
                # whole numbers below 2^53: the sums don't depend on the order of rows
                counts = counts.astype(np.float64)
                vectors = np.concatenate([counts @ trigram_vectors(distinct, letters, p) for p in parts(dimensions)], axis=1)
                for kind, vector in zip(kinds, vectors, strict=True):
                    sums[kind] = sums.get(kind, 0) + vector
                if len(sums) > 1000:
                    yield rows()
        yield rows()

    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    total = (
        known.mapInArrow(lean(bundle), "lang string, place long, total long")
        .groupBy("lang", "place").agg(F.sum("total").alias("total"))
        .collect()
    )
    names = sorted({r.lang for r in total})
    prototypes = np.zeros((len(names), dimensions))
    index = {name: i for i, name in enumerate(names)}
    for r in total:
        prototypes[index[r.lang], r.place] = r.total
    length = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return names, prototypes / np.where(length > 0, length, 1)


def nearest(column: pa.Array, prototypes: np.ndarray, table: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the prototype nearest to each text, -1 for texts without a letter, the cosine, and the number of letters."""
    best, score, size = np.full(len(column), -1), np.zeros(len(column)), np.zeros(len(column), np.int64)
    if not len(prototypes):
        return best, score, size
    for start, stop, data, bounds in slices(column, SLICE_BYTES // 2, COUNT_ROWS):
        codes, row = trigrams(data, bounds, table)
        distinct, counts = count_matrix(codes, row, stop - start)
        counts = counts.astype(np.float32)
        square, cosine = np.zeros(stop - start), np.zeros((stop - start, len(prototypes)))
        for part in parts(prototypes.shape[1]):
            vectors = (counts @ trigram_vectors(distinct, letters, part)).astype(np.float64)
            square += (vectors * vectors).sum(axis=1)
            cosine += vectors @ prototypes[:, part].T
        cosine /= np.sqrt(np.where(square > 0, square, 1))[:, None]
        size[start:stop] = np.bincount(row, minlength=stop - start)
        some = size[start:stop] > 0
        best[start:stop] = np.where(some, cosine.argmax(axis=1), -1)
        score[start:stop] = np.where(some, cosine.max(axis=1).clip(0, 1), 0)
    return best, score, size


def predict(docs: DataFrame, text: str, keep: list[Column], names: list[str], prototypes: np.ndarray) -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score`` of every row."""
    packed = symbol_table()
    dimensions = prototypes.shape[1]
    source = docs.select(*keep, F.col(text).alias("_text"))
    kept = source.drop("_text").schema

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(packed), np.uint8)
        letters = letter_vectors(dimensions)
        for batch in batches:
            best, score, _ = nearest(batch.column(batch.num_columns - 1), prototypes, table, letters)
            label = np.array([*names, UNDETERMINED], object)[best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(label, pa.string()), pa.array(score)],
                names=[*kept.names, "lang_pred", "score"],
            )

    return source.mapInArrow(lean(compare), extended(kept, "lang_pred string, score double"))


def limits(docs: DataFrame, text: str, prototypes: np.ndarray, share: float = 0.01, part: float = 2 / 3) -> np.ndarray:
    """The least cosine of a text of 2^k to 2^(k+1) letters, for each k: ``part`` of what all but ``share`` reach.

    Cosines grow with the text. Every text learned counts whole, and tells of short ones by its
    beginnings of BEGINNINGS characters; a length of fewer than LEAST_TEXTS is judged as the one below it,
    and texts below LEAST_LETTERS are not judged. A histogram (lengths x 1001) reaches the driver.
    """
    packed = symbol_table()
    dimensions = prototypes.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(packed), np.uint8)
        letters = letter_vectors(dimensions)
        for batch in batches:
            texts = batch.column(0)
            longer = texts.filter(pc.greater(pc.utf8_length(texts), BEGINNINGS[-1]))  # the others are their beginnings
            for judged_by in [*(pc.utf8_slice_codeunits(texts, 0, most) for most in BEGINNINGS), longer]:
                _, score, size = nearest(judged_by, prototypes, table, letters)
                judged = size >= LEAST_LETTERS
                cells = np.log2(size[judged]).astype(np.int64) * 1001 + (score[judged] * 1000).astype(np.int64)
                cell, texts = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(texts.astype(np.int64))], names=["cell", "texts"])

    source = docs.select(F.col(text).alias("text")).where("text IS NOT NULL")
    found = source.mapInArrow(lean(measure), "cell long, texts long").groupBy("cell").agg(F.sum("texts").alias("texts")).collect()
    table, least = np.zeros((64, 1001)), np.zeros(64)
    for r in found:
        table[divmod(r.cell, 1001)] = r.texts
    for k, reached in enumerate(table.cumsum(axis=1)):
        enough = reached[-1] >= LEAST_TEXTS
        least[k] = np.searchsorted(reached, share * reached[-1], "right") / 1000 * part if enough else least[max(0, k - 1)]
    return least


def speaking(docs: DataFrame, text: str, prototypes: np.ndarray, least: np.ndarray) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and, for its length, a prototype near enough."""
    packed = symbol_table()
    dimensions, at = prototypes.shape[1], docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(packed), np.uint8)
        letters = letter_vectors(dimensions)
        for batch in batches:
            best, score, size = nearest(batch.column(at), prototypes, table, letters)
            need = np.where(size >= LEAST_LETTERS, least[np.log2(np.maximum(size, 1)).astype(np.int64)], 0)
            yield batch.filter(pa.array((best >= 0) & (score >= need)))

    return docs.mapInArrow(lean(keep), docs.schema)
