"""Document quality by a byte-level convolutional network in numpy.

A text is cut into chunks of 260 bytes, every chunk sharing 4 bytes with the next, so that
the chunks cover the whole document. Learned filters look at windows of 8 bytes in steps
of 4; each filter's largest response in a chunk is kept, and the mean and the maximum over
all chunks combine into one probability.

NULL and empty texts are one chunk of padding and get a score like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.store import extended, lean
from folioflow.llm.words import slices

CHUNK, STEP = 256, 4
GROUPS = CHUNK // STEP + 1
#: Bounds of the training sample: rows of each label, and bytes of a training text.
SAMPLE_ROWS, SAMPLE_BYTES = 800, 1 << 16


@dataclass
class Network:
    embedding: np.ndarray  # 256 x E; row 0, the padding, stays zero
    filters: np.ndarray  # 2 x (STEP E) x F: the halves of a window
    bias: np.ndarray  # F
    weights: np.ndarray  # 2 F
    offset: np.ndarray  # 1

    @classmethod
    def start(cls, width: int = 8, filters: int = 16, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.5, (256, width)).astype(np.float32)
        embedding[0] = 0
        bank = rng.normal(0, 1 / np.sqrt(2 * STEP * width) * 1.5, (2, STEP * width, filters))
        return cls(
            embedding, bank.astype(np.float32), np.zeros(filters, np.float32),
            rng.normal(0, 0.2, 2 * filters).astype(np.float32), np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.offset]

    def respond(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded groups and the responses of all windows of all chunks."""
        groups = self.embedding[chunks].reshape(len(chunks), GROUPS, -1)
        left, right = groups @ self.filters[0], groups @ self.filters[1]
        return groups, left[:, :-1] + right[:, 1:] + self.bias

    def combine(self, pooled: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the texts whose chunks begin at ``first``."""
        count = np.diff(np.append(first, len(pooled)))[:, None]
        mean = np.add.reduceat(pooled, first, axis=0) / count
        features = np.concatenate([mean, np.maximum.reduceat(pooled, first, axis=0)], axis=1)
        logit = (features @ self.weights + self.offset).astype(np.float64)
        return features, 1 / (1 + np.exp(-logit.clip(-500, 500)))

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        first, where, size = chunk_starts(bounds)
        pooled = np.empty((len(where), len(self.bias)), np.float32)
        for k in range(0, len(where), 512):
            part = slice(k, k + 512)
            pooled[part] = np.maximum(self.respond(cut(data, where[part], size[part]))[1].max(axis=1), 0)
        return self.combine(pooled, first)[1]


def chunk_starts(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First chunk of each text; start in the data and bytes left in its text of each chunk."""
    length = np.diff(bounds)
    count = np.maximum(1, -(-length // CHUNK))
    first = np.cumsum(count) - count
    within = (np.arange(count.sum()) - np.repeat(first, count)) * CHUNK
    return first, within + np.repeat(bounds[:-1], count), np.repeat(length, count) - within


def cut(data: np.ndarray, where: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of chunks, zero beyond their text."""
    place = np.arange(CHUNK + STEP)
    if not len(data):
        return np.zeros((len(where), CHUNK + STEP), np.uint8)
    at = np.minimum(where[:, None] + place, len(data) - 1)
    return np.where(place < size[:, None], data[at], 0)


def train(texts: list[bytes], labels: list[int], epochs: int = 12, batch: int = 32, rate: float = 0.01) -> Network:
    """Adam on the balanced cross-entropy; deterministic."""
    net = Network.start()
    if not texts:
        return net
    y = np.array(labels, np.float32)
    share = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())]) / max(1, len(y))
    rng = np.random.default_rng(2)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            data = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
            bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            weight = (0.5 / share[y[pick].astype(int)]).astype(np.float32)
            step += 1
            pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for p, g, (m, v) in zip(net.parameters(), gradients(net, data, bounds, y[pick], weight), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def gradients(net: Network, data: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean weighted cross-entropy, in the order of the parameters."""
    first, where, size = chunk_starts(bounds)
    chunks = cut(data, where, size)
    groups, response = net.respond(chunks)
    top = response.argmax(axis=1)
    raw = np.take_along_axis(response, top[:, None], axis=1)[:, 0]
    pooled = np.maximum(raw, 0)
    features, probability = net.combine(pooled, first)
    error = ((probability - y) * weight / len(y)).astype(np.float32)
    n_filters = len(net.bias)
    count = np.diff(np.append(first, len(pooled)))
    text = np.repeat(np.arange(len(count)), count)
    back = error[:, None] * net.weights
    pool = back[text, :n_filters] / count[text][:, None]
    pool = pool + np.where(pooled == features[text, n_filters:], back[text, n_filters:], 0)
    pool = np.where(raw > 0, pool, 0).astype(np.float32)
    chunk, kind = np.indices(pool.shape)
    filters, embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
    for half in (0, 1):
        used = groups[chunk, top + half]  # chunks x F x (STEP E)
        filters[half] = np.einsum("cf,cfe->ef", pool, used)
        deep = (pool[:, :, None] * net.filters[half].T[None]).reshape(-1, net.embedding.shape[1])
        seen = chunks.reshape(len(chunks), GROUPS, STEP)[chunk, top + half].reshape(-1)
        for e in range(deep.shape[1]):
            embedding[:, e] += np.bincount(seen, deep[:, e], minlength=256)
    embedding[0] = 0
    return [embedding, filters, pool.sum(axis=0), features.T @ error, np.array([error.sum()], np.float32)]


def training_sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, allowed: Column) -> tuple[list[bytes], list[int]]:
    """Up to SAMPLE_ROWS rows of each label in the order of their keys' hash, texts up to SAMPLE_BYTES.

    Of a key's rows the least text and label count; rows without key, text or label are left out.
    """
    marked = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).where("_key IS NOT NULL AND _label IN (0, 1)")
    sized = docs.where(allowed).select(F.col(key).alias("_key"), F.octet_length(text).alias("_bytes")).where(f"_bytes <= {SAMPLE_BYTES}")
    both = (
        sized.select("_key").distinct().join(marked.groupBy("_key").agg(F.min("_label").alias("_label")), "_key")
        .select("_key", "_label", F.xxhash64("_key").alias("_order"))
    )
    picked = []
    for value in (0, 1):
        picked += both.where(F.col("_label") == value).orderBy("_order", "_key").limit(SAMPLE_ROWS).collect()
    wanted = {r._key: r._label for r in picked}
    if not wanted:
        return [], []
    rows = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .where(F.col("_key").isin(list(wanted)) & (F.octet_length("_text") <= SAMPLE_BYTES))
        .groupBy("_key").agg(F.min("_text").alias("_text")).collect()
    )
    rows.sort(key=lambda r: r._key)
    return [r._text.encode() for r in rows], [wanted[r._key] for r in rows]


def score(docs: DataFrame, text: str, keep: list[Column], net: Network) -> DataFrame:
    """The kept columns and ``score``, the probability of label 1, of every row."""
    source = docs.select(*keep, F.col(text).alias("_text"))
    kept = source.drop("_text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [net.score(data, bounds) for _, _, data, bounds in slices(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([*found, np.zeros(0)]))], names=[*kept.names, "score"]
            )

    return source.mapInArrow(lean(run), extended(kept, "score double"))
