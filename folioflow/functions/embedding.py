"""Attach vectors through a pluggable batch function."""

from __future__ import annotations

import hashlib
import importlib
import sys
import types
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.memory import hand_back

MODEL_DIM = 768
BACKFILL_DIM = 1536
MAX_EMBED_CHARS = 8192
MODEL_BATCH = 1024
VECTOR = T.ArrayType(T.FloatType())

EmbedFn = Callable[[Sequence[str]], "np.ndarray"]


def hashing_embedder(dim: int = MODEL_DIM) -> EmbedFn:
    """Deterministic stand-in for a model: words hashed to buckets, L2-normalised."""

    def embed(texts: Sequence[str]) -> np.ndarray:
        buckets: dict[str, int] = {}
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            slots = []
            for word in text.split():
                slot = buckets.get(word)
                if slot is None:
                    digest = hashlib.md5(word.encode()).digest()
                    slot = buckets[word] = int.from_bytes(digest[:4], "big") % dim
                slots.append(slot)
            if slots:
                out[row] = np.bincount(slots, minlength=dim)
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return (out / np.where(norms == 0, 1, norms)).astype(np.float32)

    return embed


def referred_model(load: Callable[[str], EmbedFn], reference: str) -> EmbedFn:
    """A model that tasks load from ``reference``, once in the life of a Python worker.

    Only ``load`` and the reference travel with the plan, never the model, which may be
    gigabytes. A worker holds the last model it used. One that cannot be loaded fails its
    task, to be tried again, instead of leaving every text without a vector.
    """

    def model() -> EmbedFn:
        # functions arrive anew with every task; what outlives them is the worker's module table
        held = sys.modules.setdefault("_folioflow_models", types.ModuleType("_folioflow_models"))
        key = (load.__module__, load.__qualname__, reference)
        if getattr(held, "key", None) != key:
            held.key = held.model = None  # let go of the last one before the next is loaded
            held.model = load(reference)
            held.key = key
        return held.model

    def embed(texts: Sequence[str]) -> np.ndarray:
        return model()(texts)

    embed.prepare = model
    return embed


def imported_model(function: str, reference: str) -> EmbedFn:
    """A model by names alone: ``module:function`` of a package on the workers, and its reference."""

    def load(named: str) -> EmbedFn:
        place, _, reference = named.partition("@")
        module, _, name = place.partition(":")
        return getattr(importlib.import_module(module), name)(reference)

    return referred_model(load, f"{function}@{reference}")


def _embed_rows(embed_fn: EmbedFn, texts: list[str]) -> list[np.ndarray | None]:
    """One batch call; a failing batch is retried row by row so only bad rows are lost."""
    try:
        return list(np.asarray(embed_fn(texts), dtype=np.float32))
    except Exception:
        if len(texts) == 1:
            return [None]
        return [vector for text in texts for vector in _embed_rows(embed_fn, [text])]


def _list_array(rows: list[np.ndarray | None]) -> pa.ListArray:
    found = [row for row in rows if row is not None]
    offsets = np.cumsum([0] + [0 if row is None else len(row) for row in rows])
    return pa.ListArray.from_arrays(
        pa.array(offsets, type=pa.int32()),
        pa.array(np.concatenate(found) if found else [], type=pa.float32()),
        mask=pa.array([row is None for row in rows], type=pa.bool_()),
    )


def embed(text: Column, embed_fn: EmbedFn | None) -> Column:
    """Vector of the first 8192 characters; NULL without a model, a text or a result."""
    if embed_fn is None:
        return F.lit(None).cast(VECTOR)

    @F.arrow_udf(VECTOR)
    def vectors(batch: pa.Array) -> pa.Array:
        if batch.null_count < len(batch) and hasattr(embed_fn, "prepare"):
            embed_fn.prepare()
        known = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
        parts, done = [], 0
        for at in range(0, len(known), MODEL_BATCH):
            # rows up to this call's last text; only they are Python objects
            end = len(batch) if at + MODEL_BATCH >= len(known) else int(known[at + MODEL_BATCH])
            texts = batch.slice(done, end - done).to_pylist()
            vector = iter(_embed_rows(embed_fn, [text for text in texts if text is not None]))
            parts.append(_list_array([None if text is None else next(vector, None) for text in texts]))
            done = end
        hand_back()
        return pa.concat_arrays(parts) if parts else _list_array([None] * len(batch))

    return vectors(F.substring(text, 1, MAX_EMBED_CHARS))


def dimension(vector: Column) -> Column:
    """Length of a vector, NULL where there is none."""
    return F.when(vector.isNotNull(), F.size(vector))


def vector_marker(chunks: DataFrame) -> str:
    """The column telling whether a chunk has its vector.

    ``dim`` where the table has it: testing that reads a few bytes a row, testing the
    vector itself would read every value.
    """
    return "dim" if "dim" in chunks.columns else "embedding"


def vector_to_text(vector: Column) -> Column:
    """``[a,b,c]`` as vector columns of relational databases read it."""
    items = F.transform(vector, lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def vector_from_text(text: Column) -> Column:
    return F.from_json(text, T.ArrayType(T.DoubleType()))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)
