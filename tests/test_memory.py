"""What a Python worker holds at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.functions import chunking, embedding
from folioflow.functions.memory import text_slices


@pytest.fixture
def plainly(monkeypatch):
    """Batch functions called as they are."""
    monkeypatch.setattr(F, "arrow_udf", lambda _: lambda function: function)
    monkeypatch.setattr(F, "substring", lambda text, *_: text)


def peak(work):
    tracemalloc.start()
    result = work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return result, most


def test_slices_hold_every_row_once():
    texts = ["a" * 10, None, "", "é" * 50, None, "b" * 5, "c" * 5]
    for column in (pa.array(texts), pa.array(["x", *texts]).slice(1), pa.array([], pa.string())):
        parts = [part.to_pylist() for part in text_slices(column, 10)]
        assert [t for part in parts for t in part] == column.to_pylist()
        assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 10 for p in parts)


def test_chunks_of_a_full_batch_are_made_by_slices(plainly):
    texts = [f"{i} " + "some words. " * 170 for i in range(10_000)]
    batch = pa.array([*texts, None])
    found, most = peak(lambda: chunking.chunk_array(batch))
    assert found.slice(9_998).to_pylist() == [*map(chunking.split_text, texts[9_998:]), []]
    assert len(found) == 10_001 and most < 15 << 20


def test_vectors_of_a_full_batch_are_held_once(plainly):
    texts = [None, *(f"word{i % 7} other" for i in range(9_998)), None]
    model = embedding.hashing_embedder()
    found, most = peak(lambda: embedding.embed(pa.array(texts), model))
    assert found[0].as_py() is None and found[9_999].as_py() is None
    for at in (1, 1_024, 1_025, 9_998):
        assert np.allclose(found[at].as_py(), model([texts[at]])[0])
    assert most < 56 << 20  # the vectors themselves are 31 MB
