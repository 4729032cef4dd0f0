"""Split text into overlapping chunks along a hierarchy of separators.

Packing pieces of a text greedily always yields slices of that text, so the
splitter never builds or joins pieces: it walks the text once per separator
level and records ``(start, end)`` offsets, jumping straight to the last
separator that still fits. Chunks are cut out of the text at the very end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.memory import hand_back, text_slices

# Separators from coarse to fine; below the last, a fixed-width cut.
SEPARATORS = ["\n\n", "\n", ". ", "! ", "? ", "; ", ", ", " "]
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
MIN_CHUNK_CHARS = 10


def _last_fit(text: str, sep: str, start: int, stop: int) -> int:
    """Offset of the last separator at or before ``stop``, or -1.

    Separators are counted left to right without overlapping, so inside a run
    of newlines only every second offset is a paragraph break.
    """
    at = text.rfind(sep, start, stop)
    if at > start and sep[0] == sep[-1] and len(sep) > 1:
        run = at
        while run > start and text[run - 1] == sep[0]:
            run -= 1
        at -= (at - run) % len(sep)
    return at


def _slices(text: str, start: int, end: int, size: int, level: int) -> Iterator[tuple[int, int]]:
    if end - start <= size:
        if start < end:
            yield start, end
        return
    if level == len(SEPARATORS):
        for at in range(start, end, size):
            yield at, min(at + size, end)
        return
    sep = SEPARATORS[level]
    step = len(sep)
    while True:
        while text.startswith(sep, start, end):
            start += step
        if end - start <= size:
            if start < end:
                yield start, end
            return
        cut = _last_fit(text, sep, start, min(end, start + size + step))
        if cut > start:
            yield start, cut
        else:
            cut = text.find(sep, start, end)
            if cut < 0:
                cut = end
            yield from _slices(text, start, cut, size, level + 1)
            if cut == end:
                return
        start = cut + step


def split_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Chunks of one text, each led by the tail of the slice before it."""
    if not text or text.isspace():
        return []
    chunks = []
    lead = ""
    for start, end in _slices(text, 0, len(text), size, 0):
        chunk = (lead + text[start:end]).strip()
        if len(chunk) > MIN_CHUNK_CHARS:
            chunks.append(chunk)
        if overlap > 0:
            lead = text[max(start, end - overlap):end] + " "
    return chunks


def chunk_array(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Column of chunk arrays. Only the text crosses to Python, in Arrow batches."""
    if size < 1 or overlap < 0:
        raise ValueError("size must be positive and overlap not negative")

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def chunks(batch: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        parts = [
            pa.array([split_text(text, size, overlap) for text in part.to_pylist()], type=kind)
            for part in text_slices(batch)
        ]
        hand_back()
        return pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    return chunks(text)
