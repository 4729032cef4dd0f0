"""Keep Python workers small: texts by slices, and freed memory handed back."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def text_slices(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """A text column in slices of about ``most_bytes``; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield column.slice(at, stop - at)
        at = stop


def hand_back() -> None:
    """Give the memory that the allocators hold back to the system.

    A worker lives through many batches and tasks, beside one for every other Python step of
    its task, and each would keep the most it ever used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
