"""Arrow batches in small parts, so that a Python worker holds little beyond the batch itself."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@functools.cache
def lean() -> None:
    """Has this process give large blocks back to the system when they are freed, where its C library is glibc.

    Left alone, glibc keeps blocks as large as any that it has freed, up to 32 MB: room for several batches
    of texts in every idle worker.
    """
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD: from this size on a block is mapped, thus returned, by itself
        libc.mallopt(-1, 8 << 20)  # M_TRIM_THRESHOLD: free bytes at the heap's end that are kept
    except (OSError, AttributeError):
        pass


def cuts(a: pa.Array, most: int = 1 << 20, rows: int = 1024) -> Iterator[tuple[int, int]]:
    """``(from, to)`` of runs of at most ``rows`` texts that hold ``most`` bytes together; a longer text is one by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(a):
        room = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right"))
        j = min(i + rows, max(i + 1, room))
        yield i, j
        i = j


def in_parts(make: Callable[..., pa.Array], kind: pa.DataType, a: pa.Array, *more: pa.Array, most: int = 1 << 20) -> pa.Array:
    """``make`` of lists of Python objects, part by part of texts ``a`` (and ``more`` beside them), as one array of ``kind``."""
    lean()
    out = [make(*(x.slice(i, j - i).to_pylist() for x in (a, *more))) for i, j in cuts(a, most)]
    made = pa.concat_arrays(out) if out else pa.array([], kind)
    del out
    pa.default_memory_pool().release_unused()
    return made
