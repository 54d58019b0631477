"""Byte-level views of text columns inside tasks: numpy arrays over Arrow buffers."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa

# White space outside ASCII, by its UTF-8 bytes, that pre-tokenizers may join to a run.
WIDE_SPACES = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80")


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column, end to end, and each row's bounds (n + 1). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.cast(pa.large_binary()).fill_null(b"")
    n = len(flat)
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + n + 1]
    if n == 0 or flat.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(flat.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def row_groups(sizes: np.ndarray, most: int):
    """Bounds of runs of rows with about ``most`` bytes together; a longer row is a run of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def trimmed(task):
    """The task, giving back memory that its worker holds without use, before and after.

    A worker serves many tasks; what freed arrays leave in its heap would add up with what the next task needs.
    """

    def run(batches):
        trim()
        yield from task(batches)
        trim()

    return run


def trim() -> None:
    """Give unused memory back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def by_bytes(batches, most: int, name: str = "text"):
    """The rows of Arrow batches in batches of about ``most`` bytes of text."""
    for batch in batches:
        _, bounds = text_bytes(batch.column(name))
        for low, high in row_groups(np.diff(bounds), most):
            yield batch.slice(low, high - low)


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are one of ``\\x20 \\x09-\\x0D``."""
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes other than white space."""
    solid = ~is_space(data)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of adjoining or separate spans as one Arrow binary array."""
    size = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    if len(start) and (offsets[-1] != end[-1] - start[0] or (start[1:] != end[:-1]).any()):
        # A few megabytes at a time: the positions of single bytes take eight times their room.
        joined = np.empty(offsets[-1], np.uint8)
        cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], 4_000_000), "right") - 1, len(start)))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            joined[offsets[low] : offsets[high]] = data[spread(start[low:high], size[low:high])]
    else:
        joined = data[start[0] : end[-1]] if len(start) else data[:0]
    joined = np.ascontiguousarray(joined)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each of the sizes, end to end."""
    total = int(size.sum())
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return np.arange(total, dtype=np.int64) + shift
