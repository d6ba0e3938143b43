"""Text columns as flat byte arrays: what the array operators share."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Odd multipliers of the hashes below.
BASE, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def row_chunks(off: np.ndarray, limit: int):
    """Row ranges of at most `limit` bytes each; a longer row stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h *= U(MIX_A)
    h ^= h >> U(29)
    h *= U(MIX_B)
    h ^= h >> U(32)
    return h


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE, U), np.full(n, inverse, U)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def words(data: np.ndarray, off: np.ndarray, member: np.ndarray):
    """(start, end, row) of the maximal runs of bytes in the class `member`; runs never cross rows."""
    inside = member[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], whatever its place."""
    size = 1 << max(16, int(len(data) + 1).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(MIX_A))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for count[0] values, then the next."""
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(int(count.sum()))


def min_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index in the component of each of n nodes, by min-label hooking and pointer jumping."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        before = label.copy()
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            break
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


#: Bytes of a batch that an operator handles at a time, whatever size Spark's batches have.
PIECE_BYTES = 2 << 20


def give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks and would keep their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_pieces(run):
    """A mapInArrow function that sees batches of some PIECE_BYTES and gives its memory back when it ends."""

    def wrapped(batches):
        def pieces():
            for batch in batches:
                step = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
                for i in range(0, batch.num_rows, step):
                    yield batch.slice(i, step)

        yield from run(pieces())
        give_back()

    return wrapped


def once(run):
    """A function of a group's table that gives its memory back when it ends."""

    def wrapped(table):
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def once_of_two(run):
    """The same for the tables of a cogroup."""

    def wrapped(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    return wrapped
