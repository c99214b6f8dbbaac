"""Numpy kernels over the bytes of an Arrow text column.

They work on slices of a batch (a few megabytes of text), so a task's memory
does not follow its batch size; a single text longer than a slice is a slice of
its own.  Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_U = np.uint64
# Fixed values of the polynomial hash: an odd multiplier and one odd number per byte.
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            m = max(n, 1 << 20)
            for name, base in (("up", _MULT), ("down", _INV)):
                steps = np.full(m, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def text_slices(col, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows of a text column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def byte_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20):
    """``batch`` in slices of at most ``max_bytes`` of a text or binary column; a
    single longer value is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size, dtype=np.int64)
    i = 0
    while i < len(batch):
        before = int(end[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(end, before + max_bytes, side="right")))
        yield batch.slice(i, j - i)
        i = j


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``data[start:end]``; equal bytes, equal hash."""
    return value_hashes(_BYTE[data], starts, ends)


def value_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of 64-bit values."""
    up, down = _POWERS.upto(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * up[:len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class Memo:
    """Ids of the keys seen so far; forgets all of them beyond ``most`` keys."""

    def __init__(self, most: int = 1_000_000):
        self.most = most
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def missing(self, uniq: np.ndarray) -> np.ndarray:
        """Positions in the sorted keys ``uniq`` that are not known yet."""
        if len(self.keys) and len(self.keys) + len(uniq) > self.most:
            self.clear()
        if not len(self.keys):
            return np.arange(len(uniq))
        at = np.minimum(np.searchsorted(self.keys, uniq), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != uniq)

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """New sorted keys with their ids, one key's after another's."""
        base = len(self.first) - 1
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.keys, keys)
        self.slot = np.insert(self.slot, at, base + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)

    def gather(self, uniq: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the keys ``uniq[inverse]`` in that order, and how many each has."""
        slot = self.slot[np.searchsorted(self.keys, uniq)][inverse]
        first = self.first[slot]
        lengths = self.first[slot + 1] - first
        return self.ids[ragged(first, lengths)], lengths


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Words of each row, runs of bytes outside ``space`` (``[^\\x20\\x09-\\x0D]+``):
    ``starts, ends, row``."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    space = space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:n]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def row_counts(row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, minlength=rows).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + length - 1`` of every span, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
