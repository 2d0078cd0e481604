"""Vectorised text helpers used inside Arrow-batched tasks.

They work on the raw UTF-8 buffer of an Arrow string column (null counts as
empty), in slices of half a MB, so numpy temporaries stay small whatever the
batch holds. A single text longer than a slice is a slice of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 512 << 10
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

# [\x20\x09-\x0D] separate words
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    step = np.uint64(_BASE)
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * step)


def utf8_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or
                           pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray,
           limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: (first row, end row,
    bytes, offsets within the slice)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


class _Powers:
    """Powers of the rolling-hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()      # rebuilt where it is used, never shipped

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            up = np.full(size, _BASE, np.uint64)
            down = np.full(size, _BASE_INV, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for every span."""
    up, down = _POWERS.get(len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:len(values)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word: maximal runs of non-separator bytes
    that do not cross rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    first[edge] = inside[edge]
    edge = offsets[1:][offsets[1:] > 0] - 1
    last[edge] = inside[edge]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def codepoints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row offsets in code points) of a UTF-8 slice."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = lead[offsets]
    if len(cp) != at[-1]:      # not valid UTF-8: decode row by row
        rows = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                for a, b in zip(offsets[:-1], offsets[1:])]
        at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        cp = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    return cp, at


def per_row_sum(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)
