"""Hashed character n-grams of code-point slices, vectorised."""

from __future__ import annotations

import numpy as np

PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Tables:
    """Tables over all code points, built once where they are used."""

    def __init__(self) -> None:
        self.letter = self.low = None

    def __reduce__(self):
        return _Tables, ()

    def letters(self) -> np.ndarray:
        """Whether each code point is a letter (Unicode L*)."""
        if self.letter is None:
            self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        return self.letter

    def lower(self) -> np.ndarray:
        """Simple lower case of every code point (kept where it is several)."""
        if self.low is None:
            self.low = np.arange(0x110000, dtype=np.uint32)
            for i in range(0x1E944):
                low = "" if 0xD800 <= i < 0xE000 else chr(i).lower()
                if len(low) == 1:
                    self.low[i] = ord(low)
        return self.low


TABLES = _Tables()


def hashed(cp: np.ndarray, at: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram of a slice that stays inside its row, counts of
    n-grams per row). Buckets come in row order."""
    size = np.diff(at)
    per_row = np.maximum(size - n + 1, 0)
    if len(cp) < n:
        return np.zeros(0, np.int64), per_row
    h = np.full(len(cp) - n + 1, n, np.uint64)
    for j in range(n):
        h = (h + cp[j:j + len(h)]) * PRIME
        h ^= h >> np.uint64(29)
    inside = np.ones(len(h), bool)
    for j in range(1, n):                       # starts whose n-gram would leave the row
        edge = at[1:] - j
        edge = edge[(edge >= 0) & (edge < len(h))]
        inside[edge] = False
    h = h[inside]
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), per_row


def row_sums(values: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows of ``values`` (one run per text)."""
    out = np.zeros((len(per_row),) + values.shape[1:], np.float64)
    live = np.flatnonzero(per_row)
    if len(live):
        starts = (np.cumsum(per_row) - per_row)[live]
        out[live] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
