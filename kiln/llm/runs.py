"""Periodic runs of words: every maximal stretch whose words repeat with some
smallest period q and whose length is at least 2 q (and a stated minimum).

Short periods (under ``SCAN``) are found by comparing the words with
themselves at every lag. Longer ones are found scale by scale, periods in
[P, 2P) at a time, by minimizers: grams of k = P/2 words are hashed, every
window of P/2 + 1 consecutive gram starts keeps its smallest hash (leftmost
on ties), and pairs of kept equal grams at a distance in [P, 2P) are seeds,
each extended to the maximal stretch with that lag by hashed prefixes.

Why no run is missed. Let a run of period q in [P, 2P) start at word 0. A
window within its first q words and the same window q words later hold the
same grams, so both keep the same relative place: a seed of distance q. Only
grams that are themselves periodic (period at most k/4) could repeat so often
that pairs would grow with the square; they lie inside shorter runs, found at
smaller scales, and are kept only where nothing else is in the window, and
give no seeds. Other grams occur at most 8 times in [P, 2P). What is left are
runs whose whole first period lies inside a shorter run of period r: then the
second lies inside another run of period r that touches it, and q follows
from the phases of the two, so those seeds are computed from touching pairs
of equal period. Every accepted stretch is compared word by word; a stretch
that hash collisions made too long is searched again by direct comparison.

The rows of a slice are searched together: words of different texts are kept
apart by marks that equal nothing, so no run crosses them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.textops import mix64, slices, span_hashes, utf8_buffer, word_spans

SCAN = 16               # periods below are found by lag scans
LEAST = 12              # least length of a run that counts
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)
_PERIODIC = np.uint64(1 << 63)


def stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive integers in sorted ``at``: (starts, ends)."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + 1


class _Prefix:
    """Hashes of all stretches of a sequence from prefix sums."""

    def __init__(self, w: np.ndarray) -> None:
        n = len(w)
        up = np.full(n + 1, _BASE, np.uint64)
        down = np.full(n + 1, _BASE_INV, np.uint64)
        up[0] = down[0] = 1
        up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w * up[:n], out=self.sums[1:])
        self.n = n

    def grams(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.down[:self.n - k + 1]

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[a + size] - self.sums[a]) * self.down[a] == (self.sums[b + size] - self.sums[b]) * self.down[b]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the stretches from a and from b (a < b) agree."""
        low, high = np.zeros(len(a), np.int64), self.n - b
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(a, b, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the stretches that end before a and before b agree."""
        low, high = np.zeros(len(a), np.int64), a.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(a - mid, b - mid, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Places of the smallest key (leftmost on ties) of every window of
    ``w`` consecutive keys, each once."""
    n = len(keys)
    if n < w:
        return np.zeros(0, np.int64)
    bits = max(1, (n - 1).bit_length())
    low = np.uint64((1 << bits) - 1)
    ranked = (keys & ~low) | np.arange(n, dtype=np.uint64)
    pad = -n % w
    blocks = np.concatenate([ranked, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - w + 1], ahead[w - 1:n])
    place = (least & low).astype(np.int64)          # never falls from window to window
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


class _Found:
    """Runs by interval, each with its smallest period."""

    def __init__(self, w: np.ndarray, least: int) -> None:
        self.w, self.least, self.period = w, least, {}

    def add(self, start: int, end: int, lag: int) -> None:
        if lag < self.period.get((start, end), lag + 1):
            self.period[start, end] = lag

    def scan(self, lag: int, low: int = 0, high: int | None = None) -> None:
        """All stretches of ``lag`` within [low, high), word by word."""
        high = len(self.w) if high is None else high
        part = self.w[low:high]
        at = np.flatnonzero(part[lag:] == part[:-lag])
        if len(at) < lag:
            return
        s, t = stretches(at)
        keep = (t - s >= lag) & (t - s + lag >= self.least)
        for a, b in zip((s[keep] + low).tolist(), (t[keep] + low).tolist()):
            self.add(a, b + lag, lag)

    def extend(self, prefix: _Prefix, at: np.ndarray, lag: np.ndarray) -> None:
        """The maximal stretches through seeds (place, lag)."""
        t = at + prefix.forward(at, at + lag)
        s = at - prefix.backward(at, at + lag)
        keep = t - s >= lag
        if not keep.any():
            return
        for a, b, q in np.unique(np.stack([s[keep], t[keep], lag[keep]], 1), axis=0).tolist():
            if self.period.get((a, b + q), q + 1) <= q:
                continue
            w = self.w
            whole = np.array_equal(w[a:b], w[a + q:b + q]) and (a == 0 or w[a - 1] != w[a + q - 1]) \
                and (b + q == len(w) or w[b] != w[b + q])
            self.add(a, b + q, q) if whole else self.scan(q)

    def runs(self, least: int = 2) -> np.ndarray:
        """(start, end, period) rows by start, then period."""
        out = np.array([(a, b, q) for (a, b), q in self.period.items()], np.int64).reshape(-1, 3)
        out = out[out[:, 1] - out[:, 0] >= least]
        return out[np.lexsort((out[:, 1], out[:, 2], out[:, 0]))]


def _touching(runs: np.ndarray, prefix: _Prefix, w: np.ndarray, k: int, low: int, high: int) -> list[tuple[int, int]]:
    """Seeds (place, lag) with lags in [low, high) from pairs of touching
    runs that share a period of at most k/4 and hold whole grams."""
    out = []
    known = runs[(runs[:, 2] * 4 <= k) & (runs[:, 1] - runs[:, 0] >= low)]
    known = known[np.lexsort((known[:, 0], known[:, 2]))]
    near = np.flatnonzero((known[1:, 2] == known[:-1, 2]) & (known[1:, 0] <= known[:-1, 1]))
    for i in near.tolist():
        (b1, e1, r), (b2, e2, _) = known[i].tolist(), known[i + 1].tolist()
        root = w[b2:b2 + r]
        shift = next((x for x in range(r) if np.array_equal(w[b1 + x:b1 + x + r], root)), None)
        if shift is None:
            continue
        most = min(e1 - b1, e2 - b2, (e2 - b1) // 2, high - 1)
        first = low + (b2 - b1 - shift - low) % r
        for q in range(first, most + 1, r):
            out.append((max(b1, b2 - q), q))
    return out


def find_runs(w: np.ndarray, longest: int | None = None, least: int = 2) -> np.ndarray:
    """All runs of ``w`` (64-bit word ids) with length >= 2 * period and
    length >= ``least``, as (start, end, period) rows; ``longest`` bounds the
    length of any run."""
    longest = len(w) if longest is None else min(longest, len(w))
    found = _Found(w, min(least, SCAN // 2))      # the scales need runs of SCAN / 2 words
    for lag in range(1, min(SCAN, longest // 2 + 1)):
        found.scan(lag)
    if longest < 2 * SCAN:
        return found.runs(least)
    prefix = _Prefix(mix64(w))
    scale = SCAN
    while 2 * scale <= longest:
        k = scale // 2
        runs = found.runs()
        inner = runs[(runs[:, 2] * 4 <= k) & (runs[:, 1] - runs[:, 0] >= k)]
        grams = prefix.grams(k)
        steps = np.zeros(len(w) + 1, np.int64)
        np.add.at(steps, inner[:, 0], 1)
        np.add.at(steps, inner[:, 1] - k + 1, -1)
        periodic = np.cumsum(steps)[:len(grams)] > 0
        keys = mix64(grams) >> np.uint64(1)
        keys[periodic] |= _PERIODIC
        kept = window_minima(keys, scale - k + 1)
        kept = kept[~periodic[kept]]
        order = np.lexsort((kept, grams[kept]))
        at, key = kept[order], grams[kept][order]
        seeds = [np.array(_touching(runs, prefix, w, k, scale, 2 * scale), np.int64).reshape(-1, 2)]
        live, step = np.arange(len(at)), 1
        while len(live):
            live = live[live + step < len(at)]
            gap = at[live + step] - at[live]
            live_ok = (key[live + step] == key[live]) & (gap < 2 * scale)
            live, gap = live[live_ok], gap[live_ok]
            hit = gap >= scale
            seeds.append(np.stack([at[live[hit]], gap[hit]], 1))
            step += 1
        seed = np.concatenate(seeds)
        if len(seed):
            found.extend(prefix, seed[:, 0], seed[:, 1])
        scale *= 2
    return found.runs(least)


def edit_order(n: int, h: int | None) -> np.ndarray | None:
    """The planted repetition: word i >= a becomes word a + (i - a) % p for
    h % 10 = 0 (h: the id's crc32; None for a null id)."""
    if h is None or n == 0 or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    i[a:] = a + (i[a:] - a) % p
    return i


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the spans, each followed by one space, and where each begins
    (one more entry: the end)."""
    size = ends - starts + 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    out = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    out[offsets[1:] - 1] = 0x20
    return out, offsets


FIELDS = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _slice_rows(data: np.ndarray, offsets: np.ndarray, crcs: list[int | None]) -> list[tuple]:
    """The result columns of every row of a slice."""
    n_rows = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    order = np.arange(len(start))
    for i in [i for i, h in enumerate(crcs) if h is not None and h % 10 == 0 and count[i]]:
        moved = edit_order(int(count[i]), crcs[i])
        order[first[i]:first[i] + count[i]] = first[i] + moved
    start, end = start[order], end[order]

    ids = span_hashes(data, start, end) >> np.uint64(1)
    w = np.empty(len(ids) + n_rows, np.uint64)           # a mark that equals nothing after every row
    place = np.arange(len(ids)) + row
    w[place] = ids
    w[first + count + np.arange(n_rows)] = np.uint64(1 << 63) | np.arange(n_rows, dtype=np.uint64)
    runs = find_runs(w, int(count.max(initial=0)), LEAST)

    owner = np.searchsorted(first + np.arange(n_rows), runs[:, 0], side="right") - 1
    drop = np.zeros(len(w) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    stays = np.cumsum(drop)[place] == 0
    text, at = _gather(data, start[stays], end[stays])
    kept_end = np.cumsum(np.bincount(row[stays], minlength=n_rows))
    raw = text.tobytes()
    run_from = np.searchsorted(owner, np.arange(n_rows + 1))
    out, begin = [], 0
    for i in range(n_rows):
        stop = int(kept_end[i])
        collapsed = hashlib.sha256(raw[at[begin]:max(at[begin], at[stop] - 1)]).hexdigest()
        begin = stop
        mine = runs[run_from[i]:run_from[i + 1]] - [first[i] + i, first[i] + i, 0]
        s, size, q = mine[:, 0], mine[:, 1] - mine[:, 0], mine[:, 2]
        listed = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), size.tolist(), q.tolist())).encode()).hexdigest()
        if len(mine):
            top = np.lexsort((q, s, -size))[0]
            best = (int(s[top]), int(size[top]), int(q[top]), int(1000 * size[top] // q[top]))
        else:
            best = (None,) * 4
        out.append((len(mine), *best, listed, collapsed))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the number of runs, the longest run (ties: first
    start, then smallest period; nulls without a run), digests of all runs
    and of the text without the repeated words. Before the search, texts whose
    id's crc32 is divisible by 10 get a repetition planted (``edit_order``).

    Null texts and texts without words have no runs and the empty text's
    digests; a null id plants nothing; rows are independent of one another, so
    repeated rows repeat their result and an empty table gives an empty one.
    Other columns are ignored. Words are equal when their 64-bit hashes are."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            crcs = batch.column("h").to_pylist()
            for i, j, part, at in slices(data, offsets):
                out = _slice_rows(part, at, crcs[i:j])
                cols = list(zip(*out))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                    ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")]])

    return rows.mapInArrow(step, f"doc_id {dict(rows.dtypes)['doc_id']}, {FIELDS}")
