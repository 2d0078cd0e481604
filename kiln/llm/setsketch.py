"""Near-duplicate detection with SetSketch registers.

Every document is the set of its distinct 5-word shingles. A SetSketch keeps,
per register, the exponentially spaced level of the smallest exponential hash
value over the set: registers are truncated logarithms of minima, so two
sketches merge by an element-wise maximum and equal registers become likelier
with similarity. Registers are packed four to a band value; documents that
share a band value are candidates, a joint maximum-likelihood estimate from
the register comparison (with the known set sizes) drops the hopeless ones,
and an exact comparison of the full shingle sets confirms the rest.

Work stays linear in the size of a group of copies:

* documents with the same set are one class, represented by its smallest id;
* each band bucket first meets only its hub (its smallest id); confirmed links
  are merged into components;
* only buckets whose members still lie in several components are looked at
  again: blocks of members meet in tasks with their full sets, a prefix filter
  (rarest shingles first) finds the pairs across components that can reach the
  threshold, the sketches drop the hopeless ones, the full sets confirm, and
  one link for each two components leaves the task.

With ``BANDS`` bands of 4 registers a pair at similarity 0.75 shares no band
with probability about 5e-6; nothing is capped or sampled."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import connected_components
from kiln.llm.frames import bounded_broadcast, fresh_name, hash60
from kiln.llm.textops import (ASCII_LOWER, mix64, seeded, slices, span_hashes, utf8_buffer,
                              word_spans)
from kiln.session import materialize

SHINGLE_WORDS = 5
MIN_PERCENT = 75
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE, RATE = 1.005, 20.0           # spacing of the levels, rate of the exponential values
SLACK = 0.17                       # estimates below threshold - SLACK are dropped (> 4 sigma)
BLOCK = 1024                       # bucket members per block of the second look ...
BLOCK_SHINGLES = 1 << 20           # ... and shingles, about
FEW = 32                           # so few members are compared without a prefix filter
EXPAND = 1 << 20                   # candidate matches looked at together

_MULT = seeded(REGISTERS, 11) | np.uint64(1)
_ADD = seeded(REGISTERS, 12)
_MIX = seeded(SHINGLE_WORDS, 13) | np.uint64(1)


# -- shingle sets ------------------------------------------------------------

def shingle_sets(col: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row (empty without words)."""
    data, offsets = utf8_buffer(col)
    for _, _, raw, off in slices(data, offsets):
        low = ASCII_LOWER[raw]
        starts, ends, rows = word_spans(low, off)
        words = span_hashes(low, starts, ends)
        first = np.searchsorted(rows, np.arange(len(off)))
        full = np.zeros(max(0, len(words) - SHINGLE_WORDS + 1), np.uint64)
        for j in range(SHINGLE_WORDS):
            full += words[j:j + len(full)] * _MIX[j]
        full = mix64(full)
        for r in range(len(off) - 1):
            a, b = first[r], first[r + 1]
            if b - a >= SHINGLE_WORDS:
                s = np.sort(full[a:b - SHINGLE_WORDS + 1])
                keep = np.ones(len(s), bool)
                keep[1:] = s[1:] != s[:-1]
                yield s[keep]
            elif b > a:
                n = b - a
                yield mix64(np.array([(words[a:b] * _MIX[:n]).sum() + np.uint64(n)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def sketch(values: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes: K = floor(1 - log_BASE(min)),
    the minimum over the set of one Exp(RATE) value per element."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 2048):
        part = values[i:i + 2048]
        np.minimum(low, (_MULT[:, None] * part + _ADD[:, None]).min(axis=1), out=low)
    u = (low.astype(np.float64) + 1.0) / 2.0 ** 64
    e = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(e) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def _gap(x: np.ndarray) -> np.ndarray:
    """Probability that one register exceeds the other, given the share of
    the elements that only the first set has."""
    x = np.clip(x, 1e-12, 1.0)
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def joint_similarity(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                     grid: int = 101) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the number of registers in
    which a exceeds b (``more``), in which b exceeds a, and the set sizes."""
    n_a, n_b = np.maximum(n_a, 1).astype(float), np.maximum(n_b, 1).astype(float)
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    same = REGISTERS - more - less
    best, best_at = np.full(len(u), -np.inf), np.zeros(len(u))
    for t in np.linspace(0, 1, grid):
        j = top * t
        p, q = _gap(u - v * j), _gap(v - u * j)
        ll = more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))
        better = ll > best
        best[better], best_at[better] = ll[better], j[better]
    return best_at


def comes_near(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
               level: float = MIN_PERCENT / 100 - SLACK) -> np.ndarray:
    """Whether the joint maximum-likelihood similarity is ``level`` or more:
    the likelihood is concave, so the sign of its slope at ``level`` tells."""
    n_a, n_b = np.maximum(n_a, 1).astype(float), np.maximum(n_b, 1).astype(float)
    u = n_a / (n_a + n_b)
    v = 1 - u
    x, y = np.clip(u - v * level, 1e-9, 1), np.clip(v - u * level, 1e-9, 1)
    p, q = _gap(x), _gap(y)
    c = (BASE - 1) / BASE
    dp, dq = -v * c / (1 - x * c) / np.log(BASE), -u * c / (1 - y * c) / np.log(BASE)
    slope = more * dp / p + less * dq / q - (REGISTERS - more - less) * (dp + dq) / (1 - p - q)
    return (slope >= 0) & (level <= np.minimum(u / v, v / u))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, lo, hi, packed = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            n.append(len(s))
            d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            lo.append(int.from_bytes(d[:8], "little", signed=True))
            hi.append(int.from_bytes(d[8:], "little", signed=True))
            packed.append(sketch(s).view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(hi, pa.int64()), pa.array(packed, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_lo", "set_hi", "sketch"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, 128-bit digest of the shingle set (two longs) and
    the sketch as ``BANDS`` longs of four 16-bit registers (null when empty)."""
    return docs.select("doc_id", "text").mapInArrow(
        _sketch_batches, "doc_id long, n_shingles long, set_lo long, set_hi long, sketch array<long>")


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])


# -- candidates --------------------------------------------------------------

def _unpack(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return np.ascontiguousarray(flat).reshape(-1, BANDS).view(np.uint16)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _unpack(batch.column("sketch_a")), _unpack(batch.column("sketch_b"))
        more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
        near = comes_near(more, less, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose joint estimate
    comes near it."""
    def side(x: str) -> DataFrame:
        return reps.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                           F.col("sketch").alias(f"sketch_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b") \
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * MIN_PERCENT)
    return sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b") \
        .mapInArrow(_estimate, "a long, b long")


def _sets_of(ids: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(id, shingles) of the given documents, as a written table. The ids, not
    the texts, travel while their measured size allows a broadcast."""
    ids = bounded_broadcast(materialize(ids, f"{name}-ids"), row_bytes=16)
    return materialize(docs.join(ids, "doc_id", "left_semi")
                       .mapInArrow(_set_batches, "id long, shingles array<long>"), f"{name}-sets")


def _confirmed(plausible: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """Pairs of a written table whose full shingle sets reach the threshold,
    as a written table."""
    ids = plausible.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = _sets_of(ids, docs, name)
    both = F.size(F.array_intersect("set_a", "set_b"))
    links = plausible.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b") \
        .withColumn("both", both) \
        .where(F.col("both") * 100 >= (F.size("set_a") + F.size("set_b") - F.col("both")) * MIN_PERCENT)
    return materialize(links.select("a", "b"), f"{name}-links")


def prefix_pairs(values: np.ndarray, n: np.ndarray, comp: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (x, y) of different components, and of different blocks
    where there are two, that can reach the threshold; ``values`` holds the
    rows' sets one after another, ``n`` their sizes.

    Every set is ordered by how many sets hold a shingle, rarest first. Two
    sets that reach the threshold share a shingle among the first
    n - ceil(2t / (1 + t) n) + 1 of the smaller and the first n - ceil(t n) + 1
    of the larger one, and what follows their first common shingle must be
    long enough. Texts that only have a frequent template in common meet at
    no prefix, so no pairs are made of them."""
    row = np.repeat(np.arange(len(n)), n)
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    order = np.argsort(count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    rank = rank[code]
    rank = rank[np.lexsort((rank, row))]
    place = np.arange(len(rank)) - np.repeat(np.cumsum(n) - n, n)
    common = count[order][rank] > 1
    long_prefix = n + (-MIN_PERCENT * n) // 100 + 1
    short_prefix = n + (-2 * MIN_PERCENT * n) // (100 + MIN_PERCENT) + 1
    ys = np.flatnonzero(common & (place < long_prefix[row]))
    xs = np.flatnonzero(common & (place < short_prefix[row]))
    group = np.unique(comp, return_inverse=True)[1]
    groups = int(group.max(initial=0)) + 1
    key = rank[ys] * groups + group[row[ys]]
    by = np.argsort(key, kind="stable")
    ys, key = ys[by], key[by]
    # entries of the same shingle, before and after those of the own component
    edges = [np.searchsorted(key, k) for k in (rank[xs] * groups, rank[xs] * groups + group[row[xs]],
                                               rank[xs] * groups + group[row[xs]] + 1, (rank[xs] + 1) * groups)]
    two = len(np.unique(block)) > 1
    found = []
    for lo, hi in (edges[:2], edges[2:]):
        size = hi - lo
        total = np.cumsum(size)
        at = 0
        while at < len(xs):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + EXPAND, side="right")))
            part = size[at:end]
            i = np.repeat(xs[at:end], part)
            j = ys[np.repeat(lo[at:end] - (np.cumsum(part) - part), part) + np.arange(int(part.sum()))]
            x, y = row[i], row[j]
            rest = np.minimum(n[x] - place[i], n[y] - place[j])      # with the match itself
            use = ((n[x] < n[y]) | ((n[x] == n[y]) & (x < y))) & (n[x] * 100 >= n[y] * MIN_PERCENT) \
                & (rest * (100 + MIN_PERCENT) >= (n[x] + n[y]) * MIN_PERCENT)
            if two:
                use &= block[x] != block[y]
            found.append(np.unique(x[use] * len(n) + y[use]))
            at = end
    pair = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pair // len(n), pair % len(n)


def all_pairs(n: np.ndarray, comp: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``prefix_pairs``, by sizes alone: for few rows."""
    x, y = np.triu_indices(len(n), 1)
    use = (comp[x] != comp[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * MIN_PERCENT)
    if len(np.unique(block)) > 1:
        use &= block[x] != block[y]
    return x[use], y[use]


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = np.count_nonzero(b[at] == a)
    return both * 100 >= (len(a) + len(b) - both) * MIN_PERCENT


def _links_between(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
    """Confirmed links of one meeting of at most two blocks of a bucket: as
    many as connect what the meeting's pairs connect."""
    t = pa.Table.from_batches(rows).combine_chunks()
    ids, comp, n, block = (t[c].to_numpy() for c in ("rep", "component", "n_shingles", "block"))
    sets = pa.concat_arrays(t["shingles"].chunks)
    values = sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    x, y = all_pairs(n, comp, block) if len(n) <= FEW else prefix_pairs(values, n, comp, block)
    if not len(x):
        return None
    sk = _unpack(pa.concat_arrays(t["sketch"].chunks))
    bands, band = sk.view(np.int64), t["band"][0].as_py()
    kept = []
    for at in range(0, len(x), 1 << 14):
        i, j = x[at:at + (1 << 14)], y[at:at + (1 << 14)]
        a, b = sk[i], sk[j]
        near = (bands[i] == bands[j]).argmax(axis=1) == band          # their first common band
        near &= comes_near((a > b).sum(axis=1), (a < b).sum(axis=1), n[i], n[j])
        kept.append(np.stack([i[near], j[near]]))
    start = np.cumsum(n) - n
    top: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := top.get(c, c)) != c:
            top[c] = top.get(up, up)
            c = up
        return c

    out = []
    for i, j in np.concatenate(kept, axis=1).T.tolist():
        ci, cj = root(int(comp[i])), root(int(comp[j]))
        if ci != cj and _similar(values[start[i]:start[i] + n[i]], values[start[j]:start[j] + n[j]]):
            top[max(ci, cj)] = min(ci, cj)
            out.append(sorted((int(ids[i]), int(ids[j]))))
    if not out:
        return None
    a, b = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every meeting; rows arrive sorted by (bucket, i, j)."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        for start, end in zip(edges[:-1], edges[1:]):
            if end > start and held and tuple(keys[start]) != key:
                if (out := _links_between(held)) is not None:
                    yield out
                held = []
            if end > start:
                key = tuple(keys[start])
                held.append(batch.slice(start, end - start))
    if held and (out := _links_between(held)) is not None:
        yield out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``
    (doc_id, text; other columns are ignored).

    Null or empty texts have no shingles and link with nothing
    (component_id = doc_id). A row with a null doc_id links with nothing
    (component_id null, kept true). Rows that repeat a doc_id are separate
    texts under one id: each takes the component of its own text. An empty
    table gives no rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = materialize(sketches(docs), "sketch")
    live = base.where("sketch is not null and doc_id is not null")

    same_set = ["set_lo", "set_hi", "n_shingles"]
    classes = materialize(live.groupBy(*same_set).agg(F.min("doc_id").alias("rep")), "classes")
    reps = materialize(
        live.join(classes.withColumnRenamed("rep", "doc_id"), [*same_set, "doc_id"], "left_semi")
        .dropDuplicates([*same_set, "doc_id"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "sketch"), "reps")

    # the buckets that hold two or more classes, with their hub
    banded = reps.select("rep", F.posexplode("sketch").alias("band", "value")) \
        .select("rep", "band", F.xxhash64("band", "value").alias("bucket"))
    shared = materialize(banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("far"),
                                                      F.count(F.lit(1)).alias("size"))
                         .where("hub <> far").drop("far"), "buckets")
    members = materialize(banded.join(shared, "bucket"), "members")

    star = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    tested = materialize(_plausible(star, reps), "hub-pairs")
    links = _confirmed(tested, docs, "hub")
    found = connected_components(links)

    # second look: buckets whose members lie in several components
    placed = members.where("size > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("bucket", "band", "rep", "hub", "size", F.coalesce("component", "rep").alias("component"))
    spread = placed.where("rep <> hub").groupBy("bucket") \
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    opened = materialize(placed.join(spread.select("bucket"), "bucket", "left_semi"), "opened")
    sets = _sets_of(opened.select(F.col("rep").alias("doc_id")).distinct(), docs, "opened").withColumnRenamed("id", "rep")
    extra = materialize(_links_across(opened, reps, sets), "open-links")

    comp = materialize(connected_components(links.unionByName(extra)), "components")
    return base.join(classes, same_set, "left") \
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _links_across(opened: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between components inside open buckets. A bucket is cut
    into blocks of about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles; one
    of a single block is one meeting, a larger one has a meeting for every two
    blocks."""
    opened = opened.join(reps, "rep")
    cut = F.greatest(F.col("size") / BLOCK, F.col("shingles_in") / BLOCK_SHINGLES)
    blocks = opened.groupBy("bucket").agg(F.sum("n_shingles").alias("shingles_in"), F.first("size").alias("size")) \
        .select("bucket", F.ceil(cut).cast("int").alias("blocks"))
    meet = opened.join(blocks, "bucket") \
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "band", "block", "rep", "component", "n_shingles", "sketch")
    return meet.join(sets, "rep").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "rep") \
        .mapInArrow(_meetings, "a long, b long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, less near copies: one row of each
    group stays, the one with the smallest doc_id; ids that hold several texts
    come after the others, rows without an id last.

    Rows are told apart by id and text: rows under one doc_id with unlike
    texts are separate documents, and so are rows without a doc_id. Of rows that
    repeat both, the first in the order of their other columns stays. Rows
    without words and without a doc_id all stay."""
    key = fresh_name(docs, "_key")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    ids = materialize(docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(text).alias("lo"), F.max(text).alias("hi")).where("n > 1"), "repeated-ids")
    mixed = ids.where("lo <> hi").select("doc_id", F.lit(True).alias("_mixed"))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    mark = hash60("row", F.col("doc_id"), F.col("text"))                            # after every id of one text
    stand_in = F.when(F.col("doc_id").isNotNull(), F.lit(1 << 62) + mark).when(worded, F.lit(3 << 61) + mark)
    rows = docs.join(mixed.withColumnsRenamed({"_mixed": f"{key}m"}), "doc_id", "left") \
        .withColumn(key, F.when(F.col("doc_id").isNull() | F.col(f"{key}m"), stand_in).otherwise(F.col("doc_id").cast("long"))) \
        .drop(f"{key}m")
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text")).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias(key)), "near-copies")
    out = rows.join(gone, key, "left_anti")
    again = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col(key).isNotNull() & (F.col("n") > 1)).select(key), "repeated-rows")
    if again.isEmpty():
        return out.select(*docs.columns)
    first = out.join(again, key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    return out.join(again, key, "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))
