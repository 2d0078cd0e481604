"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer when the smallest of its inner
s-mers (by hash) is its first or its last one. Whether a k-mer is chosen
depends on nothing but the k-mer, so a passage keeps its anchors wherever it
stands and at least one is found in every k - s + 1 consecutive positions.
``anchors`` gives them with their positions.

A text's fingerprint holds all its anchors with their positions: one 32-bit
word an anchor, 29 bits of its hash and 3 bits of the step from the one before
(the window guarantee keeps steps at k - s + 1 or less). The text is read with
k - 1 boundary signs before it, whose s-mers count as smallest, so its first
k - s prefixes are always anchors and texts of any length follow one rule. The
likeness of two texts comes from their fingerprints alone: the part of all
their anchors that they share in the same order."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import bounded_sample, hash60
from kiln.llm.textops import codepoints, mix64, span_hashes, utf8_buffer

S = 6
K = 2 * S
STEP_BITS = 3                      # k - s + 1 = 7 fits
BOUNDARY = np.full(K - 1, 0x110000, np.uint32)     # no code point
PART_BYTES = 32 << 20              # text per range of doc_id when neighbours are paired
MAX_PARTS = 100_000                # ranges at most (their first ids meet on the driver)
CUT_SAMPLE = 200_000               # ids from which the range limits are estimated


def syncmers(cp: np.ndarray, lowest: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a text of code points,
    whose first ``lowest`` s-mers count as smallest; a text shorter than k is
    its own single anchor, an empty one has none."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < K:
        return np.zeros(1, np.int64), span_hashes(cp, np.array([0]), np.array([n]))
    at = np.arange(n - S + 1)
    inner = span_hashes(cp, at, at + S)
    inner[:lowest] = 0
    w = K - S + 1
    low = inner[1:n - K + 2].copy()            # smallest of the inner s-mers 1 .. w - 2
    for j in range(2, w - 1):
        np.minimum(low, inner[j:j + n - K + 1], out=low)
    first, last = inner[:n - K + 1], inner[w - 1:w - 1 + n - K + 1]
    pos = np.flatnonzero(np.minimum(first, last) <= low)
    # the k-mer from its two halves' s-mer hashes
    return pos, mix64(inner[pos] * np.uint64(0x9E3779B97F4A7C15) + inner[pos + S])


def text_anchors(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the last character, hash) of the anchors of a text, read with
    boundary signs before it; none for an empty text."""
    return syncmers(np.concatenate([BOUNDARY, cp]) if len(cp) else cp, lowest=K - S)


def text_fingerprint(cp: np.ndarray) -> np.ndarray:
    """The words of a text's fingerprint (none for an empty text)."""
    pos, h = text_anchors(cp)
    steps = np.diff(pos, prepend=pos[:1])
    return ((h >> np.uint64(32 + STEP_BITS)).astype(np.uint32) << STEP_BITS) | steps.astype(np.uint32)


def pack(words: np.ndarray) -> str:
    return base64.b64encode(words.astype("<u4").tobytes()).decode("ascii")


def unpack(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").astype(np.uint32)


def positions(words: np.ndarray) -> np.ndarray:
    """Where each anchor of a fingerprint ends in its text (index of its last
    character)."""
    return np.cumsum(words & np.uint32((1 << STEP_BITS) - 1), dtype=np.int64)


def _rising(seq: np.ndarray) -> int:
    """Length of the longest rising subsequence."""
    if np.all(seq[1:] > seq[:-1]):
        return len(seq)
    ends: list[int] = []
    for x in seq.tolist():
        i = bisect_left(ends, x)
        ends[i:i + 1] = [x]
    return len(ends)


def _same_start(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def _chain(a: np.ndarray, b: np.ndarray) -> int:
    """Number of anchors that two sequences share in the same order. An anchor
    that repeats is matched by its count from the start or from the end,
    whichever gives the longer chain, so work stays near linear."""
    oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    ua, fa, ca = np.unique(a[oa], return_index=True, return_counts=True)
    ub, fb, cb = np.unique(b[ob], return_index=True, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    n = np.minimum(ca[ia], cb[ib])
    total, best = int(n.sum()), 0
    nth = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    for back in (0, 1):
        if best < total:
            at_a = oa[np.repeat(fa[ia] + back * (ca[ia] - n), n) + nth]
            at_b = ob[np.repeat(fb[ib] + back * (cb[ib] - n), n) + nth]
            best = max(best, _rising(at_b[np.argsort(at_a)]))
    return best


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two texts from their fingerprints' words: the anchors
    that both have in the same order, twice, per anchor of either (Dice); two
    empty texts are alike. A common start and end are matched as they stand,
    what lies between by ``_chain``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b = a >> STEP_BITS, b >> STEP_BITS
    total = len(a) + len(b)
    start = _same_start(a, b)
    a, b = a[start:], b[start:]
    end = _same_start(a[::-1], b[::-1])
    a, b = a[:len(a) - end], b[:len(b) - end]
    return 2 * (start + end + (_chain(a, b) if len(a) and len(b) else 0)) / total


class Text:
    """Code points and their fingerprint."""

    def __init__(self, cp: np.ndarray) -> None:
        self.cp = cp
        self.words = text_fingerprint(cp)


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, anchor): the anchors of every text with the index of
    their last character, for positional matching. Null and empty texts have
    none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8_buffer(batch.column("text"))
            for i in range(len(off) - 1):
                cp, _ = codepoints(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                pos, h = text_anchors(cp)
                if len(pos):
                    ids = pa.array([batch.column("doc_id")[i].as_py()] * len(pos), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, pa.array(pos), pa.array(h.view(np.int64))],
                                                     names=["doc_id", "pos", "anchor"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, pos long, anchor long")


_COLS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _pair(this: tuple, after: tuple) -> tuple:
    doc_id, text = this
    _, following = after
    cp = text.cp
    half = len(cp) // 2
    edited = Text(np.concatenate([cp[:len(cp) - half], following.cp[:half]]))
    sha = hashlib.sha256(edited.cp.tobytes().decode("utf-32-le").encode("utf-8")).hexdigest()
    return (doc_id, len(cp), sha, pack(text.words), pack(edited.words),
            likeness(text.words, edited.words), likeness(text.words, following.words))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, kind, doc_id, text); kind 1 is the first row
    of the following part and only serves as the next text."""
    before, before_part = None, None
    for batch in batches:
        rows: list[tuple] = []
        data, off = utf8_buffer(batch.column("text"))
        parts, kinds = batch.column("part").to_pylist(), batch.column("kind").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        for i in range(len(ids)):
            cp, _ = codepoints(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))
            here = (ids[i], Text(cp))
            if before is not None and before_part == parts[i]:
                rows.append(_pair(before, here))
            before, before_part = (here, parts[i]) if not kinds[i] else (None, None)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=list(_COLS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, sha256 of the edited
    text (its last half replaced by the start of the next document's), both
    fingerprints (base64 of their words; empty for an empty text) and the likeness
    of the text's to its edited form's and to the next text's.

    Documents follow each other by doc_id (null first), rows that repeat a
    doc_id by text; after the last comes the first, and a single document
    follows itself. Null texts are empty texts.

    Ids are cut into ranges of about ``PART_BYTES`` of text; a range is sorted
    in one task, and the first row of the following range is sent along."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total["b"] or 0) // PART_BYTES)
    parts = int(max(1, min(parts, total["n"], MAX_PARTS)))
    sample = bounded_sample(docs.select("doc_id").where("doc_id is not null"), hash60("cut", F.col("doc_id")), CUT_SAMPLE)
    ids = np.sort(np.array([r[0] for r in sample.distinct().collect()], np.int64))
    cuts = np.unique(ids[[len(ids) * i // parts for i in range(1, parts)]]) if len(ids) else ids

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, doc_id.to_numpy(), side="right"), dtype="int32")

    lowest = F.lit(-(1 << 63))
    placed = docs.withColumn("part", part_of(F.coalesce("doc_id", lowest)))
    heads = docs.select("doc_id").withColumn("part", part_of(F.coalesce("doc_id", lowest))) \
        .groupBy("part").agg(F.min(F.coalesce("doc_id", lowest)).alias("head"))
    ring = sorted((r["part"], r["head"]) for r in heads.collect())        # one row per range
    after = spark.createDataFrame([(ring[i - 1][0], h) for i, (_, h) in enumerate(ring)], "part int, head long")
    # the first row of each range also goes to the range before it
    sent = docs.join(F.broadcast(after), F.coalesce("doc_id", lowest) == F.col("head")) \
        .groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("r")) \
        .select("r.doc_id", "r.text", "part", F.lit(1).alias("kind"))
    both = placed.select("doc_id", "text", "part", F.lit(0).alias("kind")).unionByName(sent)
    return both.repartitionById(parts, F.col("part")) \
        .sortWithinPartitions("part", "kind", F.col("doc_id").asc_nulls_first(), "text") \
        .mapInArrow(_neighbours, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
