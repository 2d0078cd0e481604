"""Quality by ordinal regression: a cumulative-link (proportional odds) model
over hashed text features.

A text is the normalised bag of its character n-grams (case and symbols kept)
in ``BUCKETS`` hashed features. One shared weight vector gives a latent
quality; ordered thresholds cut it into grades, P(grade > k) = sigmoid(w x -
t_k) with t_0 < t_1 < ... The fit runs in numpy on a bounded sample of graded
rows; scoring gives the expected grade and the tail probabilities, which are
what a selection thresholds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import bounded_sample, fold, hash60
from kiln.llm.ngrams import hashed
from kiln.llm.textops import codepoints, slices, utf8_buffer

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3)
TRAIN_ROWS = 1000                  # graded rows per grade that the fit reads
TRAIN_TEXT_BYTES = 1 << 20
MAX_GRADES = 20
STEPS, RATE, MOMENTUM, MIN_TEXTS, DECAY = 150, 30.0, 0.9, 3, 1e-6
BLOCK = 200                        # texts per block of the fit: bounds its temporaries
KEEP_AT = 0.5                      # a text is kept when P(grade >= 1) reaches this


def features(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: rows in it and their sparse (row, bucket, value); a row's
    values are the roots of its n-gram shares."""
    data, offsets = utf8_buffer(col)
    for i, j, raw, off in slices(data, offsets):
        cp, at = codepoints(raw, off)
        keys, total = [], np.zeros(j - i)
        for n in NGRAMS:
            ids, per_row = hashed(cp, at, n, BUCKETS)
            keys.append(np.repeat(np.arange(j - i), per_row) * BUCKETS + ids)
            total += per_row
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        row = key // BUCKETS
        yield j - i, row, key % BUCKETS, np.sqrt(count / total[row])


def _latent(col: pa.Array, w: np.ndarray) -> np.ndarray:
    out = [np.bincount(row, weights=x * w[c], minlength=n) for n, row, c, x in features(col)]
    return np.concatenate(out) if out else np.zeros(0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(texts: list[str], grades: list[int], n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(shared weights, ordered thresholds), by gradient descent with momentum
    on the log-likelihood, grades weighted equally; the step is halved whenever
    the loss rises. Thresholds are kept ordered
    as a first one plus positive steps."""
    y = np.asarray(grades, int)
    n = len(y)
    if not n or n_grades < 2:
        return np.zeros(BUCKETS), np.zeros(max(n_grades - 1, 0))
    blocks, seen = [], np.zeros(BUCKETS)          # per block of texts: bucket, value, entries per text
    for at in range(0, n, BLOCK):
        cols, vals, sizes = [], [], []
        for text in texts[at:at + BLOCK]:
            got = [(c, x) for _, _, c, x in features(pa.array([text], pa.string()))]
            c, x = (np.concatenate(v) for v in zip(*got))
            cols.append(c.astype(np.int32))
            vals.append(x.astype(np.float32))
            sizes.append(len(c))
            seen[c] += 1
        blocks.append((np.concatenate(cols), np.concatenate(vals), np.array(sizes)))
    for k, (c, x, sizes) in enumerate(blocks):
        live = seen[c] >= MIN_TEXTS
        row = np.repeat(np.arange(len(sizes)), sizes)[live]
        blocks[k] = (c[live], x[live], np.bincount(row, minlength=len(sizes)))

    def latent(w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(np.repeat(np.arange(len(s)), s), weights=x * w[c], minlength=len(s))
                               for c, x, s in blocks])

    def pulled(g: np.ndarray) -> np.ndarray:
        out = np.zeros(BUCKETS)
        for k, (c, x, s) in enumerate(blocks):
            out += np.bincount(c, weights=x * np.repeat(g[k * BLOCK:k * BLOCK + len(s)], s), minlength=BUCKETS)
        return out

    w = np.zeros(BUCKETS)
    theta = np.concatenate([[-(n_grades - 2) / 2], np.zeros(n_grades - 2)])    # first, log steps
    m_w, m_t = np.zeros(BUCKETS), np.zeros(n_grades - 1)
    share = (1.0 / np.maximum(np.bincount(y, minlength=n_grades), 1))[y]
    share /= share.sum()
    rate, last, back = RATE, np.inf, (w.copy(), theta.copy())
    for _ in range(STEPS):
        cut = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        z = latent(w)
        upper = np.where(y > 0, _sigmoid(z - cut[np.maximum(y - 1, 0)]), 1.0)          # P(grade >= y)
        lower = np.where(y < n_grades - 1, _sigmoid(z - cut[np.minimum(y, n_grades - 2)]), 0.0)   # P(grade > y)
        p = np.maximum(upper - lower, 1e-9)
        loss = -(share * np.log(p)).sum() + DECAY / 2 * (w * w).sum()
        if loss > last:                       # too far: back to the last good point with half the step
            rate /= 2
            w, theta = back[0].copy(), back[1].copy()
            m_w[:], m_t[:], last = 0, 0, np.inf
            continue
        last, back = loss, (w.copy(), theta.copy())
        d_up, d_low = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_z = -(d_up - d_low) * share
        g_cut = np.bincount(np.maximum(y - 1, 0), weights=np.where(y > 0, d_up, 0) * share, minlength=n_grades - 1) \
            - np.bincount(np.minimum(y, n_grades - 2), weights=np.where(y < n_grades - 1, d_low, 0) * share,
                          minlength=n_grades - 1)
        g_t = np.cumsum(g_cut[::-1])[::-1]
        g_t = np.concatenate([g_t[:1], g_t[1:] * np.exp(theta[1:])])
        m_w = MOMENTUM * m_w + pulled(g_z) + DECAY * w
        m_t = MOMENTUM * m_t + g_t
        w -= rate * m_w
        theta -= min(rate, 0.3) * m_t
    w, theta = back
    return w, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))


def train(docs: DataFrame, grades: DataFrame, parts: int = 5, held: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fit on at most about ``TRAIN_ROWS`` rows per grade of ``grades``
    (doc_id, grade from 0) whose id is not held out. Null grades and texts are
    left out; of several grades of an id the lowest counts."""
    known = grades.where("grade is not null and doc_id is not null").where(fold("doc_id", parts) != held) \
        .groupBy("doc_id").agg(F.min("grade").alias("grade"))
    levels = sorted(r[0] for r in known.select("grade").distinct().limit(MAX_GRADES + 1).collect())
    if len(levels) > MAX_GRADES or (levels and levels[0] < 0):
        raise ValueError(f"grades must be 0 to at most {MAX_GRADES - 1}")
    picked = None
    for g in levels:
        part = bounded_sample(known.where(F.col("grade") == g), hash60("grade", F.col("doc_id")), TRAIN_ROWS)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return fit([], [], 0)
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= TRAIN_TEXT_BYTES) \
        .join(F.broadcast(picked), "doc_id").select("doc_id", "text", "grade").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return fit([r.text for r in rows], [int(r.grade) for r in rows], int(levels[-1]) + 1)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, expected_grade and tail (P(grade >= 1), P(grade >= 2), ...) of
    every row; null and empty texts get those of a latent quality of 0."""
    w, cut = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tail = _sigmoid(_latent(batch.column("text"), w)[:, None] - cut[None, :])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tail.sum(axis=1)),
                 pa.array(list(tail), pa.list_(pa.float64()))], names=["doc_id", "expected_grade", "tail"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, expected_grade double, tail array<double>")


def quality(docs: DataFrame, grades: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, held_out, expected_grade, p_good = P(grade >= 1), kept for every
    row. Without grades nothing is known: expected grade 0, all kept."""
    out = score(docs, train(docs, grades))
    p = F.get("tail", F.lit(0))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "expected_grade",
                      F.coalesce(p, F.lit(0.0)).alias("p_good"), F.coalesce(p >= keep_at, F.lit(True)).alias("kept"))
