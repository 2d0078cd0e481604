"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams (3 to 5, with word borders) and
itself, hashed into ``BUCKETS`` embedding rows; a text is the (damped)
average of its words' averages. Embeddings and softmax are trained jointly in numpy on a
bounded sample of labelled rows, so a misspelling never seen shares most
of its n-grams' vectors with the word it comes from. For scoring, embeddings
times softmax collapse into one number per bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.frames import bounded_sample, fold, hash60
from kiln.llm.textops import ASCII_LOWER, slices, span_hashes, utf8_buffer, word_spans

BUCKETS, DIM = 1 << 16, 8
NGRAMS = (3, 4, 5)
TRAIN_ROWS = 2000                  # labelled rows per class that the fit reads
TRAIN_TEXT_BYTES = 1 << 20         # longer texts are left out of the fit (not of scoring)
STEPS, RATE, OUT_RATE, MOMENTUM = 150, 120.0, 0.05, 0.9
PRIOR, MIN_TEXTS, DECAY = 10.0, 5, 1e-5
BLOCK = 200                        # texts per block of the fit: bounds its temporaries
THRESHOLD = 0.7

# words: runs of letters, digits and non-ASCII bytes
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[48:58] = SEPARATOR[65:91] = SEPARATOR[97:123] = SEPARATOR[128:] = False


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of each word and the word itself."""
    width = ends - starts + 2
    off = np.concatenate([[0], np.cumsum(width)])
    at = np.arange(off[-1])
    word = np.repeat(np.arange(len(starts)), width)
    src = at - off[word] - 1 + starts[word]
    buf = data[np.clip(src, 0, len(data) - 1)].copy() if len(data) else np.zeros(0, np.uint8)
    buf[off[:-1]], buf[off[1:] - 1] = 60, 62
    left = off[word + 1] - at
    ids = [span_hashes(buf, off[:-1], off[1:])]
    of = [np.arange(len(starts))]
    for n in NGRAMS:
        p = at[left >= n]
        ids.append(span_hashes(buf, p, p + n))
        of.append(word[p])
    return (np.concatenate(ids) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(of)


def _bags(col: pa.Array) -> Iterator[tuple]:
    """Per slice: rows in it, its distinct words' number, their (bucket, word)
    pairs, and (row, word, weight) of every row's words: the root of the count
    over the row's total plus ``PRIOR``, so neither a word said over and over
    nor a very short text gets a loud vote."""
    data, offsets = utf8_buffer(col)
    for i, j, raw, off in slices(data, offsets):
        low = ASCII_LOWER[raw]
        starts, ends, rows = word_spans(low, off, SEPARATOR)
        _, first, word = np.unique(span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        ids, of = subwords(low, starts[first], ends[first])
        pair, count = np.unique(rows * max(len(first), 1) + word, return_counts=True)
        row, word = pair // max(len(first), 1), pair % max(len(first), 1)
        weight = np.sqrt(count)
        weight /= (np.bincount(row, weights=weight, minlength=j - i) + PRIOR)[row]
        yield j - i, len(first), ids, of, row, word, weight


def _logits(col: pa.Array, v: np.ndarray, bias: float) -> np.ndarray:
    out = []
    for n, words, ids, of, row, word, weight in _bags(col):
        per_word = np.bincount(of, weights=v[ids], minlength=words) / np.maximum(np.bincount(of, minlength=words), 1)
        out.append(np.bincount(row, weights=weight * per_word[word], minlength=n) + bias)
    return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[str], labels: list[int], seed: int = 5) -> tuple[np.ndarray, float]:
    """(one weight per bucket, bias): embeddings and a two-class softmax
    trained together by gradient descent with momentum on the balanced
    log-loss. Buckets seen in fewer than ``MIN_TEXTS`` texts stay zero; inputs
    are scaled by the root of their usual size, so rare n-grams can speak up."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, float)
    n = len(y)
    if not n or y.min() == y.max():
        return np.zeros(BUCKETS), 8.0 if n and y.max() else -8.0
    blocks = []                  # of texts: bucket and value of every n-gram, n-grams per text
    seen, square = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in range(0, n, BLOCK):
        cols, vals, sizes = [], [], []
        for text in texts[at:at + BLOCK]:
            dense = np.zeros(BUCKETS)
            for _, words, ids, of, _, word, weight in _bags(pa.array([text], pa.string())):
                per_word = np.zeros(words)
                per_word[word] = weight
                dense += np.bincount(ids, weights=(per_word / np.maximum(np.bincount(of, minlength=words), 1))[of],
                                     minlength=BUCKETS)
            nz = np.flatnonzero(dense)
            cols.append(nz.astype(np.int32))
            vals.append(dense[nz].astype(np.float32))
            sizes.append(len(nz))
            seen[nz] += 1
            square[nz] += dense[nz] ** 2
        blocks.append((np.concatenate(cols), np.concatenate(vals), np.array(sizes)))
    scale = np.where(seen >= MIN_TEXTS, 1 / np.sqrt(np.maximum(np.sqrt(square / n), 1e-9)), 0.0)
    norm = 0.0
    for k, (c, x, sizes) in enumerate(blocks):
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        live = scale[c] > 0
        c, row, x = c[live], row[live], (x[live] * scale[c[live]]).astype(np.float32)
        norm += float((x.astype(np.float64) ** 2).sum())
        blocks[k] = (c, x, np.bincount(row, minlength=len(sizes)))
    unit = np.sqrt(max(norm / n, 1e-12))
    emb, out, bias = rng.normal(0, 0.01, (BUCKETS, DIM)), rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    out /= np.linalg.norm(out[:, 1] - out[:, 0])
    m_emb, m_out, m_bias = np.zeros_like(emb), np.zeros_like(out), np.zeros(2)
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    for _ in range(STEPS):
        v = emb @ (out[:, 1] - out[:, 0]) / unit
        pull, total = np.zeros(BUCKETS), 0.0
        for k, (c, x, sizes) in enumerate(blocks):
            row = np.repeat(np.arange(len(sizes)), sizes)
            of = slice(k * BLOCK, k * BLOCK + len(sizes))
            z = np.bincount(row, weights=x * v[c], minlength=len(sizes)) + bias[1] - bias[0]
            delta = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[of]) * share[of]      # of class 1; class 0: its negative
            pull += np.bincount(c, weights=x * delta[row], minlength=BUCKETS) / unit
            total += delta.sum()
        m_emb = MOMENTUM * m_emb + pull[:, None] * (out[:, 1] - out[:, 0]) + DECAY * emb
        g = emb.T @ pull
        m_out = MOMENTUM * m_out + np.stack([-g, g], axis=1)
        m_bias = MOMENTUM * m_bias + np.array([-total, total])
        emb -= RATE * m_emb
        out -= OUT_RATE * m_out
        bias -= OUT_RATE * m_bias
    return emb @ (out[:, 1] - out[:, 0]) * scale / unit, float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on at most about ``TRAIN_ROWS`` labelled rows per class whose id is
    not held out (picked by an id hash). Null labels and texts are left out; an
    id with several labels counts as toxic if one of them is."""
    known = labels.where("toxic is not null and doc_id is not null").where(fold("doc_id", 3) != 1) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for label in (0, 1):
        part = bounded_sample(known.where(F.col("toxic") == label), hash60("toxic", F.col("doc_id")), TRAIN_ROWS)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= TRAIN_TEXT_BYTES) \
        .join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "score") -> DataFrame:
    """``docs`` with the probability of the toxic class (null and empty texts
    get that of the bias alone, at most a half)."""
    v, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _logits(batch.column("text"), v, bias)
            yield batch.append_column(column, pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id,
    text). Null and empty texts are scored by the bias. An empty table gives no
    rows; without labels of both classes nothing can be told apart and every
    row gets the one class known (not toxic without any)."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
