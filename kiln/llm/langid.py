"""Language identification by multinomial naive Bayes over hashed character
n-grams (1 to 3 code points, lower case, everything but letters a blank).

Counts per (language, bucket) are gathered by aggregation over all rows that
may be learnt from; the smoothed log-probability matrix, languages times
buckets, goes to the tasks, which score batches of texts by gathering its rows
and summing them per text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import fold
from kiln.llm.ngrams import TABLES, hashed, row_sums
from kiln.llm.textops import codepoints, slices, utf8_buffer

BUCKETS = 1 << 14
NGRAMS = (1, 2, 3)
ALPHA = 0.5
MAX_LANGUAGES = 1000               # bound of the matrix: languages x buckets floats


def _slices(col: pa.Array) -> Iterator[tuple[int, int, list, np.ndarray]]:
    """(first row, end row, [(buckets, n-grams per row)] for each n, whether
    the row has a letter)."""
    data, offsets = utf8_buffer(col)
    is_letter, low = TABLES.letters(), TABLES.lower()
    for i, j, raw, off in slices(data, offsets):
        cp, at = codepoints(raw, off)
        letter = is_letter[cp]
        cp = np.where(letter, low[cp], np.uint32(32))
        has = row_sums(letter, np.diff(at)) > 0
        yield i, j, [hashed(cp, at, n, BUCKETS) for n in NGRAMS], has


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table of counts per task: language by bucket."""
    total: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
        for i, j, grams, has in _slices(batch.column("text")):
            part = langs[i:j]
            for lang in set(part[has]):
                total.setdefault(lang, np.zeros(BUCKETS))
                rows[lang] = rows.get(lang, 0) + int((part[has] == lang).sum())
                for ids, per_row in grams:
                    mine = np.repeat((part == lang) & has, per_row)
                    total[lang] += np.bincount(ids[mine], minlength=BUCKETS)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(at) + 1), pa.string()),
             pa.array(np.append(at, -1), pa.int32()),               # bucket -1: number of texts
             pa.array(np.append(counts[at], rows[lang]).astype(np.int64))], names=["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log-probability matrix buckets x languages)
    from all rows with a language whose id is not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(fold("doc_id", 5) != 0)
    counts = known.select("lang", "text").mapInArrow(_count_batches, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_lang = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")) \
        .limit(MAX_LANGUAGES + 1).collect()
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(r.lang for r in per_lang)
    matrix, texts = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for r in per_lang:
        k = langs.index(r.lang)
        for bucket, n in r.c:
            if bucket < 0:
                texts[k] = n
            else:
                matrix[bucket, k] = n
    prior = np.log(np.maximum(texts, 1) / max(texts.sum(), 1))
    return langs, prior, np.log((matrix + ALPHA) / (matrix + ALPHA).sum(axis=0)) if langs else matrix


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score per row: the likeliest language (ties: the
    first by name) and its posterior probability; ``und`` with score 0 for
    texts without a letter, or when nothing was learnt."""
    langs, prior, matrix = model
    matrix = np.ascontiguousarray(matrix, dtype=np.float32)
    names = np.asarray(langs + ["und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [], []
            for i, j, grams, has in _slices(batch.column("text")):
                if not langs:
                    best.append(np.zeros(j - i, int))
                    score.append(np.zeros(j - i))
                    continue
                z = np.tile(prior, (j - i, 1))
                for ids, per_row in grams:
                    z += row_sums(matrix[ids], per_row)
                top = z.argmax(axis=1)
                p = 1 / np.exp(z - z[np.arange(j - i), top][:, None]).sum(axis=1)
                best.append(np.where(has, top, len(langs)))
                score.append(np.where(has, p, 0.0))
            at = np.concatenate(best) if best else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[at], pa.string()),
                 pa.array(np.concatenate(score) if score else np.zeros(0))], names=["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id,
    text, lang); null and empty texts are ``und``."""
    out = predict(docs, train(docs))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
