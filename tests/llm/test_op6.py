"""Naive Bayes language ID against a plain per-text version; edge cases."""
import math
import random
from collections import Counter

import pyarrow as pa

from kiln.llm import langid

ALPHABET = {"en": "etaoinsh", "fr": "esaitnéà", "de": "enisräüß"}


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(ALPHABET))
        out.append((i, " ".join("".join(rng.choice(ALPHABET[lang]) for _ in range(rng.randrange(2, 8)))
                                for _ in range(rng.randrange(8, 40))), lang))
    return out


def buckets(text):
    (_, _, grams, _), = langid._slices(pa.array([text]))
    return Counter(int(b) for ids, _ in grams for b in ids)


def test_equals_plain_naive_bayes(spark):
    rows = corpus(120, 1)
    df = spark.createDataFrame([(i, t, lang, 3.0) for i, t, lang in rows], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(df.repartition(5)).collect()}
    train = [(t, lang) for i, t, lang in rows if not got[i].held_out]
    counts, n = {}, Counter(lang for _, lang in train)
    for t, lang in train:
        counts.setdefault(lang, Counter()).update(buckets(t))
    for i, t, _ in rows:
        b = buckets(t)
        z = {k: math.log(n[k] / len(train)) + sum(
            c * math.log((counts[k][x] + langid.ALPHA) / (sum(counts[k].values()) + langid.ALPHA * langid.BUCKETS))
            for x, c in b.items()) for k in counts}
        top = max(sorted(z), key=lambda k: z[k])
        assert got[i].lang_pred == top
        assert abs(got[i].score - 1 / sum(math.exp(v - z[top]) for v in z.values())) < 1e-3
    held = [(got[i].lang_pred, lang) for i, _, lang in rows if got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_edge_cases(spark, docs):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (5, 6, 10, 14))
    assert got[7].lang_pred in ("en", "fr") and len(langid.identify(docs).collect()) == docs.count()
    assert langid.identify(docs.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "abc", None), (2, "12", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(alone).collect()} == {"und"}


def test_case_and_symbols_do_not_matter():
    assert buckets("Été-42") == buckets("été 99") and buckets("") == Counter()
