"""Shares of a short list of words, counted in one pass over a row's words."""
import re

from kiln.operators.features import SPAM_WORDS, listed_shares


def test_shares_of_listed_words(spark):
    texts = ["Make money, make all; other", "", None, "nothing here", "LAB labs lab2 our-our", "!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").select("id", listed_shares("t", SPAM_WORDS).alias("x"))
    for r in df.collect():
        w = re.findall(r"[a-z0-9]+", (texts[r.id] or "").lower())
        assert r.x == [100.0 * w.count(v) / len(w) if w else 0.0 for v in SPAM_WORDS]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("isin") + plan.count(" IN ") + plan.count("INSET") <= 1
