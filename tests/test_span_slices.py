"""Character spans leave a task in slices of a bounded number of characters."""
import pyarrow as pa
import regex

from kiln.operators import text as tx


def test_spans_in_slices():
    texts = ["Ab 12, " * (i * 40) + "日本é" for i in range(300)] + [None, "", "q" * (2 << 20)]
    out = list(tx.token_spans.func(iter([pa.array(texts, pa.string())])))
    assert len(out) > 10 and sum(map(len, out)) == len(texts)
    got = [r for part in out for r in part.to_pylist()]
    want = [[m.span() for m in regex.finditer(tx.TOKEN_PATTERN, t or "")] for t in texts]
    assert [list(zip(r["starts"], r["ends"])) for r in got] == want


def test_spans_as_a_column(spark):
    rows = [(i, "ab 1, " * (i % 900)) for i in range(2000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    got = df.select("id", tx.token_spans("t").alias("s")).selectExpr("id", "size(s.starts) as n", "try_element_at(s.ends, -1) as last")
    assert sorted(map(tuple, got.collect())) == [(i, 3 * (i % 900), 6 * (i % 900) - 1 if i % 900 else None) for i in range(2000)] + [(2000, 0, None)]
