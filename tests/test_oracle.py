"""Every registered query with an oracle equals its DuckDB SQL at sf 0.001;
the others run and return rows; ``entry`` returns the flagship result."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from kiln.sources.io import TABLES

SF = "/root/testdata/sf0.001"
SLOW_ROWS_ONLY = {"kmeans_ml", "logreg", "mlp", "tree", "forest", "gbt",
                  "lasso_fit", "penalty_variants", "kmeans_loop", "copula_synth",
                  "smote_balance"}
# the optional corpus operators have their own tests
CORPUS = {q for q in E.queries() if q == "pipeline" or q.startswith("op")}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return "null" if v is None else str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - CORPUS))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW_ROWS_ONLY - CORPUS))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


def test_every_query_has_oracle_or_is_listed():
    missing = set(E.queries()) - set(E.oracle_sql())
    assert missing <= SLOW_ROWS_ONLY | CORPUS | {"sample_category"}


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "ratio", "pos_freq", "neg_freq"]
    assert 0 <= df.count() <= 5
