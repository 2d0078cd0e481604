"""Learners written as Spark aggregates (J5, L5, L7 to L14), each held against
SQL that repeats the same steps."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F

from kiln.operators import cells, linear, trees
from kiln.operators import kmeans as km
from kiln.plans.registry import query
from kiln.sources.io import read_table

# ---- J5: exact neighbours over all dimensions ----------------------------------

_D2 = ("list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE)"
       " * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE)))")


@query("knn_all_dims", sql=f"""
WITH d AS (SELECT a.vec_id, b.vec_id AS n_id, b.label AS n_label, {_D2} AS d2
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.label = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, n_id) AS rk FROM d)
SELECT vec_id, rk::INTEGER AS place, n_id, n_label, round(d2, 6) AS d2 FROM r WHERE rk <= 5
""")
def q_knn_all_dims(spark, sf_dir):
    """The 5 nearest vectors of every vector of class 0, over all dims."""
    from pyspark.sql import Window
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    hits, _ = cells.knn(e.where("label = 0"), e, "vec_id", "embedding", "label", 5)
    w = Window.partitionBy("qid").orderBy("d2", "gid")
    return hits.select(F.col("qid").alias("vec_id"), F.row_number().over(w).alias("place"), F.col("gid").alias("n_id"),
                       "n_label", F.round("d2", 6).alias("d2"))


# ---- L13, L14: where k-means starts ---------------------------------------------

_K, _STEPS = 4, 2


def _uniform_sql(tag: str, key: str) -> str:
    return f"((('0x' || substr(md5('0:{tag}:' || {key}), 1, 8))::UBIGINT + 0.5) / 4294967296.0)"


def _start_sql() -> str:
    """The rounds of ``parallel_start`` and its reduction, one CTE a step."""
    ctes = ["e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE embedding IS NOT NULL)",
            f"c0 AS (SELECT vec_id, v, 0 AS step FROM e ORDER BY {_uniform_sql('first', 'vec_id::VARCHAR')}, vec_id LIMIT 1)"]
    dist = "list_sum(list_transform(range(1, len(e.v) + 1), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i])))"
    for s in range(_STEPS):
        ctes += [f"d{s} AS (SELECT e.vec_id, min({dist}) AS d2 FROM e CROSS JOIN c{s} c GROUP BY e.vec_id)",
                 f"c{s + 1} AS (SELECT * FROM c{s} UNION ALL SELECT e.vec_id, e.v, {s + 1} FROM e JOIN d{s} d USING (vec_id) "
                 f"WHERE {_uniform_sql(f'step{s}', 'e.vec_id::VARCHAR')} < 2.0 * {_K} * d.d2 / (SELECT sum(d2) FROM d{s}))"]
    last = f"c{_STEPS}"
    ctes += [f"cand AS (SELECT row_number() OVER (ORDER BY step, vec_id) AS i, vec_id, v FROM {last})",
             f"near AS (SELECT e.vec_id, arg_min(c.i, ({dist}, c.i)) AS i FROM e CROSS JOIN cand c GROUP BY e.vec_id)",
             "w AS (SELECT c.i, c.vec_id, c.v, count(n.vec_id) AS w FROM cand c LEFT JOIN near n USING (i) GROUP BY c.i, c.vec_id, c.v)",
             "p0 AS (SELECT i, v, vec_id, 0 AS place FROM w ORDER BY w DESC, i LIMIT 1)"]
    for j in range(1, _K):
        u = _uniform_sql("reduce", f"'{j}'")
        ctes += [f"m{j} AS (SELECT e.i, e.v, e.vec_id, e.w * min({dist}) AS mass FROM w e CROSS JOIN p{j - 1} c GROUP BY e.i, e.v, e.vec_id, e.w)",
                 f"s{j} AS (SELECT *, sum(mass) OVER (ORDER BY i) AS cum, sum(mass) OVER () AS total FROM m{j})",
                 f"p{j} AS (SELECT * FROM p{j - 1} UNION ALL SELECT * FROM (SELECT i, v, vec_id, {j} FROM s{j} WHERE cum >= {u} * total ORDER BY i LIMIT 1))"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT place::INTEGER AS place, list_transform(v, lambda x: round(x, 6)) AS center FROM p{_K - 1}"


@query("kmeans_parallel_start", sql=_start_sql())
def q_kmeans_parallel_start(spark, sf_dir):
    """The k-means|| start centres (k 4, 2 steps), seeded by hashes."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    start = km.parallel_start(e, "vec_id", "embedding", _K, steps=_STEPS)
    return spark.createDataFrame([Row(place=i, center=[round(x, 6) for x in c]) for i, c in enumerate(start)],
                                 "place int, center array<double>")


# ---- L7, L8, L9: trees ------------------------------------------------------------

TREE_FEATURES = ["n_chars", "n_words", "n_lines", "n_marks"]
_BINS = 16

_TREE_ROWS_SQL = f"""
WITH x AS (SELECT d.doc_id, l.quality AS y, n_chars::DOUBLE AS f0, len(string_split(text, ' '))::DOUBLE AS f1,
                  len(string_split(text, chr(10)))::DOUBLE AS f2, (length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g')))::DOUBLE AS f3
           FROM documents d JOIN labels l USING (doc_id)),
long AS (SELECT doc_id, y, u.f, u.v FROM x, unnest([{{'f': 0, 'v': f0}}, {{'f': 1, 'v': f1}}, {{'f': 2, 'v': f2}}, {{'f': 3, 'v': f3}}]) AS t(u)),
ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS r, count(*) OVER (PARTITION BY f) AS n, max(v) OVER (PARTITION BY f) AS top FROM long),
lims AS (SELECT DISTINCT f, v FROM ranked, range(1, {_BINS}) AS t(i) WHERE r = ceil(i * n / {_BINS}.0) AND v < top),
b AS (SELECT l.doc_id, l.y, l.f, count(m.v) + 1 AS b FROM long l LEFT JOIN lims m ON m.f = l.f AND m.v < l.v GROUP BY l.doc_id, l.y, l.f),
wide AS (SELECT doc_id, y, max(b) FILTER (f = 0) AS b0, max(b) FILTER (f = 1) AS b1, max(b) FILTER (f = 2) AS b2, max(b) FILTER (f = 3) AS b3
         FROM b GROUP BY doc_id, y)
"""


def _level_sql(src: str, out: str, depth: int, terms: list[str], count: str, impurity: str) -> list[str]:
    """CTEs of one grown tree on ``src`` (doc_id, b0..b3 and the term columns
    ``terms``): ``out`` has doc_id and node after ``depth`` levels and
    ``out``_nodes the split table. ``count`` and ``impurity`` are formulas over
    {0}, {1}, ... standing for the terms' sums."""
    def of(formula: str, args: list[str]) -> str:
        return formula.format(*args)
    ctes, prev = [f"{out}0 AS (SELECT *, 1 AS node FROM {src})"], f"{out}0"
    names = [f"t{i}" for i in range(len(terms))]
    splits = []
    for lv in range(depth):
        p = f"{out}l{lv}"
        left = [f"sum({n}) OVER (PARTITION BY node, f ORDER BY b)" for n in names]
        ctes += [
            f"{p}h AS (SELECT node, u.f, u.b, {', '.join(f'sum({t}) AS {n}' for t, n in zip(terms, names))} FROM {prev}, "
            "unnest([{'f': 0, 'b': b0}, {'f': 1, 'b': b1}, {'f': 2, 'b': b2}, {'f': 3, 'b': b3}]) AS t(u) GROUP BY node, u.f, u.b)",
            f"{p}a AS (SELECT node, {', '.join(f'sum({t}) AS a{i}' for i, t in enumerate(terms))} FROM {prev} GROUP BY node)",
            f"{p}c AS (SELECT h.node, f, b, max(b) OVER (PARTITION BY h.node, f) AS last_b, {', '.join(f'{e} AS l{i}' for i, e in enumerate([x.replace('node,', 'h.node,') for x in left]))}, "
            f"{', '.join(f'a.a{i}' for i in range(len(terms)))} FROM {p}h h JOIN {p}a a ON a.node = h.node)",
            f"{p}g AS (SELECT node, f, b, round({of(impurity, [f'a{i}' for i in range(len(terms))])} - "
            f"(({of(count, [f'l{i}' for i in range(len(terms))])}) * {of(impurity, [f'l{i}' for i in range(len(terms))])} + "
            f"({of(count, [f'(a{i} - l{i})' for i in range(len(terms))])}) * {of(impurity, [f'(a{i} - l{i})' for i in range(len(terms))])}) / "
            f"({of(count, [f'a{i}' for i in range(len(terms))])}), 9) AS gain FROM {p}c WHERE b < last_b)",
            f"{p}s AS (SELECT node, f, b, gain FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) AS rn FROM {p}g) WHERE rn = 1 AND gain > 0)",
            f"{out}{lv + 1} AS (SELECT r.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN r.node "
            f"WHEN [b0, b1, b2, b3][s.f + 1] <= s.b THEN 2 * r.node ELSE 2 * r.node + 1 END AS node FROM {prev} r LEFT JOIN {p}s s ON s.node = r.node"
            + (f" AND r.node >= {2 ** lv}" if lv else "") + ")"]
        prev = f"{out}{lv + 1}"
        splits.append(f"SELECT node, f, b, gain FROM {p}s WHERE node >= {2 ** lv}")
    ctes += [f"{out} AS (SELECT * FROM {prev})", f"{out}_nodes AS ({' UNION ALL '.join(splits)})"]
    return ctes


_GINI = "(1.0 - pow({0} / ({0} + {1}), 2) - pow({1} / ({0} + {1}), 2))"
_VAR = "greatest({2} / {0} - pow({1} / {0}, 2), 0)"


def _tree_rows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", " ")).alias("n_words"),
        F.size(F.split("text", "\n")).alias("n_lines"), (F.length("text") - F.length(F.regexp_replace("text", "[.,;:!?]", ""))).alias("n_marks"))


@query("tree_histogram", sql=_TREE_ROWS_SQL + ", " + ",\n".join(_level_sql(
    "wide", "t", 3, ["CASE WHEN y = 0 THEN 1 ELSE 0 END", "CASE WHEN y = 1 THEN 1 ELSE 0 END"], "{0} + {1}", _GINI)) + """,
leaves AS (SELECT node, count(*) AS n_rows, avg(y) AS share FROM t GROUP BY node)
SELECT coalesce(l.node, s.node)::INTEGER AS node, s.f::INTEGER AS feature, s.b::INTEGER AS bin, round(s.gain, 6) AS gain,
       l.n_rows::BIGINT AS n_rows, round(l.share, 6) AS share
FROM t_nodes s FULL JOIN leaves l ON l.node = s.node
""")
def q_tree_histogram(spark, sf_dir):
    """A Gini tree of depth 3 on 16 quantile bins: splits and leaves."""
    tree = trees.classification_tree(_tree_rows(spark, sf_dir), "y", TREE_FEATURES, [0, 1], depth=3, n_bins=_BINS)
    rows = [Row(node=n.node, feature=TREE_FEATURES.index(n.feature) if n.feature else None, bin=n.bin,
                gain=round(n.gain, 6) if n.feature else None, n_rows=None if n.feature else int(n.rows),
                share=None if n.feature else round(n.value[1], 6)) for n in tree.nodes.values()]
    return spark.createDataFrame(rows, "node int, feature int, bin int, gain double, n_rows long, share double")


def _boost_sql(rounds: int, depth: int, step: float) -> str:
    ctes = ["start AS (SELECT avg(y) AS m, ln(avg(y) / (1 - avg(y))) AS z FROM wide WHERE y IN (0, 1))",
            "z0 AS (SELECT w.*, s.z FROM wide w, start s WHERE y IN (0, 1))"]
    for r in range(rounds):
        ctes.append(f"r{r} AS (SELECT *, y - 1.0 / (1.0 + exp(-z)) AS res FROM z{r})")
        ctes += _level_sql(f"r{r}", f"g{r}_", depth, ["1.0::DOUBLE", "res", "res * res"], "{0}", _VAR)
        ctes += [f"v{r} AS (SELECT node, avg(res) AS val FROM g{r}_ GROUP BY node)",
                 f"z{r + 1} AS (SELECT g.doc_id, g.y, g.b0, g.b1, g.b2, g.b3, g.z + {step} * v.val AS z FROM g{r}_ g JOIN v{r} v USING (node))"]
    return ",\n".join(ctes)


@query("boosting_rounds", sql=_TREE_ROWS_SQL + ", " + _boost_sql(2, 2, 0.1) + "\nSELECT doc_id, round(z, 6) AS score FROM z2")
def q_boosting_rounds(spark, sf_dir):
    """Two boosting rounds with trees of depth 2; log odds of every
    labelled document."""
    rows = _tree_rows(spark, sf_dir)
    model = trees.boosted(rows, "y", TREE_FEATURES, rounds=2, depth=2, n_bins=_BINS, step=0.1)
    return trees.predict_boosted(rows, model, TREE_FEATURES).select("doc_id", F.round("score", 6).alias("score"))


# ---- L5: logistic regression --------------------------------------------------------

def _newton_sql(rounds: int) -> str:
    """Newton rounds for intercept and two standardised features; the 3 x 3
    system by Cramer's rule."""
    def det(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"
    h = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    ctes = ["b0_ AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)"]
    for r in range(rounds):
        ctes.append(f"p{r} AS (SELECT s.*, 1.0 / (1.0 + exp(-(w0 + w1 * z1 + w2 * z2))) AS p FROM s, b{r}_)")
        x = ["1.0", "z1", "z2"]
        sums = [f"sum((y - p) * {x[i]}) / count(*) AS g{i}" for i in range(3)] + [
            f"sum(p * (1 - p) * {x[i]} * {x[j]}) / count(*) AS h{i}{j}" for i in range(3) for j in range(i, 3)]
        ctes.append(f"q{r} AS (SELECT {', '.join(sums)} FROM p{r})")
        cols = []
        for j in range(3):
            m = [[f"g{i}" if c == j else h[i][c] for c in range(3)] for i in range(3)]
            cols.append(f"w{j} + {det(m)} / {det(h)} AS w{j}")
        ctes.append(f"b{r + 1}_ AS (SELECT {', '.join(cols)} FROM b{r}_, q{r})")
    return ",\n".join(ctes)


_NEWTON = 6


@query("logistic_newton", sql=f"""
WITH x AS (SELECT l.quality::DOUBLE AS y, ln(1 + n_chars) AS x1, (len(string_split(text, chr(10))))::DOUBLE AS x2
           FROM documents d JOIN labels l USING (doc_id)),
m AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2 FROM x),
s AS (SELECT y, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2 FROM x, m),
{_newton_sql(_NEWTON)}
SELECT round(w0 - w1 * m1 / s1 - w2 * m2 / s2, 6) AS intercept, [round(w1 / s1, 6), round(w2 / s2, 6)] AS coefficients FROM b{_NEWTON}_, m
""")
def q_logistic_newton(spark, sf_dir):
    """Logistic regression of quality on log length and line count after
    six Newton rounds."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    rows = d.join(lab, "doc_id").select(F.col("quality").alias("y"), F.log1p(F.col("n_chars").cast("double")).alias("x1"),
                                        F.size(F.split("text", "\n")).alias("x2"))
    fit = linear.logistic(rows, "y", ["x1", "x2"], rounds=_NEWTON, tol=0.0)
    return spark.createDataFrame([Row(intercept=round(fit.intercept, 6), coefficients=[round(c, 6) for c in fit.coefficients])])


# ---- L10, L11: penalised least squares -----------------------------------------------

PENALTIES = [("none", 0.0, 0.0), ("l2", 50.0, 0.0), ("l1", 20.0, 1.0), ("l1_l2", 50.0, 0.5), ("l1_all", 1e9, 1.0)]
_REG = ["n_words", "n_lines", "n_marks", "is_en"]
ROUNDS = 2000


def _path_sql() -> str:
    p = len(_REG)
    corr = ", ".join([f"coalesce(corr(x{i}, x{j}), 0) AS r{i}{j}" for i in range(p) for j in range(i + 1, p)]
                     + [f"coalesce(corr(x{i}, y), 0) AS t{i}" for i in range(p)])

    def gram(i: int, j: int) -> str:
        return "1.0" if i == j else f"r{min(i, j)}{max(i, j)}"
    # one round is p coordinate steps, each on the newest values
    inner = "path JOIN k USING (variant) WHERE i < ROUNDS"
    for j in range(p):
        rest = " - ".join([f"t{j}"] + [f"{gram(i, j)} * b{i}" for i in range(p) if i != j])
        inner = (f"(SELECT * REPLACE (CASE WHEN ({rest}) < 0 THEN -1 ELSE 1 END * greatest(abs({rest}) - reg * l1, 0) / (1.0 + reg * (1 - l1)) AS b{j}) "
                 f"FROM {inner})")
    names = ", ".join(f"b{i}" for i in range(p))
    fits = " UNION ALL ".join(f"SELECT '{n}' AS variant, {r}::DOUBLE AS pen, {e}::DOUBLE AS l1" for n, r, e in PENALTIES)
    return f"""
WITH RECURSIVE x AS (SELECT n_chars::DOUBLE AS y, len(string_split(text, ' '))::DOUBLE AS x0, len(string_split(text, chr(10)))::DOUBLE AS x1,
       (length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g')))::DOUBLE AS x2, (lang = 'en')::INT::DOUBLE AS x3 FROM documents
       WHERE n_chars IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL),
c AS (SELECT {corr}, avg(y) AS my, stddev_pop(y) AS sy, {', '.join(f'avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}' for i in range(p))} FROM x),
v AS ({fits}),
k AS (SELECT v.variant, v.pen / c.sy AS reg, v.l1, c.* FROM v, c),
path AS (SELECT variant, 0 AS i, {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(p))} FROM v
  UNION ALL
  SELECT variant, i + 1 AS i, {names} FROM {inner.replace('ROUNDS', str(ROUNDS))}),
done AS (SELECT variant, {', '.join(f'arg_max(b{i}, i) AS b{i}' for i in range(p))} FROM path GROUP BY variant)
SELECT variant, round(my - ({' + '.join(f'b{i} * sy / s{i} * m{i}' for i in range(p))}), 4) AS intercept,
       [{', '.join(f'round(b{i} * sy / s{i}, 4)' for i in range(p))}] AS coefficients FROM done, c
"""


def _reg_rows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["text", "lang", "n_chars"])
    return d.select(F.col("n_chars").alias("y"), F.size(F.split("text", " ")).alias("n_words"), F.size(F.split("text", "\n")).alias("n_lines"),
                    (F.length("text") - F.length(F.regexp_replace("text", "[.,;:!?]", ""))).alias("n_marks"),
                    (F.col("lang") == "en").cast("int").alias("is_en"))


@query("penalty_path", sql=_path_sql())
def q_penalty_path(spark, sf_dir):
    """L10 + L11: text length on word, line and mark counts and is-English
    under five penalties, all from the same two scans."""
    fits = linear.penalty_path(_reg_rows(spark, sf_dir), "y", _REG, [(r, e) for _, r, e in PENALTIES])
    return spark.createDataFrame([Row(variant=n, intercept=round(f.intercept, 4), coefficients=[round(c, 4) for c in f.coefficients])
                                  for (n, _, _), f in zip(PENALTIES, fits)])
