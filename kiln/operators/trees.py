"""Decision trees by level-wise histogram search.

Every feature value is put into one of a few bins once, between exact quantile
limits. A level of the tree is one
aggregate: per (node, feature, bin) the sums a split is judged by, counted in
the map tasks before the shuffle, so a node or a bin with a third of all rows
costs one row per task. The best split of every node is chosen from that
table, which is nodes x features x bins rows whatever the data's size, and
rows are routed by an expression over their bins: no row leaves its task
between levels.

Splits are ``bin <= b`` on the bins' order. A split must leave at least
``min_rows`` rows on both sides and improve the impurity by more than
``min_gain``; among equal gains the smallest feature, then the smallest bin
wins (gains are compared rounded to 9 digits, so the choice does not depend
on the order of additions)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.ordered import ordered_scan, range_bucketed

GAIN_DIGITS = 9
MAX_CELLS = 4_000_000   # nodes x features x bins of one level


@dataclass(frozen=True)
class Binning:
    """Inner limits of each numeric feature: bin = 1 + number of limits <
    value; null and NaN have bin 0 to themselves."""
    limits: dict[str, list[float]]

    def bins(self, name: str) -> Column:
        x = F.col(name).cast("double")
        x = F.when(~F.isnan(x), x)
        lims = F.lit([float(v) for v in self.limits[name]]).cast("array<double>")
        return F.when(x.isNull(), F.lit(0)).otherwise(F.size(F.filter(lims, lambda v: v < x)) + 1)

    def n_bins(self, name: str) -> int:
        return len(self.limits[name]) + 2


def exact_limits(df: DataFrame, features: Sequence[str], n_bins: int) -> Binning:
    """Limits at the values of rank ceil(i n / n_bins), exact: distinct values
    with their counts, summed within ranges and offset by the ranges before
    (no window over a whole column); equal limits are merged and the greatest
    value is no limit."""
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x")) for i, c in enumerate(features)])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where("x is not null and not isnan(x)") \
        .groupBy("f", "x").agg(F.count(F.lit(1)).alias("n"))
    spans = {r["f"]: r for r in values.groupBy("f").agg(F.max("x").alias("hi"), F.sum("n").alias("rows")).collect()}
    out = {c: [] for c in features}
    if not spans:
        return Binning(out)
    hi, rows = (F.element_at(F.create_map(*[F.lit(v) for f, r in spans.items() for v in (f, r[key])]), F.col("f")) for key in ("hi", "rows"))
    run = ordered_scan(range_bucketed(values, [F.col("f"), F.col("x")]), [F.col("x").asc()], F.col("_range"), ["f"],
                       sums=["n"], rank_col="_r", size_col=None)
    # the value at rank r is the first whose running count reaches r
    ranks = F.sequence(F.lit(1), F.lit(n_bins - 1))
    hit = F.exists(ranks, lambda i: (F.ceil(i * rows / n_bins) > F.col("cum_n") - F.col("n")) & (F.ceil(i * rows / n_bins) <= F.col("cum_n")))
    for r in run.where(hit & (F.col("x") < hi)).select("f", "x").collect():        # at most features x bins
        out[features[r["f"]]].append(float(r["x"]))
    return Binning({c: sorted(v) for c, v in out.items()})


@dataclass
class Node:
    """``feature`` is None in a leaf; ``value`` is the class shares (or the
    mean) of the rows that reach it."""
    node: int
    rows: float
    value: list[float]
    impurity: float
    feature: str | None = None
    bin: int | None = None
    gain: float = 0.0


@dataclass
class Tree:
    nodes: dict[int, Node]
    binning: Binning

    def leaf(self, bins: dict[str, str]) -> Column:
        """The leaf's number (root 1, children 2 n and 2 n + 1) of a row whose
        bins are in the named columns."""
        def walk(n: int) -> Column:
            at = self.nodes[n]
            if at.feature is None:
                return F.lit(n)
            return F.when(F.col(bins[at.feature]) <= at.bin, walk(2 * n)).otherwise(walk(2 * n + 1))
        return walk(1)

    def value(self, bins: dict[str, str], k: int = 0) -> Column:
        """Component ``k`` of the leaf's value."""
        def walk(n: int) -> Column:
            at = self.nodes[n]
            if at.feature is None:
                return F.lit(float(at.value[k]))
            return F.when(F.col(bins[at.feature]) <= at.bin, walk(2 * n)).otherwise(walk(2 * n + 1))
        return walk(1)


def _gini(sums: Sequence[float]) -> float:
    n = sum(sums)
    return 1.0 - sum((s / n) ** 2 for s in sums) if n else 0.0


def _variance(sums: Sequence[float]) -> float:
    n, s, q = sums
    return max(q / n - (s / n) ** 2, 0.0) if n else 0.0


def _grow(rows: DataFrame, bins: dict[str, str], binning: Binning, sums: dict[str, Column], count, impurity, value,
          depth: int, min_rows: int, min_gain: float, features_of=None) -> Tree:
    """Level by level: ``sums`` are the named per-row terms a split is judged
    by; ``count``, ``impurity`` and ``value`` read a list of their totals.
    ``features_of(node)`` may restrict the features a node chooses from."""
    features = list(bins)
    names = list(sums)
    cells = 2 ** depth * sum(binning.n_bins(f) for f in features)
    if cells > MAX_CELLS:
        raise ValueError(f"{cells} split candidates in one level exceed {MAX_CELLS}")
    start = rows.agg(*[F.sum(e).alias(s) for s, e in sums.items()]).first()
    totals = [float(start[s] or 0.0) for s in names]
    tree = Tree({1: Node(1, count(totals), value(totals), impurity(totals))}, binning)
    frontier = {1: totals}
    for _ in range(depth):
        frontier = {n: t for n, t in frontier.items() if count(t) >= 2 * min_rows and impurity(t) > 0}
        if not frontier:
            break
        long = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(bins[f]).cast("int").alias("b")) for i, f in enumerate(features)]))
        table = rows.withColumn("_node", tree.leaf(bins)).where(F.col("_node").isin([int(n) for n in frontier])) \
            .select("_node", *[e.alias(s) for s, e in sums.items()], long.alias("_c")) \
            .groupBy("_node", F.col("_c.f").alias("f"), F.col("_c.b").alias("b")).agg(*[F.sum(s).alias(s) for s in names])
        counts: dict[tuple[int, int], dict[int, list[float]]] = {}
        for r in table.collect():                           # nodes x features x bins, checked above
            counts.setdefault((r["_node"], r["f"]), {})[r["b"]] = [float(r[s] or 0.0) for s in names]
        grown = {}
        for n, t in frontier.items():
            best = None
            allowed = features if features_of is None else features_of(n)
            for i, f in enumerate(features):
                if f not in allowed:
                    continue
                left = [0.0] * len(names)
                for b in sorted(counts.get((n, i), {}))[:-1]:
                    left = [x + y for x, y in zip(left, counts[n, i][b])]
                    right = [x - y for x, y in zip(t, left)]
                    nl, nr = count(left), count(right)
                    if nl < min_rows or nr < min_rows:
                        continue
                    gain = impurity(t) - (nl * impurity(left) + nr * impurity(right)) / (nl + nr)
                    key = (-round(gain, GAIN_DIGITS), i, b)
                    if best is None or key < best[0]:
                        best = (key, f, b, left, right)
            if best is None or -best[0][0] <= min_gain:
                continue
            node = tree.nodes[n]
            node.feature, node.bin, node.gain = best[1], best[2], -best[0][0]
            for child, totals in ((2 * n, best[3]), (2 * n + 1, best[4])):
                tree.nodes[child] = Node(child, count(totals), value(totals), impurity(totals))
                grown[child] = totals
        frontier = grown
    return tree


def _binned(df: DataFrame, features: Sequence[str], binning: Binning, keep: Sequence[Column]) -> tuple[DataFrame, dict[str, str]]:
    bins = {f: f"_b{i}" for i, f in enumerate(features)}
    return df.select(*keep, *[binning.bins(f).alias(b) for f, b in bins.items()]), bins


def classification_tree(df: DataFrame, label: str, features: Sequence[str], classes: Sequence, depth: int = 5, n_bins: int = 32,
                        min_rows: int = 1, min_gain: float = 0.0, binning: Binning | None = None, weight: Column | None = None,
                        features_of=None) -> Tree:
    """Gini tree over ``classes`` (rows with another or a null label take
    no part). ``weight`` counts a row several times (bootstrap draws)."""
    binning = binning or exact_limits(df, features, n_bins)
    w = F.lit(1) if weight is None else weight
    rows, bins = _binned(df.where(F.col(label).isin(list(classes))), features, binning, [F.col(label).alias("_y"), w.cast("double").alias("_w")])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = {f"c{i}": F.when(F.col("_y") == F.lit(c), F.col("_w")).otherwise(F.lit(0.0)) for i, c in enumerate(classes)}
        return _grow(rows, bins, binning, sums, sum, _gini, lambda t: [x / sum(t) if sum(t) else 0.0 for x in t],
                     depth, min_rows, min_gain, features_of)
    finally:
        rows.unpersist()


def regression_tree(rows: DataFrame, target: Column, bins: dict[str, str], binning: Binning, depth: int,
                    min_rows: int = 1, min_gain: float = 0.0) -> Tree:
    """Variance tree of ``target`` over rows that carry their bins."""
    sums = {"n": F.lit(1.0), "s": target, "q": target * target}
    return _grow(rows, bins, binning, sums, lambda t: t[0], _variance, lambda t: [t[1] / t[0] if t[0] else 0.0], depth, min_rows, min_gain)


def predict_tree(df: DataFrame, tree: Tree, features: Sequence[str], classes: Sequence, out: str = "prediction",
                 share: str | None = None) -> DataFrame:
    """``df`` with the predicted class (greatest share, first class on ties)
    and, named, the share of the last class."""
    bins = {f: f"_b{i}" for i, f in enumerate(features)}
    binned = df.withColumns({b: tree.binning.bins(f) for f, b in bins.items()})
    shares = [tree.value(bins, i) for i in range(len(classes))]
    top = F.greatest(*shares) if len(shares) > 1 else shares[0]
    pick = F.lit(classes[-1])
    for c, s in list(zip(classes, shares))[-2::-1]:
        pick = F.when(s == top, F.lit(c)).otherwise(pick)
    made = {out: pick} | ({share: shares[-1]} if share else {})
    return binned.withColumns(made).drop(*bins.values())


@dataclass
class Forest:
    trees: list[Tree]
    classes: list


def forest(df: DataFrame, id_col: str, label: str, features: Sequence[str], classes: Sequence, n_trees: int = 10, depth: int = 5,
           n_bins: int = 32, seed: int = 0, feature_share: float | None = None) -> Forest:
    """Bagged trees. A row's count in a tree is a Poisson(1) draw from the
    md5 of (seed, tree, id), so reruns agree; each node of a tree chooses among
    a hash-picked share of the features (default: square root of their
    number)."""
    import hashlib
    import math
    binning = exact_limits(df, features, n_bins)
    pick = max(1, round(feature_share * len(features) if feature_share else math.sqrt(len(features))))
    trees = []
    for t in range(n_trees):
        def chosen(node: int, t=t) -> set[str]:
            order = sorted(features, key=lambda f: hashlib.md5(f"{seed}:{t}:{node}:{f}".encode()).hexdigest())
            return set(order[:pick])
        trees.append(classification_tree(df, label, features, classes, depth, n_bins, binning=binning,
                                         weight=poisson(seed, t, F.col(id_col)), features_of=chosen))
    return Forest(trees, list(classes))


def poisson(seed: int, draw: int, key: Column, most: int = 8) -> Column:
    """A Poisson(1) count from a hash uniform of (seed, draw, key)."""
    import math
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:{draw}"), key.cast("string")).cast("binary")), 1, 8), 16, 10)
    u = (h.cast("double") + 0.5) / 4294967296.0
    total, out = 0.0, F.lit(0)
    for k in range(most):
        total += math.exp(-1) / math.factorial(k)
        out = out + (u >= total).cast("int")
    return out


def predict_forest(df: DataFrame, model: Forest, features: Sequence[str], out: str = "share") -> DataFrame:
    """``df`` with the mean over the trees of the last class's share."""
    bins = {f: f"_b{i}" for i, f in enumerate(features)}
    binned = df.withColumns({b: model.trees[0].binning.bins(f) for f, b in bins.items()})
    shares = [t.value(bins, len(model.classes) - 1) for t in model.trees]
    total = shares[0]
    for s in shares[1:]:
        total = total + s
    return binned.withColumn(out, total / len(shares)).drop(*bins.values())


@dataclass
class Boosted:
    trees: list[Tree]
    start: float
    step: float
    loss: list[float]


def boosted(df: DataFrame, label: str, features: Sequence[str], rounds: int = 10, depth: int = 3, n_bins: int = 32,
            step: float = 0.1, binning: Binning | None = None) -> Boosted:
    """Gradient boosting of a 0/1 label with log loss. A round fits a
    variance tree to the residuals y - p, one aggregate a level; a row's score
    is the start (log odds) plus ``step`` times its leaf means."""
    binning = binning or exact_limits(df, features, n_bins)
    rows, bins = _binned(df.where(F.col(label).isin([0, 1])), features, binning, [F.col(label).cast("double").alias("_y")])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        import math
        first = rows.agg(F.avg("_y").alias("m")).first()["m"]
        if first is None:
            raise ValueError("no labelled row to fit on")
        share = min(max(first, 1e-6), 1 - 1e-6)
        model = Boosted([], math.log(share / (1 - share)), step, [])
        for _ in range(rounds):
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-_score(model, bins)))
            scored = rows.withColumn("_r", F.col("_y") - p)
            model.loss.append(scored.agg(F.avg(F.col("_r") * F.col("_r")).alias("l")).first()["l"])
            model.trees.append(regression_tree(scored, F.col("_r"), bins, binning, depth))
        return model
    finally:
        rows.unpersist()


def _score(model: Boosted, bins: dict[str, str]) -> Column:
    z = F.lit(float(model.start))
    for t in model.trees:
        z = z + F.lit(float(model.step)) * t.value(bins)
    return z


def predict_boosted(df: DataFrame, model: Boosted, features: Sequence[str], out: str = "score") -> DataFrame:
    """``df`` with the log-odds score."""
    bins = {f: f"_b{i}" for i, f in enumerate(features)}
    binning = model.trees[0].binning
    return df.withColumns({b: binning.bins(f) for f, b in bins.items()}).withColumn(out, _score(model, bins)).drop(*bins.values())
