"""Distributed statistics.

Every aggregate is a hash aggregate with a partial (map-side) phase, so a
hot key -- one word, class or cluster holding a third of all rows -- is
reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.numeric import STD_FLOOR
from kiln.functions.strings import WORD_GAP
from kiln.functions.strings import words as word_array
from kiln.session import materialize


def word_count(df: DataFrame, text_col: str = "text", pattern: str = WORD_GAP,
               word_col: str = "word") -> DataFrame:
    """A1: map (explode words) -> group -> reduce (count)."""
    return (df.select(F.explode(word_array(text_col, pattern)).alias(word_col))
            .groupBy(word_col).agg(F.count(F.lit(1)).alias("n")))


def keyed_sum(df: DataFrame, keys: Sequence[str], value: str,
              out: str = "total") -> DataFrame:
    """A2: keyed sum (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Row count per key (long-form cross tab for two keys)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def reaggregate(df: DataFrame, keys: Sequence[str], value: str,
                out: str = "total") -> DataFrame:
    """A4: sum an aggregate up to a coarser key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def frequency_table(df: DataFrame, key: str) -> DataFrame:
    """A10: counts and shares per key; the counts are written once, their total
    is one number."""
    counts = materialize(count_by(df, [key]), "frequencies")
    total = counts.agg(F.sum("n").alias("t")).first()["t"]
    return counts.withColumn("share", F.col("n") / F.lit(total))


def group_to_map(df: DataFrame, key: str, map_key: str, map_value: str,
                 out: str = "m") -> DataFrame:
    """Per key, a map ``map_key -> map_value``. Use only where a group's
    distinct map keys are few (e.g. labels per cluster after counting)."""
    return df.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(map_key, map_value))).alias(out))


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
            ddof: int = 0, floor: float | None = STD_FLOOR) -> DataFrame:
    """Mean and standard deviation per column, globally or per
    group. ``ddof=0`` population (pandas ``std(ddof=0)``), ``ddof=1`` sample.
    Standard deviations are floored at ``floor`` when given."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c) if ddof == 0 else F.stddev_samp(c)
        if floor is not None:
            sd = F.greatest(sd, F.lit(floor))
        aggs += [F.avg(c).alias(f"{c}_mean"), sd.alias(f"{c}_std")]
    return df.groupBy(*by).agg(*aggs)


def array_moments(df: DataFrame, col: str, d: int, ddof: int = 1) -> DataFrame:
    """Per-dimension mean and std of the first ``d`` elements of an array
    column, as two arrays in one row. One pass, no explode: ``2*d`` aggregate
    expressions, each with a partial phase."""
    a = F.col(col)
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    return df.agg(
        F.array(*[F.avg(a[j].cast("double")) for j in range(d)]).alias("mean"),
        F.array(*[sd(a[j].cast("double")) for j in range(d)]).alias("std"),
        F.count(F.lit(1)).alias("n"),
    )


def fit_scalars(stats: DataFrame) -> dict:
    """Collect a one-row statistics table (bounded: one row) to the driver so
    it can be applied as literals (J6) -- the same role as a broadcast of a
    few numbers."""
    rows = stats.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one statistics row")
    return rows[0].asDict()


def zscore_columns(df: DataFrame, cols: Sequence[str], params: dict,
                   suffix: str = "") -> DataFrame:
    """X14 with global parameters from ``fit_scalars(moments(...))``."""
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(params[f"{c}_mean"]))
                             / F.lit(params[f"{c}_std"]))
    return out


def zscore_by_group(df: DataFrame, cols: Sequence[str], by: Sequence[str],
                    stats: DataFrame | None = None, ddof: int = 0,
                    suffix: str = "_z", broadcast_limit: int = 100_000) -> DataFrame:
    """A11 + X14 per group: join per-group moments on the group key. The stats
    table has one row per group; it is broadcast only when its row count is
    checked to be small, else it is a shuffle join (AQE may still switch)."""
    st = stats if stats is not None else moments(df, cols, by, ddof=ddof)
    st = checked_broadcast(st, broadcast_limit)
    joined = df.join(st, list(by), "left")
    for c in cols:
        joined = joined.withColumn(c + suffix, (F.col(c) - F.col(f"{c}_mean"))
                                   / F.col(f"{c}_std"))
    return joined.drop(*[f"{c}_{s}" for c in cols for s in ("mean", "std")])


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a table only after checking its row count is within
    ``max_rows``; otherwise return it unchanged for a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def expand_grid(base: DataFrame, values: dict[str, Sequence]) -> DataFrame:
    """Attach every combination of a few literal key values (e.g. the class
    labels) to each row of ``base`` by exploding a literal array -- a
    generator, not a join, so nothing but ``base`` is read or shuffled."""
    out = base
    for name, vals in values.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out


def zero_filled_grid(counts: DataFrame, base: DataFrame, values: dict[str, Sequence],
                     value: str, default=0) -> DataFrame:
    """Left-join an aggregate onto the full key grid -- ``base`` (a
    distinct-key table, e.g. feature indices) times literal key values (e.g.
    class labels) -- and give missing cells ``default``."""
    keys = list(base.columns) + list(values)
    grid = expand_grid(base, values)
    return (grid.join(counts, keys, "left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(default))))


def purity(crosstab: DataFrame, cluster: str = "cluster", n: str = "n") -> DataFrame:
    """Per cluster, largest label count over the cluster total."""
    return crosstab.groupBy(cluster).agg(
        F.sum(n).alias("size"),
        F.when(F.sum(n) > 0, F.max(n) / F.sum(n)).otherwise(F.lit(0.0)).alias("purity"))


def ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """Exact one-variable least squares in one pass."""
    return df.agg(F.regr_slope(y, x).alias("slope"),
                  F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"),
                  F.regr_count(y, x).alias("n"))


def lookup_recode(df: DataFrame, col: str, mapping: dict, out: str,
                  keep_missing: bool = False) -> Column | DataFrame:
    """Dictionary recode with a literal map (the map is a parameter, so its
    size is fixed by the caller). Missing key -> null, or the key itself."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, F.col(col))
    if keep_missing:
        v = F.coalesce(v, F.col(col).cast("string"))
    return df.withColumn(out, v)
