"""Skew-safe ordered scans: row position, previous-row values and running
sums within a group, without one window partition per group.

A window ``partitionBy(group).orderBy(...)`` sends a whole group to one task;
a group holding a third of all rows would then be a third of the job in a
single task. Here rows are numbered inside (group, bucket), where ``bucket``
is any expression that is non-decreasing along the order (a time range, an id
range, a hash prefix). A small per-(group, bucket) table -- row count, last
row, totals -- gives each bucket the position, the previous row and the
running sum of everything before it. Work per task is bounded by the bucket
size, not the group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import materialize


def range_bucketed(df: DataFrame, order: Sequence[Column], parts: int | None = None, out: str = "_range") -> DataFrame:
    """``df`` cut into ``parts`` ranges of the order (the session's shuffle
    partitions by default), numbered ascending in ``out``, and written out:
    a bucket for ``ordered_scan`` that fits values of any kind and spread.
    Limits come from Spark's own sample of the order's values, so ranges are
    about equal in rows when the order is total (rows that tie in all of it
    stay together)."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *order).withColumn(out, F.spark_partition_id()), "ranges")


def ordered_scan(df: DataFrame, order: Sequence[Column], bucket: Column,
                 partition_by: Sequence[str] = (), carry: Sequence[str] = (),
                 sums: Sequence[str] = (), rank_col: str = "_rank",
                 size_col: str | None = "_n") -> DataFrame:
    """Add, per row:

    * ``rank_col``: 1-based position within ``partition_by`` in ``order``;
    * ``size_col``: the group's row count (when given);
    * ``prev_<c>`` for each ``c`` in ``carry``: value of ``c`` in the previous
      row of the group (null for the first row);
    * ``cum_<s>`` for each ``s`` in ``sums``: running sum of ``s`` up to and
      including this row.

    ``order`` must be a total order within a group (end with a unique id).
    Nulls are values: a null group is a group, a null order value comes first."""
    keys = list(partition_by)
    b = df.withColumn("_b", bucket)
    w_local = Window.partitionBy(*keys, "_b").orderBy(*order)
    local = b.withColumn("_local", F.row_number().over(w_local))
    for c in carry:
        local = local.withColumn(f"_lag_{c}", F.lag(c).over(w_local))
    for s in sums:
        local = local.withColumn(
            f"_lcum_{s}", F.sum(s).over(w_local.rowsBetween(Window.unboundedPreceding, 0)))

    order_fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if carry:
        aggs.append(F.max(F.struct(*order_fields, *[F.col(c).alias(c) for c in carry]))
                    .alias("_last"))
    aggs += [F.sum(s).alias(f"_tot_{s}") for s in sums]
    per_bucket = b.groupBy(*keys, "_b").agg(*aggs)

    w_b = Window.partitionBy(*keys).orderBy("_b")
    before = w_b.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    for c in carry:
        offsets = offsets.withColumn(f"_bprev_{c}", F.lag(F.col("_last")[c]).over(w_b))
    for s in sums:
        offsets = offsets.withColumn(f"_bcum_{s}", F.sum(f"_tot_{s}").over(before))
    if size_col:
        offsets = offsets.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*keys)))
    keep = ["_off"] + [f"_bprev_{c}" for c in carry] + [f"_bcum_{s}" for s in sums]
    if size_col:
        keep.append(size_col)
    # null-safe: rows of a null group or with a null order value keep their place
    o = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_k_b"), *keep)
    on = F.col("_b").eqNullSafe(F.col("_k_b"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = local.join(o, on).drop("_k_b", *[f"_k_{k}" for k in keys])

    out = out.withColumn(rank_col, F.col("_off") + F.col("_local"))
    for c in carry:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_local") == 1, F.col(f"_bprev_{c}"))
                             .otherwise(F.col(f"_lag_{c}")))
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.coalesce(F.col(f"_bcum_{s}"), F.lit(0))
                             + F.col(f"_lcum_{s}"))
    drop = ["_b", "_local", "_off"] + [f"_lag_{c}" for c in carry] + \
        [f"_bprev_{c}" for c in carry] + [f"_lcum_{s}" for s in sums] + \
        [f"_bcum_{s}" for s in sums]
    return out.drop(*drop)
