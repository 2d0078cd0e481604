"""Splits, sampling, quotas and positional operators (G1-G4, G7, G8, W2,
W6-W12, U2).

Randomness is a salted md5 of the row id, so every result is reproducible,
independent of partitioning, and expressible in SQL. Global row positions
never sort everything into one task: rows are ranked inside order-preserving
buckets (a prefix of the hash, or an id range) and shifted by a small table
of per-bucket offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.ordered import ordered_scan, range_bucketed
from kiln.session import materialize

# 16**5 = 1,048,576 order-preserving buckets of the hash: about a million rows
# per window task at 10**12 rows, while the per-bucket offsets table (at most
# that many rows of three numbers) stays small.
HEX_BUCKET_CHARS = 5
ID_BUCKETS = 1 << 20


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash_hex(id_col: Column | str, seed: int | None = None) -> Column:
    """md5 hex of the id (salted by prefixing ``seed:``)."""
    s = _c(id_col).cast("string")
    if seed is not None:
        s = F.concat(F.lit(f"{seed}:"), s)
    return F.md5(s)


def hash_bucket(id_col: Column | str, n: int, seed: int | None = None) -> Column:
    """First 32 bits of the (salted) md5, modulo ``n``."""
    h = F.conv(F.substring(hash_hex(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n))


def hash_split(df: DataFrame, id_col: str, train_fraction: float = 0.8,
               seed: int | None = None, out: str = "split") -> DataFrame:
    """G1: ``train`` when the id's 32-bit hash is below that fraction of its
    range, whatever the fraction. Stable under repartitioning; sizes are
    binomial, not exact."""
    cut = F.lit(round(train_fraction * (1 << 32)))
    return df.withColumn(out, F.when(hash_bucket(id_col, 1 << 32, seed) < cut, F.lit("train"))
                         .otherwise(F.lit("test")))


def global_rank(df: DataFrame, order: Sequence[Column], bucket: Column,
                partition_by: Sequence[str] = (), rank_col: str = "_rank",
                size_col: str | None = "_n") -> DataFrame:
    """1-based position of each row within ``partition_by`` in ``order``;
    ``bucket`` must be non-decreasing along ``order`` (see ``ordered_scan``:
    a hot group is spread over many buckets, never one task)."""
    return ordered_scan(df, order, bucket, partition_by, rank_col=rank_col, size_col=size_col)


def hash_rank(df: DataFrame, id_col: str, seed: int | None = None,
              partition_by: Sequence[str] = (), rank_col: str = "_rank",
              size_col: str | None = "_n") -> DataFrame:
    """Position in the (salted) hash order: a reproducible shuffle."""
    d = df.withColumn("_h", hash_hex(id_col, seed))
    out = global_rank(d, [F.col("_h"), F.col(id_col)], F.substring("_h", 1, HEX_BUCKET_CHARS),
                      partition_by, rank_col, size_col)
    return out.drop("_h")


# quantiles that cut the ids into segments, closer together at both ends
_ID_QUANTILES = (1e-4, 1e-3, 1e-2, *(i / 32 for i in range(1, 32)), 0.99, 0.999, 0.9999)


def id_range_bucket(df: DataFrame, id_col: str, buckets: int = ID_BUCKETS) -> Column:
    """An id-range bucket, non-decreasing in the id. Ids are cut at their
    quantiles (one aggregate) and each segment into ranges of equal width, so a
    few stray ids stretch only the outermost segment. Null ids: null."""
    lo, hi, q = df.agg(F.min(id_col), F.max(id_col), F.percentile_approx(id_col, list(_ID_QUANTILES), 10_000)).first()
    if lo is None:
        return F.lit(0)
    edges = sorted({int(lo), int(hi) + 1, *(int(x) for x in q)})
    per = max(1, buckets // len(edges))
    widths = [max(1, -(-(b - a) // per)) for a, b in zip(edges[:-1], edges[1:])]
    c = F.col(id_col).cast("bigint")
    longs = lambda v: F.array(*[F.lit(x).cast("bigint") for x in v])
    segment = F.size(F.filter(longs(edges[1:-1]), lambda e: e <= c)) if len(edges) > 2 else F.lit(0)
    inside = F.floor((c - F.get(longs(edges), segment)) / F.get(longs(widths), segment))
    return F.when(c.isNotNull(), (segment * F.lit(per) + F.least(inside, F.lit(per - 1))).cast("bigint"))


def id_rank(df: DataFrame, id_col: str, partition_by: Sequence[str] = (),
            rank_col: str = "_rank", size_col: str | None = "_n",
            buckets: int = ID_BUCKETS) -> DataFrame:
    """Position in id order (``zipWithIndex`` / ``reset_index``)."""
    return global_rank(df, [F.col(id_col)], id_range_bucket(df, id_col, buckets),
                       partition_by, rank_col, size_col)


def exact_fraction_split(df: DataFrame, id_col: str, train_fraction: float = 0.8,
                         seed: int | None = 0, out: str = "split",
                         validation_first: bool = False) -> DataFrame:
    """Shuffle (salted hash order), first ``floor(f*n)`` rows are train.
    G8 (``validation_first``): ``floor(f*n)`` validation rows, rest train."""
    r = hash_rank(df, id_col, seed)
    cut = F.floor(F.lit(train_fraction) * F.col("_n"))
    first, second = ("val", "train") if validation_first else ("train", "val")
    return r.withColumn(out, F.when(F.col("_rank") <= cut, F.lit(first)).otherwise(F.lit(second))) \
        .drop("_rank", "_n")


def stratified_split(df: DataFrame, id_col: str, label: str, train_fraction: float = 0.7,
                     seed: int | None = 0, out: str = "split") -> DataFrame:
    """Per label, the first ``floor(f*n_label)`` rows in hash order are
    train -- exact per-class sizes (``sampleBy`` is only approximate)."""
    r = hash_rank(df, id_col, seed, partition_by=[label])
    cut = F.floor(F.lit(train_fraction) * F.col("_n"))
    return r.withColumn(out, F.when(F.col("_rank") <= cut, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_rank", "_n")


def percent_split(df: DataFrame, id_col: str, first_fraction: float = 0.7,
                  out: str = "split") -> DataFrame:
    """Contiguous split in id order, first ``floor(f*n)`` rows first."""
    r = id_rank(df, id_col)
    cut = F.floor(F.lit(first_fraction) * F.col("_n"))
    return r.withColumn(out, F.when(F.col("_rank") <= cut, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_rank", "_n")


def fixed_batches(df: DataFrame, id_col: str, batch_size: int, seed: int | None = 0,
                  shuffle: bool = True, out: str = "batch_id") -> DataFrame:
    """``batch_id = (position - 1) div batch_size`` over the shuffled
    (hash) order, or over id order when ``shuffle`` is off (val/test)."""
    r = hash_rank(df, id_col, seed, size_col=None) if shuffle else id_rank(df, id_col, size_col=None)
    return r.withColumn(out, F.floor((F.col("_rank") - 1) / F.lit(batch_size)).cast("bigint")) \
        .drop("_rank")


def first_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                      n: int) -> DataFrame:
    """The first ``n`` rows per group. ``row_number() <= n`` is planned
    with a per-task group limit before the shuffle, so a hot group sends at
    most ``n`` rows per task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sample_k(df: DataFrame, id_col: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows without replacement, seeded: the k smallest salted
    hashes (a top-k: each task keeps k, the driver merges k per task)."""
    return (df.withColumn("_h", hash_hex(id_col, seed))
            .orderBy("_h", id_col).limit(k).drop("_h"))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Per key (nulls equal), keep the row with the smallest id.

    The keys themselves are not shuffled: a 256-bit digest stands for them.
    The first id per digest is a partial aggregate, so a key repeated a
    billion times costs one row per task; only (id, digest) rows of repeated
    digests meet their first id, in a plain join that AQE can split on a hot
    digest. The ids to drop are written to the shared folder and removed by an
    anti join on the unique id."""
    digest = F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).cast("binary"), 256)
    hashed = df.select(id_col, digest.alias("_h"))
    firsts = materialize(hashed.groupBy("_h").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_c"))
                         .where(F.col("_c") > 1).drop("_c"), "dedup-firsts")
    drop = materialize(hashed.join(firsts, "_h").where(F.col(id_col) != F.col("_first")).select(id_col), "dedup-drop")
    return df.join(drop, id_col, "left_anti")


def largest_remainder(counts: DataFrame, key: str, n_col: str, total: int,
                      out: str = "quota") -> DataFrame:
    """Apportion ``total`` over groups in proportion to ``n_col``:
    floor of the exact share, then one more for the largest remainders (ties
    to the smaller key). The groups may be as many as the rows: the sums are
    single numbers and the remainders are ranked by ranges, not in one task."""
    counts = materialize(counts, "quota-counts")
    whole = counts.agg(F.sum(n_col).alias("s")).first()["s"]
    if not whole:
        return counts.withColumn(out, F.lit(None).cast("bigint"))
    exact = F.col(n_col) / F.lit(whole) * F.lit(total)
    t = counts.withColumn("_exp", exact).withColumn("_base", F.floor("_exp").cast("bigint")) \
        .withColumn("_down", F.col("_base") - F.col("_exp"))          # ascending: largest remainder first
    rest = total - (t.agg(F.sum("_base").alias("b")).first()["b"] or 0)
    order = [F.col("_down").asc(), F.col(key).asc()]
    r = ordered_scan(range_bucketed(t, order), order, F.col("_range"), rank_col="_rk", size_col=None)
    return r.withColumn(out, F.col("_base") + F.when(F.col("_rk") <= rest, 1).otherwise(0)) \
        .drop("_exp", "_base", "_down", "_rk", "_range")
