"""Mixing sources to target weights.

Sources get integer word quotas that follow their weights. Each source is cut
into blocks: runs of documents that are neighbours in a seeded permutation
(equal ranges of a hash). A source's draw is a sequence of its blocks, one
epoch after another, until its quota is met; in the last, partly drawn block
documents are taken in permuted order while they fit, then the one that fills
the rest best. A splitting tree deals the exact number of blocks of every
source to output shards: at each node a multivariate hypergeometric draw
decides how many blocks of each source go left, and so on down to single
shards. Shards take disjoint runs of each source's block sequence and order
their rows by a local hash; a document is taken as often as shards' runs meet
its block, so what the tree deals is what is drawn.

Only per-source totals, the boundary blocks' sizes and the sources x shards
quota table meet on the driver; whether a row is drawn, how often and into
which shards is an expression of its own hash."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.frames import bounded_broadcast, hash60
from kiln.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)          # repeating, sources in code point order, null last
MAX_EPOCHS = 3
BLOCK_ROWS = 256                   # expected rows of a block ...
MAX_BLOCKS = 1 << 16               # ... until a source has this many
OUT_SHARDS = 16
PART_BYTES = 128 << 20             # a shard of more text is several partitions
MAX_SOURCES = 100_000              # bound of the per-source tables on the driver
SPACE = 1 << 60


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], cap: float = MAX_EPOCHS) -> list[float]:
    """Words of each source: weights share out the sum of ``sizes``, no source
    above ``cap`` times its size; the excess goes to the others by weight."""
    total = float(sum(sizes))
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (cap * sizes[i] / weights[i], i))
    left, w_left = total, float(sum(weights))
    for k, i in enumerate(order):
        if cap * sizes[i] * w_left > left * weights[i]:
            for j in order[k:]:
                out[j] = left * weights[j] / w_left
            break
        out[i] = cap * float(sizes[i])
        left -= out[i]
        w_left -= weights[i]
    return out


def split_quotas(blocks: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) matrix that deals ``blocks[s]`` blocks of each source
    to shards of (nearly) equal block counts by the splitting tree."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(blocks)), np.int64)

    def deal(first: int, end: int, quota: np.ndarray) -> None:
        if end - first == 1:
            out[first] = quota
            return
        mid = (first + end) // 2
        n = int(quota.sum()) * (mid - first) // (end - first)
        left = rng.multivariate_hypergeometric(quota, n) if n else np.zeros_like(quota)
        deal(first, mid, left)
        deal(mid, end, quota - left)

    deal(0, shards, np.asarray(blocks, np.int64))
    return out


def _plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = OUT_SHARDS,
          seed: int = 7, text: str = "text", source: str = "source", key: str = "doc_id") -> tuple[DataFrame, int]:
    """The rows of ``plan`` and the expected bytes of all drawn texts."""
    sized = docs.select(F.struct(*docs.columns).alias("_row"), F.col(source).alias("_source"),
                        word_count(F.col(text)).alias("_size"),
                        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("_bytes")) \
        .withColumn("_key", hash60(f"mix{seed}", F.col("_row")[key], F.col("_size")))
    slim = materialize(sized.select("_source", "_size", "_bytes", "_key"), "mix-sizes")
    stats = slim.groupBy("_source").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows"),
                                        F.sum("_bytes").alias("bytes")) \
        .orderBy(F.col("_source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(stats) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    spark = docs.sparkSession
    goal = targets([r.words for r in stats], [weights[i % len(weights)] for i in range(len(stats))])
    rows = []
    most = max(1, min(MAX_BLOCKS, 100_000_000 // max(1, MAX_EPOCHS * len(stats))))
    for r, t in zip(stats, goal):
        quota = int(t + 0.5)
        epochs, rest = divmod(quota, r.words) if r.words else (0, 0)
        rows.append((r["_source"], r.words, t, epochs, rest, min(most, -(-r.rows // BLOCK_ROWS))))
    schema = "_source string, _source_size long, _target double, epochs long, rest long, blocks long"
    per_source = spark.createDataFrame(rows, schema)

    def block(of: str = "_key") -> Column:      # floor(key * blocks / 2^60) without overflow
        high, low = F.shiftrightunsigned(of, 30), F.expr(f"{of} & {(1 << 30) - 1}")
        return F.shiftrightunsigned(high * F.col("blocks") + F.shiftrightunsigned(low * F.col("blocks"), 30), 30)

    def with_source(df: DataFrame, t: DataFrame) -> DataFrame:
        t = t.withColumnRenamed("_source", "_s")
        return df.join(bounded_broadcast(t, ["_s"], 64 + 8 * shards), df["_source"].eqNullSafe(t["_s"]), "left").drop("_s")

    # words per block, then the block where each source's last epoch ends
    by_block = with_source(slim, per_source).where("rest > 0").withColumn("block", block()) \
        .groupBy("_source", "rest", "blocks", "block").agg(F.sum("_size").alias("words"))
    w = Window.partitionBy("_source").orderBy("block")
    ends = by_block.withColumn("before", F.sum("words").over(w) - F.col("words")) \
        .where("before < rest and before + words >= rest") \
        .select("_source", "block", (F.col("rest") - F.col("before")).alias("need"))
    ends = ends.groupBy("_source").agg(F.min(F.struct("block", "need")).alias("e")) \
        .select("_source", F.col("e.block").alias("end_block"), F.col("e.need").alias("need"))
    ends = materialize(ends, "mix-ends")
    # inside it: documents in permuted order while they fit, then the best filler of the rest
    inside = with_source(with_source(slim, per_source), ends).withColumn("block", block()).where("block = end_block") \
        .groupBy("_source", "need", "_key").agg(F.sum("_size").alias("words"))
    w = Window.partitionBy("_source").orderBy("_key")
    inside = inside.withColumn("cum", F.sum("words").over(w))
    cut = inside.groupBy("_source", "need").agg(
        F.max(F.when(F.col("cum") <= F.col("need"), F.col("_key"))).alias("last_key"),
        F.coalesce(F.max(F.when(F.col("cum") <= F.col("need"), F.col("cum"))), F.lit(0)).alias("got"))
    left = with_source(inside.drop("need"), cut).where("cum > need").withColumn("gap", F.abs(F.col("need") - F.col("got") - F.col("words"))) \
        .where("gap < need - got").groupBy("_source").agg(F.min(F.struct("gap", "_key")).alias("m")) \
        .select("_source", F.col("m._key").alias("extra_key"))
    edges = {r["_source"]: r for r in with_source(with_source(ends, cut.select("_source", "last_key")), left).collect()}

    # block draws per source, dealt to the shards by the splitting tree
    drawn = [epochs * blocks + (edges[s].end_block + 1 if s in edges else 0)
             for s, _, _, epochs, _, blocks in rows]
    dealt = split_quotas(drawn, shards, seed).cumsum(axis=0) if rows else np.zeros((shards, 0), np.int64)
    drawn_bytes = sum(int(r.bytes * t / r.words) for r, t in zip(stats, goal) if r.words)
    full = [(s, size, t, epochs, blocks, *((e.end_block, e.last_key, e.extra_key) if (e := edges.get(s)) else (None,) * 3),
             [int(x) for x in dealt[:, i]])
            for i, (s, size, t, epochs, _, blocks) in enumerate(rows)]
    table = spark.createDataFrame(full, "_source string, _source_size long, _target double, epochs long, blocks long, "
                                        "end_block long, last_key long, extra_key long, dealt array<long>")
    out = with_source(sized, table).withColumn("_block", block())
    # boundary keys are null where a source has no partly drawn epoch or no such row
    partly = F.coalesce(
        (F.col("_block") < F.col("end_block"))
        | ((F.col("_block") == F.col("end_block"))
           & (F.coalesce(F.col("_key") <= F.col("last_key"), F.lit(False))
              | F.coalesce(F.col("_key") == F.col("extra_key"), F.lit(False)))), F.lit(False))
    times = F.when(F.col("_size") > 0, F.col("epochs") + partly.cast("long")).otherwise(F.lit(0)).cast("int")
    seq = F.slice(F.sequence(F.lit(0), F.lit(MAX_EPOCHS)), 1, times)
    # a shard's run ends where its dealt blocks do; a draw beyond the last run is nobody's
    shard = F.transform(seq, lambda e: F.size(F.filter(
        "dealt", lambda d: d <= e * F.col("blocks") + F.col("_block"))))
    return out.select("_row", "_size", "_source_size", "_target",
                      F.filter(shard, lambda s: s < shards).alias("_shards")), drawn_bytes


def plan(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: _row (its columns), _size, _source_size, _target
    and _shards: the output shard of every time it is drawn (empty: not drawn).

    A null text has no words and is never drawn; a null source is a source of
    its own, last in order. Rows that repeat key and size are drawn alike."""
    return _plan(docs, **options)[0]


def draws(docs: DataFrame, **options) -> DataFrame:
    """One row for each draw, laid out by output shard: _row (the columns of
    ``docs``), _size, _shard, _part and _local, the place of the draw in the
    shard's seeded order. A shard is cut into as many parts (ranges of _local)
    as its bytes need, each one partition, so no task grows with the input."""
    key, text, seed = options.get("key", "doc_id"), options.get("text", "text"), options.get("seed", 7)
    shards = options.get("shards", OUT_SHARDS)
    planned, drawn_bytes = _plan(docs, **options)
    parts = max(1, -(-drawn_bytes // (shards * PART_BYTES)))
    each = planned.select("_row", "_size", F.posexplode("_shards").alias("_n", "_shard")) \
        .withColumn("_local", F.xxhash64(F.lit(f"local{seed}"), F.col("_row")[key], F.col("_row")[text], F.col("_n"))) \
        .withColumn("_local", F.shiftrightunsigned("_local", 33)) \
        .withColumn("_part", F.shiftrightunsigned(F.col("_local") * F.lit(parts), 31).cast("int")) \
        .select("_row", "_size", "_shard", "_part", "_local")
    return each.repartitionById(shards * parts, F.col("_shard") * parts + F.col("_part")) \
        .sortWithinPartitions("_local", F.col("_row")[key])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: every draw of a row is a row, in output shards, each in
    a seeded local order; the columns of ``docs`` are unchanged."""
    return draws(docs, **options).select("_row.*")


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target of its source, words taken
    (its size for every shard's run that draws it)."""
    p = plan(docs.select("doc_id", "text", "source"), **options)
    return p.select("_row.doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), (F.size("_shards") * F.col("_size")).cast("long").alias("taken"))
