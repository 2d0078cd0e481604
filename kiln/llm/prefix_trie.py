"""The prefix trie of conversations, from Spark SQL ROLLUPs.

Every turn gets a turn id: 112 bits of a digest of its place, role and text.
A conversation is laid out in blocks of ``BLOCK`` turns: one row per block
with the turn ids in positional columns t1 .. t8 and the node it continues
from. One ROLLUP over the positional columns, grouped by block and that node,
counts all prefixes of every length together; grouping_id() tells a prefix's
length. A node's name is its depth with the sums of the four parts of its
path's turn ids, so the node that a block continues from is a running sum:
blocks of a conversation of any length are laid out side by side, without a
loop over depths, and a conversation with a third of all turns is spread over
tasks by its blocks. A first turn that a third of all conversations share is
one group, counted in the map tasks before the shuffle.

Sums over subtrees come from a second ROLLUP. Each node is charged to its
smallest member, whose path runs through every ancestor of the node; so a
node's subtree total is the sum, over its members, of what their paths are
charged from that depth on (a running sum along each conversation), and its
leaves are the members that are smallest in a childless node.

The ids of conversations that end at a node are hashed in ascending order in
pieces of at most ``PIECE`` ids, which one task streams through the digest:
its memory does not grow with the node.

Defined results: turns are ordered by turn (null first), then role, then text
(null role and text are empty); rows without a conv_id take no part; rows are
rows, so a repeated row is a turn of its own; a conversation that is left with
no turn counts at the root; an empty table gives an empty result. Other
columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.ordered import ordered_scan
from kiln.session import materialize

BLOCK = 8
PIECE_BITS = 13         # 8192 ids a piece
PARTS = ("p1", "p2", "p3", "p4")
SLOTS = [f"t{i}" for i in range(1, BLOCK + 1)]
KEY = ["depth", *PARTS]
_EMPTY = hashlib.sha256(b"").hexdigest()


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, content, chars): every turn's place in its
    conversation, the digest of its role and text, its text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    placed = ordered_scan(turns, [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()],
                          F.shiftright("turn", 8), ["conv_id"], rank_col="pos", size_col=None)
    content = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    return placed.select("conv_id", "pos", content.alias("content"), F.length("text").cast("long").alias("chars"))


def rebuilt(conversations: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: c begins with the first h turns of
    c - c % group, h = crc32(c) % heads, then its own turns after its first h.
    Returns turns (conv_id, d from 1, content, chars) and conversations
    (conv_id, size)."""
    placed = materialize(positions(conversations), "trie-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", h) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(sizes, "base", "left") \
        .withColumn("head", F.least("h", F.coalesce("base_turns", F.lit(0)))) \
        .withColumn("size", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "base", "h", "head", "size"), "trie-conversations")
    opening = placed.where(F.col("pos") < heads).select(F.col("conv_id").alias("base"), F.col("pos").alias("d"), "content", "chars")
    opened = convs.where("head > 0").join(opening, "base").where(F.col("d") <= F.col("head"))
    rest = placed.join(convs.select("conv_id", "head", "h"), "conv_id").where(F.col("pos") > F.col("h")) \
        .withColumn("d", F.col("head") + F.col("pos") - F.col("h"))
    cols = ["conv_id", F.col("d").cast("long").alias("d"), "content", "chars"]
    return opened.select(*cols).unionByName(rest.select(*cols)), convs.select("conv_id", F.col("size").cast("long").alias("size"))


def _turn_ids(turns: DataFrame) -> DataFrame:
    """Adds the four parts of every turn's id and their sums up to it."""
    digest = F.md5(F.concat("content", F.lit(":"), F.col("d").cast("string")).cast("binary"))
    for i, p in enumerate(PARTS):
        turns = turns.withColumn(p, F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("long"))
    return ordered_scan(turns.drop("content"), [F.col("d").asc()], F.shiftright("d", 8), ["conv_id"],
                        sums=PARTS, rank_col="_place", size_col=None).drop("_place")


def _blocks(turns: DataFrame, convs: DataFrame, *more: Column) -> DataFrame:
    """One row per conversation and block: the node it continues from, the
    positional turn ids, and further aggregates. Turnless conversations have
    one block without turns."""
    slot = (F.col("d") - 1) % BLOCK
    cells = [F.max(F.when(slot == i, F.struct(*PARTS))).alias(t) for i, t in enumerate(SLOTS)]
    prior = [F.max(F.when(slot == 0, F.col(f"cum_{p}") - F.col(p))).alias(f"from_{p}") for p in PARTS]
    rows = turns.groupBy("conv_id", F.shiftright((F.col("d") - 1), 3).alias("block")).agg(*prior, *cells, *more)
    bare = convs.where("size = 0").select("conv_id", F.lit(0).cast("long").alias("block"),
                                          *[F.lit(0).cast("long").alias(f"from_{p}") for p in PARTS])
    return rows.unionByName(bare, allowMissingColumns=True)


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of all blocks in one ROLLUP: (depth, node name, name of
    the parent, level, aggregates)."""
    prior = ", ".join(f"from_{p}" for p in PARTS)
    grouped = rows.sparkSession.sql(
        f"SELECT block, {prior}, {', '.join(SLOTS)}, grouping_id() AS gid, {aggregates} "
        f"FROM {{rows}} GROUP BY block, {prior}, ROLLUP({', '.join(SLOTS)})", rows=rows)
    level = F.lit(BLOCK) - F.bit_count("gid")
    last = F.element_at(F.array(*SLOTS), F.greatest(level, F.lit(1)))
    nodes = grouped.withColumn("level", level).withColumn("last", F.when(level > 0, last)) \
        .where(((F.col("level") == 0) & (F.col("block") == 0)) | F.col("last").isNotNull())
    names = []
    for p in PARTS:
        name = F.col(f"from_{p}")
        for t in SLOTS:                                     # rolled-up columns are null
            name = name + F.coalesce(F.col(t)[p], F.lit(0))
        names.append(name)
    return nodes.select((F.col("block") * BLOCK + F.col("level")).cast("long").alias("depth"),
                        *[n.alias(p) for n, p in zip(names, PARTS)],
                        *[(n - F.coalesce(F.col("last")[p], F.lit(0))).alias(f"up_{p}") for n, p in zip(names, PARTS)],
                        "level", *[c for c in grouped.columns if c not in {"block", "gid", *SLOTS, *[f"from_{p}" for p in PARTS]}])


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that end at a node."""
    last = turns.join(convs.where("size > 0").withColumnRenamed("size", "d"), ["conv_id", "d"]) \
        .select("conv_id", F.col("d").alias("depth"), *[F.col(f"cum_{p}").alias(p) for p in PARTS])
    bare = convs.where("size = 0").select("conv_id", *[F.lit(0).cast("long").alias(k) for k in KEY])
    pieces = last.unionByName(bare).groupBy(*KEY, F.shiftright("conv_id", PIECE_BITS).alias("piece")) \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in [*KEY, "ids"]]):
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(*node, digest.hexdigest())])

    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids") \
        .mapInArrow(stream, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * (len(KEY) + 1)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:-1]] + [pa.array(cols[-1], pa.string())],
                                      [*KEY, "ends_sha256"])


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, d from 1 without gaps,
    content, chars); ``convs`` (conv_id, size) also names conversations
    without turns. Per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = materialize(_turn_ids(turns), "trie-ids")
    up = [f"up_{p}" for p in PARTS]
    nodes = materialize(_rollup(_blocks(turns, convs), "count(*) AS n_convs, min(conv_id) AS conv_id"), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(u).alias(p) for u, p in zip(up, PARTS)]) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "trie-children")

    # what each conversation's path is charged for, from every depth on
    shared = nodes.where("n_convs > 1 and depth > 0").select("conv_id", F.col("depth").alias("d"), (F.col("n_convs") - 1).alias("again"))
    leaves = nodes.where("n_children = 0").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    charged = turns.join(shared, ["conv_id", "d"], "left") \
        .withColumn("charge", F.coalesce(F.col("again") * F.col("chars"), F.lit(0)))
    charged = ordered_scan(charged, [F.col("d").asc()], F.shiftright("d", 8), ["conv_id"], sums=["charge"],
                           rank_col="_place", size_col=None)
    totals = charged.groupBy("conv_id").agg(F.sum("charge").alias("total"))
    charged = charged.join(totals, "conv_id").withColumn("onward", F.col("total") - F.col("cum_charge") + F.col("charge"))
    slot = (F.col("d") - 1) % BLOCK
    onward = [F.max(F.when(slot == i, F.col("onward"))).alias(f"w{i + 1}") for i in range(BLOCK)]
    rows = _blocks(charged, convs, F.max("total").alias("w0"), *onward).join(leaves, "conv_id", "left")
    sums = ", ".join(f"sum(w{i}) AS w{i}" for i in range(BLOCK + 1))
    below = _rollup(rows, f"{sums}, sum(leaf) AS n_leaves")
    saved = F.element_at(F.array(*[f"w{i}" for i in range(BLOCK + 1)]), F.col("level") + 1)
    below = below.select(*KEY, F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce(saved, F.lit(0)).alias("saved_tokens"))

    root = nodes.where("depth = 0").agg(F.min("conv_id").alias("c")).first()["c"]
    parents = nodes.where("n_children > 0 and depth > 0").select(
        (F.col("depth") + 1).alias("depth"), *[F.col(p).alias(u) for u, p in zip(up, PARTS)], F.col("conv_id").alias("above"))
    out = nodes.join(below, KEY).join(_ends(turns, convs), KEY, "left").join(parents, ["depth", *up], "left")
    parent = F.when(F.col("depth") == 1, F.lit(root).cast("long")).otherwise(F.col("above"))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (``rebuilt``)."""
    return trie(*rebuilt(conversations))
