"""Connected components over a distributed edge table.

Labels start at the node itself; each round every node takes the smallest
label among itself and its neighbours, then jumps to its label's label. Labels
and edges stay distributed; each round is one written table in the shared
checkpoint folder. Hot nodes are safe: minima are pre-aggregated before the
shuffle and the joins are plain shuffle joins that AQE can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import materialize


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b",
                         max_rounds: int = 200) -> DataFrame:
    """``edges`` (src, dst, long ids; nulls and loops ignored) -> (node,
    component): every node of an edge with the smallest id it can reach."""
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    both = materialize(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-edges")
    # first round without a join: the smallest neighbour or the node itself
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "cc-labels")
    for _ in range(max_rounds):
        told = both.join(labels, both.u == labels.node).select(F.col("v").alias("node"), "label")
        low = (told.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")))
        step = materialize(low, "cc-step")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = materialize(step.join(up, "label", "left")
                             .select("node", F.coalesce("up", "label").alias("label")), "cc-labels")
        changed = jumped.select("node", F.col("label").alias("new")).join(labels, "node") \
            .where("new <> label").limit(1).count()
        labels = jumped
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
