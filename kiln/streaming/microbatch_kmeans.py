"""Micro-batch k-means on Structured Streaming.

* T1 ``write_microbatches``: rows ranked by id once; row number r goes to
  batch ``r mod n``; batches are written one after another, so file times
  follow batch order, and every row keeps its batch number.
* T2/T3/T4 ``run``: ``readStream`` over those files, one batch per trigger.
  In ``foreachBatch`` the batch is assigned to the current centroids and
  aggregated per cluster, and the state table (k rows) is joined to that
  aggregate: one expression gives the new centroid and weight of present and
  absent clusters alike. Empty batches are skipped; the first other batch
  supplies the start centroids (its smallest salted id hashes).
* The state after batch b is the parquet folder ``state/b=<b>`` in the shared
  checkpoint folder and batch b reads folder b - 1 back from there, so a
  replayed batch writes the same state again. Per-batch cluster counts (T4),
  before the batch's update, are ``counts/b=<b>``.
* T5: the caller scores the whole table with the final centroids.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators import kmeans as km
from kiln.operators.split import id_rank, sample_k
from kiln.session import materialize, shared_path

STATE = "cluster int, centroid array<double>, weight double"


def write_microbatches(df: DataFrame, id_col: str, n_batches: int, path: str,
                       rows_per_file: int = 1_000_000) -> int:
    """T1 (W2 + F7): dense position in id order, ``batch`` = position mod n,
    written to ``path/<batch>`` in batch order, about ``rows_per_file`` rows a
    file, each file by its own task. Returns the files per batch, which ``run``
    must read together."""
    at = F.pmod(F.col("_rank") - 1, F.lit(n_batches)).cast("int")
    ranked = materialize(id_rank(df, id_col, size_col=None).withColumn("batch", at).drop("_rank"), "ranked")
    files = max(1, -(-ranked.count() // (n_batches * rows_per_file)))
    for i in range(n_batches):
        ranked.where(F.col("batch") == i).repartition(files) \
            .write.mode("overwrite").parquet(os.path.join(path, f"{i:05d}"))
    return files


@dataclass
class StreamResult:
    state_path: str
    counts_path: str


def decayed(state: DataFrame, stats: DataFrame, alpha: float) -> DataFrame:
    """``state`` (cluster, centroid, weight) after a batch with ``stats``
    (cluster, n, centroid = mean). The kept weight is ``alpha * weight``; a
    cluster moves to the weighted mean of its centroid and the batch's, which
    for one without rows (n = 0) is where it was."""
    seen = stats.select("cluster", F.col("n").cast("double").alias("_n"), F.col("centroid").alias("_mean"))
    kept, n = F.col("weight") * F.lit(float(alpha)), F.coalesce("_n", F.lit(0.0))
    pull = n / (kept + n)
    moved = F.zip_with("centroid", "_mean", lambda c, m: c + (m - c) * pull)
    return state.join(F.broadcast(seen), "cluster", "left") \
        .select("cluster", F.when(n > 0, moved).otherwise(F.col("centroid")).alias("centroid"),
                (kept + n).alias("weight"))


def _state_before(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame | None:
    """The latest state of a batch before ``batch_id``; None when there is
    none yet. Any other read error is raised."""
    try:
        states = spark.read.schema(f"{STATE}, b int").parquet(state_path).where(F.col("b") < batch_id)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = states.agg(F.max("b")).first()[0]
    return None if last is None else states.where(F.col("b") == last).drop("b")


def run(spark: SparkSession, batches_path: str, schema: T.StructType, vec: str, id_col: str, k: int,
        alpha: float = 1.0, seed: int = 0, files_per_batch: int = 1,
        work_dir: str | None = None) -> StreamResult:
    """Run the streaming update over every batch available now.
    ``schema`` is that of the rows without their batch number."""
    base = work_dir or shared_path(spark, "microbatch-kmeans")
    state_path, counts_path = os.path.join(base, "state"), os.path.join(base, "counts")

    def update(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():                       # T3: skip an empty batch
            return
        if batch.select("batch").distinct().limit(2).count() > 1:
            raise ValueError("a micro-batch mixes batches: write as many files per batch as it reads")
        state = _state_before(spark, state_path, batch_id)
        if state is None:                         # T3: start from this batch
            start = km.collect_vectors(sample_k(batch, id_col, k, seed), vec, k)
            state = spark.createDataFrame([(j, c, 0.0) for j, c in enumerate(start)], STATE)
        cents = [list(r["centroid"]) for r in state.orderBy("cluster").collect()]      # k rows
        stats = materialize(km.cluster_stats(batch, vec, cents, len(cents[0])), "batch-stats")
        decayed(state, stats, alpha).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(state_path, f"b={batch_id}"))
        state.select("cluster").join(stats.select("cluster", "n"), "cluster", "left") \
            .select(F.lit(int(batch_id)).cast("long").alias("batch_id"), "cluster",
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(counts_path, f"b={batch_id}"))

    stream = spark.readStream.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])) \
        .option("maxFilesPerTrigger", files_per_batch).parquet(os.path.join(batches_path, "*"))
    q = stream.writeStream.foreachBatch(update) \
        .option("checkpointLocation", os.path.join(base, "stream-checkpoint")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return StreamResult(state_path=state_path, counts_path=counts_path)


def final_state(spark: SparkSession, result: StreamResult) -> DataFrame:
    """The k-row state after the last batch."""
    state = _state_before(spark, result.state_path, 1 << 30)
    return state if state is not None else spark.createDataFrame([], STATE)


def batch_counts(spark: SparkSession, result: StreamResult) -> DataFrame:
    """T4: per batch and cluster, rows assigned (before that batch's update)."""
    return spark.read.parquet(result.counts_path).drop("b")
