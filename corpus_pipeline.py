"""The corpus pipeline: documents through five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns what it keeps, which is
written as Parquet and read again as the next stage's documents. All stages
but the last keep the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import mixing, phrase_index, ring, setsketch, toxicity
from kiln.llm.frames import fresh_name, table
from kiln.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    name = fresh_name(docs, "_toxic")
    return toxicity.score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return setsketch.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return phrase_index.uncontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every draw of a document is a row."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ring.shard_documents(docs)


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_near_copies),
          ("benchmark_decontamination", drop_contaminated), ("mixing_sources", mix_sources),
          ("sharding", shard)]

# A learnt model and random block draws decide on rows: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
