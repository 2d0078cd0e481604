"""Driver tables standing in for the reference's data sets.

Each function returns a lazily planned DataFrame; column pruning and the
filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.sources.io import read_table


def labelled_documents(spark: SparkSession, sf_dir: str, label: str = "toxic",
                       english_only: bool = False) -> DataFrame:
    """(doc_id, label, text, lang, source, n_chars) for labelled documents.
    The join is on the unique ``doc_id``."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    if english_only:
        docs = docs.where(F.col("lang") == "en")
    labels = read_table(spark, sf_dir, "labels", ["doc_id", label]).withColumnRenamed(label, "label")
    return docs.join(labels, "doc_id")


def note_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes stand-in: (seq_id, start, duration, pitch, event_id) from events,
    start in epoch seconds (UTC)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        F.col("user_id").alias("seq_id"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("start"),
        F.col("value").alias("duration"),
        F.col("event_type").alias("pitch"),
        "event_id")
