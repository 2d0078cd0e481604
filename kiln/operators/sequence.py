"""Sequence operators over ordered event tables.

Input: one row per note/event ``(seq_id, start, duration, pitch, tiebreak)``.
Order within a sequence is (start, tiebreak) -- a stable, total order. All
per-sequence positions, lags and running sums go through ``ordered_scan``,
so one very long sequence is spread over many (sequence, time bucket) tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.numeric import clip_max, quantise
from kiln.operators.ordered import ordered_scan

DEFAULT_BUCKET_SECONDS = 60.0  # one-minute buckets: a very long sequence is spread over many tasks
CHUNK_POSITIONS = 4096


def time_bucket(start: str = "start", seconds: float = DEFAULT_BUCKET_SECONDS) -> Column:
    """A bucket non-decreasing in ``start`` (epoch seconds)."""
    return F.floor(F.col(start) / F.lit(seconds)).cast("bigint")


def with_positions(notes: DataFrame, seq: str = "seq_id", start: str = "start",
                   tiebreak: str = "event_id", carry=(), sums=(),
                   bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Position ``pos`` (1-based) and length ``seq_len`` of every note in its
    sequence, plus optional previous-row values and running sums."""
    return ordered_scan(notes, [F.col(start), F.col(tiebreak)], time_bucket(start, bucket_seconds),
                        [seq], carry=carry, sums=sums, rank_col="pos", size_col="seq_len")


def steps(notes: DataFrame, q_step: float = 0.125, q_duration: float = 0.125,
          seq: str = "seq_id", start: str = "start", tiebreak: str = "event_id",
          bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """W1 + X12: ``step = start - previous start`` quantised half-to-even to
    ``q_step``, ``duration`` quantised to ``q_duration``; the first note of
    each sequence has no predecessor and is dropped. Keeps ``pos``."""
    p = with_positions(notes, seq, start, tiebreak, carry=[start], bucket_seconds=bucket_seconds)
    return (p.where(F.col(f"prev_{start}").isNotNull())
            .withColumn("step", quantise(F.col(start) - F.col(f"prev_{start}"), q_step))
            .withColumn("duration", quantise("duration", q_duration))
            .drop(f"prev_{start}"))


def sliding_windows(seq_rows: DataFrame, length: int, seq: str = "seq_id",
                    pos: str = "pos", fields=("pitch", "step", "duration"),
                    chunk: int = CHUNK_POSITIONS) -> DataFrame:
    """Every run of ``length + 1`` consecutive rows of a sequence, as
    (inputs = first ``length`` rows, target = the last); a sequence of n rows
    gives ``max(0, n - length)`` windows.

    Rows are cut into chunks of ``chunk`` positions; the first ``length``
    rows of each chunk are also copied to the previous chunk (a halo), so
    every window lies inside one (sequence, chunk) task of bounded size."""
    if length >= chunk:
        raise ValueError("chunk must exceed the window length")
    c = F.floor((F.col(pos) - 1) / F.lit(chunk)).cast("bigint")
    in_halo = ((F.col(pos) - 1) % F.lit(chunk)) < F.lit(length)
    rows = seq_rows.select(seq, pos, *fields).withColumn(
        "_chunk", F.explode(F.when(in_halo & (c > 0), F.array(c, c - 1)).otherwise(F.array(c))))
    w = Window.partitionBy(seq, "_chunk").orderBy(pos).rowsBetween(0, length)
    # one struct per row: a null field stays in its place
    win = rows.withColumn("_w", F.collect_list(F.struct(*fields)).over(w))
    win = win.where((F.floor((F.col(pos) - 1) / F.lit(chunk)) == F.col("_chunk")) & (F.size("_w") == length + 1))
    out = win.select(seq, F.col(pos).alias("window_start"),
                     *[F.slice(F.col("_w")[f], 1, length).alias(f"in_{f}") for f in fields],
                     *[F.element_at("_w", length + 1)[f].alias(f"target_{f}") for f in fields])
    return out


def running_time(step_rows: DataFrame, seq: str = "seq_id", order: str = "pos",
                 max_step: float | None = None, bucket_positions: int = CHUNK_POSITIONS) -> DataFrame:
    """W4 + X13: absolute ``start`` = running sum of ``step`` (each step first
    clipped to ``max_step`` when given); ``end = start + duration``."""
    s = step_rows
    if max_step is not None:
        s = s.withColumn("step", clip_max("step", max_step))
    bucket = F.floor(F.col(order) / F.lit(bucket_positions)).cast("bigint")
    out = ordered_scan(s, [F.col(order)], bucket, [seq], sums=["step"], rank_col="_r", size_col=None)
    return (out.withColumn("abs_start", F.col("cum_step"))
            .withColumn("abs_end", F.col("cum_step") + F.col("duration"))
            .drop("_r", "cum_step"))


def seed_slice(notes: DataFrame, skip: int = 25, n: int = 25, q_step: float = 0.125,
               q_duration: float = 0.125, seq: str = "seq_id", start: str = "start",
               tiebreak: str = "event_id",
               bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Notes ``skip+1 .. skip+n`` of each sequence; if the sequence has
    fewer than ``skip + n`` notes, all notes after ``skip`` (or all notes,
    when ``skip`` >= its length). Steps are taken within the slice, the first
    one being 0; step and duration are quantised."""
    p = with_positions(notes, seq, start, tiebreak, carry=[start], bucket_seconds=bucket_seconds)
    first = F.when(F.col("seq_len") >= skip + n, F.lit(skip)) \
        .otherwise(F.when(F.lit(skip) < F.col("seq_len"), F.lit(skip)).otherwise(F.lit(0)))
    last = F.when(F.col("seq_len") >= skip + n, F.lit(skip + n)).otherwise(F.col("seq_len"))
    sl = p.where((F.col("pos") > first) & (F.col("pos") <= last))
    prev = F.when(F.col("pos") == first + 1, F.col(start)).otherwise(F.col(f"prev_{start}"))
    return (sl.withColumn("step", quantise(F.col(start) - prev, q_step))
            .withColumn("duration", quantise("duration", q_duration))
            .withColumn("slice_pos", F.col("pos") - first)
            .drop(f"prev_{start}"))
