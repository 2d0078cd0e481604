"""Sequence files (S11): one sequence per file, in any format a caller can
decode, read through Spark's own file source so that every store Spark reads
is reached and files are dealt to tasks by size."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BATCH_ROWS = 10_000
HELD_BYTES = 8 << 20          # decoded rows of a file kept in memory; beyond, in the task's temp folder

#: the bytes of a file -> its rows in order, as tuples of the schema's fields
Decoder = Callable[[bytes], Iterable[tuple]]


def read_sequences(spark: SparkSession, path: str, decoder: Decoder, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files under ``path`` (a folder or a glob).

    Rows: seq_id (the file's path), pos (from 0) and the fields of ``schema``,
    in the file's order. A file that the decoder fails on, or whose rows do
    not fit the schema, has no rows: rejects lists it as (seq_id, reason).
    Spark passes over files without bytes: they are in neither. A file is
    decoded whole in one task, and only then do its rows leave: until its end
    is reached they wait as Arrow batches, beyond ``HELD_BYTES`` on disk, so a
    decoder that yields its rows needs little memory besides the file."""
    fields = (schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema).fields
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]
    taken = {"seq_id", "pos", "reason"} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"field names {sorted(taken)} are used for the sequence")
    held = spark.sparkContext.broadcast(cloudpickle.dumps(decoder))

    plain = pa.schema(list(zip(names, kinds)))

    def batch(seq: str, first: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [pa.array([seq] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), *rows.columns, pa.nulls(n, pa.string())],
            ["seq_id", "pos", *names, "reason"])

    def failed(seq: str, reason: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([seq], pa.string()), pa.nulls(1, pa.int64()), *[pa.nulls(1, k) for k in kinds], pa.array([reason], pa.string())],
            ["seq_id", "pos", *names, "reason"])

    def fill(file, rows: Iterator[tuple]) -> None:
        """The decoded rows as an Arrow stream; fails where a row does not fit."""
        with pa.ipc.new_stream(file, plain) as sink:
            while some := list(islice(rows, BATCH_ROWS)):
                wrong = next((r for r in some if len(r) != len(names)), None)
                if wrong is not None:
                    raise ValueError(f"a row of {len(wrong)} fields, not {len(names)}")
                sink.write_batch(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], schema=plain))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = cloudpickle.loads(held.value)
        for files in batches:
            for seq, content in zip(files.column("path").to_pylist(), files.column("content")):
                with tempfile.SpooledTemporaryFile(HELD_BYTES) as file:
                    try:                                   # whatever the caller's decoder raises is the file's reason
                        fill(file, iter(run(content.as_py())))
                    except Exception as e:  # noqa: BLE001
                        yield failed(seq, f"{type(e).__name__}: {e}")
                        continue
                    file.seek(0)
                    at = 0
                    for rows in pa.ipc.open_stream(file):
                        yield batch(seq, at, rows)
                        at += rows.num_rows

    spec = T.StructType([T.StructField("seq_id", T.StringType()), T.StructField("pos", T.LongType()),
                         *[T.StructField(f.name, f.dataType) for f in fields], T.StructField("reason", T.StringType())])
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInArrow(decode, spec)
    return found.where("reason is null").drop("reason"), found.where(F.col("reason").isNotNull()).select("seq_id", "reason")
