"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20


def table(spark, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null id: empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def hash60(seed: str, *cols: Column) -> Column:
    """60 uniform bits from md5 of the seed and the columns as text."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def bounded_broadcast(df: DataFrame, text_cols: Sequence[str] = (), row_bytes: int = 64,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size is under the bound;
    otherwise leave the choice (a shuffle join) to the optimiser."""
    size = F.lit(row_bytes)
    for c in text_cols:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    total = df.agg(F.sum(size).alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= max_bytes else df


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` picked by a hash key (all, when there
    are fewer): the same rows at every run and for every partitioning."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(key < F.lit(int(rows / n * (1 << 60))))


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
