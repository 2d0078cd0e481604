"""Sources and sinks.

Readers always take an explicit schema or read a self-describing format
(parquet), select only the needed columns right after the scan so Catalyst
prunes them in the parquet reader, and never infer schemas from data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Driver test tables (one parquet file each under a scale-factor folder).
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None, balance: bool = True) -> DataFrame:
    """Parquet scan with column pruning.

    With ``balance``, a scan that yields fewer splits than the session's
    default parallelism (a file with one row group) is spread over that many
    partitions, so per-row work after it uses every core. Planning the scan
    is metadata only; on large inputs (many row groups) nothing is added."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return rebalance(df) if balance else df


def rebalance(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than
    ``min_partitions`` (default: the session's default parallelism)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines, one ``value`` column (parse with ``split_fields``)."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, multiline: bool = True) -> DataFrame:
    """S3: CSV with header, quoted multi-line fields, explicit schema."""
    return (spark.read.option("header", header).option("multiLine", multiline)
            .option("escape", '"').option("mode", "PERMISSIVE")
            .schema(schema).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str,
              multiline: bool = False) -> DataFrame:
    """JSON records. ``multiline=True`` reads one array-of-records file;
    the default reads JSON lines, which is what ``write_json`` produces."""
    return spark.read.option("multiLine", multiline).schema(schema).json(path)


def typed_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Impose an explicit typed schema on a frame by name (try_cast, so
    a bad value becomes null rather than failing the job under ANSI mode).
    Rows with a null in a non-nullable field are left out; ``typed_rejects``
    returns them as they came, with the field at fault."""
    out = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]
    return out.dropna(subset=required) if required else out


def typed_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that ``typed_frame`` leaves out, and in ``bad_field`` the
    first required field that is null or cannot be cast."""
    bad = F.coalesce(*[F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                       for f in schema.fields if not f.nullable], F.lit(None).cast("string"))
    return df.withColumn("bad_field", bad).where(F.col("bad_field").isNotNull())


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink; ``partition_by=["split"]`` stores named splits as
    directories so a reader prunes them (S10)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON records (JSON lines, one file per task)."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Files that each hold one array of records, about ``rows_per_file``
    rows a file (rows are dealt by hash; an array is built in one task, so its
    size is the file's). ``read_json(..., multiline=True)`` reads them."""
    n = df.count()
    parts = max(1, -(-n // rows_per_file))
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    df.select(F.struct(*df.columns).alias("_r"), deal.alias("part")).groupBy("part") \
        .agg(F.to_json(F.collect_list("_r"), {"ignoreNullFields": "false"}).alias("value")) \
        .write.mode("overwrite").partitionBy("part").text(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Reload one named split; the filter prunes partition directories."""
    return spark.read.parquet(path).where(F.col("split") == F.lit(split))


def read_sequence_files(spark: SparkSession, glob: str, fmt: str = "parquet",
                        schema: T.StructType | None = None) -> DataFrame:
    """A directory glob of per-sequence files; the file path becomes the
    sequence id (``seq_id``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(glob)
    return df.withColumn("seq_id", F.col("_metadata.file_path"))


def synthetic_line(spark: SparkSession, n: int = 100, slope: float = 3.0,
                   intercept: float = 1.0, x_scale: float = 10.0,
                   noise: float = 1.0, seed: int = 42,
                   partitions: int | None = None) -> DataFrame:
    """``x ~ N(0,1)*x_scale, y = slope*x + intercept + noise*N(0,1)``,
    generated on the executors (``spark.range`` + seeded ``randn``)."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return (base.withColumn("x", F.randn(seed) * F.lit(x_scale))
            .withColumn("y", F.lit(slope) * F.col("x") + F.lit(intercept)
                        + F.randn(seed + 1) * F.lit(noise)))


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline/model for reuse."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
