"""Queries over the smaller operators: filters, scalars, recoding, sources."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import functions as F

from kiln.functions import numeric as num
from kiln.operators import clean as cl
from kiln.operators import split as sp
from kiln.operators import stats as st
from kiln.plans.registry import query
from kiln.session import shared_path
from kiln.sources import io
from kiln.sources.io import read_table


@query("filter_counts", sql="""
WITH e AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS v FROM events),
x AS (SELECT count(*) FILTER (v IS NULL) AS dropped, count(v) AS kept,
  count(*) FILTER (event_type = 'click') AS equal, count(*) FILTER (lower(trim(event_type)) IN ('click', 'view')) AS listed,
  count(*) FILTER (props <> '') AS present, count(*) FILTER (v > 0) AS positive,
  count(*) FILTER (event_id % 5 = 2) AS bucket, count(*) FILTER (v > 50 AND event_type = 'click') AS correct,
  count(*) FILTER (v > 50 AND event_type <> 'click') AS wrong FROM e)
SELECT name, n FROM x UNPIVOT (n FOR name IN (dropped, kept, equal, listed, present, positive, bucket, correct, wrong))
""")
def q_filter_counts(spark, sf_dir):
    """F1-F8: rows that each filter keeps (or, for ``dropped``, would drop)."""
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value", "props"]) \
        .withColumn("v", F.when(F.col("event_id") % 11 != 0, F.col("value")))
    high = cl.where_positive(e.withColumn("over", F.col("v") - 50), "over") \
        .withColumn("said", F.lit("click"))
    right, wrong = cl.split_by_correct(high, "event_type", "said")
    parts = {"kept": cl.drop_nulls(e, ["v"]), "equal": cl.where_equal(e, "event_type", "click"),
             "listed": cl.where_in_normalised(e, "event_type", ["click", "view"]), "present": cl.where_present(e, "props"),
             "positive": cl.where_positive(e, "v"), "bucket": cl.where_bucket(e, "event_id", 5, 2),
             "correct": right, "wrong": wrong}
    counts = [d.select(F.lit(k).alias("name"), F.lit(1).alias("one")).groupBy("name").agg(F.count("one").alias("n"))
              for k, d in parts.items()]
    dropped = e.agg(cl.count_null_rows(e, ["v"])).select(F.lit("dropped").alias("name"), F.col("dropped").alias("n"))
    return reduce(lambda a, b: a.unionByName(b), [dropped, *counts])


@query("numeric_scalars", sql="""
SELECT l_orderkey, l_linenumber, round((l_quantity - 25.0) / 14.0, 9) AS z, l_quantity AS back,
       round(CASE WHEN l_discount > 0 AND l_extendedprice > 0 THEN ln(l_extendedprice / l_discount) END, 9) AS log_ratio,
       round_even(l_quantity / 2, 0)::BIGINT AS half, greatest(l_discount, 1e-12) AS floored
FROM lineitem
""")
def q_numeric_scalars(spark, sf_dir):
    """X10, X13, X14 and its inverse, X27."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    z = num.zscore("l_quantity", F.lit(25.0), num.floor_std(F.lit(14.0)))
    return li.select("l_orderkey", "l_linenumber", F.round(z, 9).alias("z"),
                     F.round(num.inverse_zscore(z, F.lit(25.0), F.lit(14.0)), 9).alias("back"),
                     F.round(num.safe_log_ratio("l_extendedprice", "l_discount"), 9).alias("log_ratio"),
                     num.nearest_int(F.col("l_quantity") / 2).alias("half"),
                     num.floor_std("l_discount").alias("floored"))


@query("binarise_numeric", sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS big FROM lineitem
""")
def q_binarise_numeric(spark, sf_dir):
    """No row holds the text value, so the numeric reading decides."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount"]) \
        .withColumn("l_discount", F.col("l_discount").cast("string"))
    return cl.binarise(li, "l_discount", "yes", "big", 0.05).select("l_orderkey", "l_linenumber", "big")


@query("batches_in_order", sql="""
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 64 AS batch_id FROM orders
""")
def q_batches_in_order(spark, sf_dir):
    """Fixed batches in id order (validation and test)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return sp.fixed_batches(o, "o_orderkey", 64, shuffle=False)


@query("sequence_files", sql="""
SELECT event_type AS seq, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY event_type
""")
def q_sequence_files(spark, sf_dir):
    """One folder of files per sequence, read back by a glob; the file's
    path tells the sequence."""
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    base = shared_path(spark, "sequences")
    io.write_parquet(e, base, partition_by=["event_type"])
    back = io.read_sequence_files(spark, os.path.join(base, "*"))
    seq = F.regexp_extract("seq_id", r"event_type=([^/]+)/", 1)
    return back.groupBy(seq.alias("seq")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


def _event_lines(content: bytes):
    """One "event_id,value" a line, read line by line."""
    import io
    for line in io.TextIOWrapper(io.BytesIO(content), "utf-8", newline="\n"):
        line = line.rstrip("\n")
        event_id, comma, value = line.partition(",")
        if not comma:
            raise ValueError(f"not event_id,value: {line}")
        yield int(event_id), float(value)


@query("sequence_decode", sql="""
WITH bad AS (SELECT min(event_type) AS seq FROM events)
SELECT event_type AS seq, CASE WHEN event_type = bad.seq THEN 0 ELSE count(*) END AS n,
       CASE WHEN event_type = bad.seq THEN NULL ELSE round(sum(value), 6) END AS total,
       CASE WHEN event_type = bad.seq THEN 'ValueError: not event_id,value: broken' END AS reason
FROM events, bad GROUP BY event_type, bad.seq
""")
def q_sequence_decode(spark, sf_dir):
    """A text file per sequence, decoded by a caller's function; one file
    has a line that cannot be read and is listed with the reason."""
    from kiln.sources.sequences import read_sequences
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    lines = e.select(F.col("event_type").alias("seq"), F.concat_ws(",", "event_id", "value").alias("value"))
    bad = e.agg(F.min("event_type").alias("seq")).select("seq", F.lit("broken").alias("value"))
    base = shared_path(spark, "sequence-text")
    lines.unionByName(bad).repartition("seq").write.partitionBy("seq").text(base)
    rows, rejects = read_sequences(spark, base, _event_lines, "event_id long, value double")
    seq = F.regexp_extract("seq_id", r"seq=([^/]+)/", 1).alias("seq")
    read = rows.groupBy(seq).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")) \
        .withColumn("reason", F.lit(None).cast("string"))
    failed = rejects.select(seq, F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("total"), "reason")
    return read.unionByName(failed)


@query("csv_multiline_roundtrip", sql="""
SELECT conv_id, turn, text || chr(10) || '"' || role || '", ' AS body FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL
""")
def q_csv_multiline(spark, sf_dir):
    """S3: text with quotes, commas and line ends through CSV and back."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]) \
        .where("text is not null and role is not null") \
        .select("conv_id", "turn", F.concat("text", F.lit('\n"'), "role", F.lit('", ')).alias("body"))
    base = shared_path(spark, "csv-multiline")
    c.write.option("header", True).option("escape", '"').option("quoteAll", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base)
    return io.read_csv(spark, base, c.schema)


@query("json_array_records", sql="""
SELECT n_nationkey, n_name FROM nation
""")
def q_json_array(spark, sf_dir):
    """A file that holds one array of records."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    base = shared_path(spark, "json-array")
    io.write_json_arrays(n, base)
    return io.read_json(spark, base, n.schema, multiline=True).select("n_nationkey", "n_name")


@query("json_array_files", sql="""
SELECT o_orderkey, o_custkey, o_comment_or_null FROM (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_comment_or_null FROM orders)
""")
def q_json_array_files(spark, sf_dir):
    """S4 + S8: records in many files of one array each, nulls included."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]).select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("o_comment_or_null"))
    base = shared_path(spark, "json-arrays")
    io.write_json_arrays(o, base, rows_per_file=5000)
    return io.read_json(spark, base, o.schema, multiline=True).select(*o.columns)


@query("json_copy", sql="SELECT conv_id, turn, role, text FROM conversations")
def q_json_copy(spark, sf_dir):
    """JSON records hold what was written: every field read back."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    base = shared_path(spark, "json-copy")
    io.write_json(c, base)
    return io.read_json(spark, base, c.schema)


@query("map_lookup", sql="""
WITH m AS (SELECT source, lang, count(*) AS n FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang),
keys AS (SELECT DISTINCT source FROM m), langs AS (SELECT unnest(['en', 'fr', 'xx']) AS lang)
SELECT k.source, l.lang, coalesce(m.n, 0) AS n FROM keys k CROSS JOIN langs l LEFT JOIN m ON m.source = k.source AND m.lang = l.lang
""")
def q_map_lookup(spark, sf_dir):
    """A7 + X26: documents per language as one map a source, looked up with a
    default for languages that are not there."""
    from kiln.functions.arrays import get_with_default
    d = read_table(spark, sf_dir, "documents", ["source", "lang"]).where("source is not null and lang is not null")
    maps = st.group_to_map(st.count_by(d, ["source", "lang"]), "source", "lang", "n")
    return maps.select("source", "m", F.explode(F.array(*[F.lit(x) for x in ("en", "fr", "xx")])).alias("lang")) \
        .select("source", "lang", get_with_default("m", "lang", 0).alias("n"))


@query("keyed_totals", sql="""
SELECT source, sum(n_chars)::BIGINT AS total, count(DISTINCT lang) AS n_langs FROM documents GROUP BY source
""")
def q_keyed_totals(spark, sf_dir):
    """A2 + A4: sums by (source, language), then by source alone."""
    d = read_table(spark, sf_dir, "documents", ["source", "lang", "n_chars"])
    fine = st.keyed_sum(d, ["source", "lang"], "n_chars")
    langs = fine.groupBy("source").agg(F.count("lang").alias("n_langs"))
    both = st.reaggregate(fine, ["source"], "total").join(langs.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return both.select("source", "total", "n_langs")


@query("feature_vectors", sql="""
WITH x AS (SELECT doc_id, n_chars::DOUBLE AS a, len(string_split(text, ' '))::DOUBLE AS b, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS e, lang
           FROM documents),
m AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM x),
f AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS ix FROM documents GROUP BY lang),
k AS (SELECT count(*) AS levels FROM f)
SELECT x.doc_id, list_transform([(a - ma) / sa, (b - mb) / sb, e], lambda v: round(v, 6))
       || list_transform(range(0, k.levels + 1), lambda j: CASE WHEN j = f.ix THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS features
FROM x JOIN f USING (lang), m, k
""")
def q_feature_vectors(spark, sf_dir):
    """M1, M2, M5, P10: numbers standardised, flag and one-hot levels in one
    vector; the numeric features are all columns but the reserved ones."""
    from pyspark.ml.functions import vector_to_array

    from kiln.operators.features import FeatureSpec, feature_names, feature_pipeline
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"]).select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", " ")).cast("double").alias("n_words"),
        (F.col("lang") == "en").cast("double").alias("is_en"), "lang")
    spec = FeatureSpec("doc_id", numeric=feature_names(d, ("doc_id", "lang", "is_en")), binary=("is_en",), categorical=("lang",))
    out = feature_pipeline(spec, scale_numeric=True).fit(d).transform(d)
    return out.select("doc_id", F.transform(vector_to_array("features"), lambda v: F.round(v, 6)).alias("features"))


@query("typed_rejects", sql="""
SELECT event_id, 'number' AS bad_field FROM events WHERE event_id % 3 <> 0
""")
def q_typed_rejects(spark, sf_dir):
    """Rows that a typed schema cannot take, with the field at fault."""
    from pyspark.sql import types as T
    e = read_table(spark, sf_dir, "events", ["event_id"]).withColumn(
        "number", F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 3 == 1, F.lit("x")))
    schema = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("number", T.LongType(), False)])
    return io.typed_rejects(e, schema).select("event_id", "bad_field")


@query("model_roundtrip", sql="""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders),
f AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority)::INTEGER AS slot FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, round((o_totalprice - m) / sd, 6) AS z, slot FROM orders JOIN f USING (o_orderpriority), s
""")
def q_model_roundtrip(spark, sf_dir):
    """A fitted pipeline saved and loaded: what the loaded one gives."""
    from pyspark.ml.functions import vector_to_array

    from kiln.operators.features import FeatureSpec, feature_pipeline
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority"])
    model = feature_pipeline(FeatureSpec("o_orderkey", numeric=("o_totalprice",), categorical=("o_orderpriority",)),
                             scale_numeric=True).fit(o)
    path = shared_path(spark, "pipeline")
    io.save_model(model, path)
    v = io.load_pipeline_model(path).transform(o).select("o_orderkey", vector_to_array("features").alias("v"))
    slot = F.array_position(F.slice("v", 2, F.size("v") - 1), 1.0).cast("int")
    return v.select("o_orderkey", F.round(F.get("v", F.lit(0)), 6).alias("z"), slot.alias("slot"))
