"""Cleaning, recoding, scaling, splitting and sequence queries
(P1-P8, F1-F5, X1-X14, J4, J6, G1-G3, G7, G8, W1-W11, U1, U2, A10, A11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions.strings import parse_nonneg_int, split_fields, trim_lower
from kiln.operators import sequence as seq
from kiln.operators import split as sp
from kiln.operators import stats as st
from kiln.operators.clean import drop_nulls, union_sources
from kiln.plans.datasets import note_events
from kiln.plans.registry import query
from kiln.sources.io import read_table

# ---- P1 / X1 / P8 -----------------------------------------------------------


@query("parse_delimited", sql="""
WITH l AS (SELECT concat_ws(',', event_id::varchar, user_id::varchar, value::varchar, event_type) AS line
           FROM events),
p AS (SELECT TRY_CAST(string_split(line, ',')[1] AS DOUBLE) AS f_event_id,
             TRY_CAST(string_split(line, ',')[2] AS DOUBLE) AS f_user_id,
             TRY_CAST(string_split(line, ',')[3] AS DOUBLE) AS f_value,
             TRY_CAST(string_split(line, ',')[4] AS DOUBLE) AS f_type,
             TRY_CAST(string_split(line, ',')[5] AS DOUBLE) AS f_missing FROM l)
SELECT * FROM p WHERE f_event_id IS NOT NULL AND f_value IS NOT NULL
""")
def q_parse_delimited(spark, sf_dir):
    """A delimited text line split into typed fields; a non-numeric field and
    a missing field become null (no ANSI error), then F2 drops rows with a
    null id or value."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "value", "event_type"])
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                       F.col("value").cast("string"), F.col("event_type")).alias("line")
    parsed = ev.select(line).select(*split_fields(
        "line", ",", ["f_event_id", "f_user_id", "f_value", "f_type", "f_missing"]))
    return drop_nulls(parsed, ["f_event_id", "f_value"])


# ---- P5 / P6 / J4 / F4 / X5 ------------------------------------------------------

@query("recode_case", sql="""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE ELSE NULL END AS status_code
FROM orders
""")
def q_recode_case(spark, sf_dir):
    """P5: CASE recode of a label, unknown values to null."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    code = F.when(F.col("o_orderstatus") == "F", F.lit(0.0)) \
        .when(F.col("o_orderstatus") == "O", F.lit(1.0)).otherwise(F.lit(None).cast("double"))
    return o.withColumn("status_code", code)


SEGMENT_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3}


@query("recode_map", sql="""
SELECT c.c_custkey,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
            WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 END AS seg_code,
       coalesce(n.n_name, c.c_nationkey::varchar) AS nation
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_recode_map(spark, sf_dir):
    """P6 + J4: dictionary recode string -> int (missing key -> null), and
    int -> name through a dimension table (missing key -> keep the key). The
    dimension is broadcast after checking its size."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    c = st.lookup_recode(c, "c_mktsegment", SEGMENT_CODES, "seg_code")
    joined = c.join(st.checked_broadcast(n, 100_000), c.c_nationkey == n.n_nationkey, "left")
    return joined.select("c_custkey", F.col("seg_code").cast("int").alias("seg_code"),
                         F.coalesce("n_name", F.col("c_nationkey").cast("string")).alias("nation"))


@query("in_list_filter", sql="""
SELECT c_custkey, lower(trim(c_mktsegment)) AS segment FROM customer
WHERE lower(trim(c_mktsegment)) IN ('building', 'machinery')
""")
def q_in_list_filter(spark, sf_dir):
    """F4 + X5: IN-list filter after trim + lower."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    seg = trim_lower("c_mktsegment")
    return c.where(seg.isin("building", "machinery")).select("c_custkey", seg.alias("segment"))


@query("dropna_subset", sql="""
WITH p AS (SELECT page_id,
  regexp_replace(regexp_replace(regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1),
                 'times 10\\^\\d+', '', 'g'), '[\\[\\]''$\\\\{}]', '', 'g') AS raw FROM pages),
q AS (SELECT page_id,
  CASE WHEN regexp_matches(raw, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
       THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v FROM p)
SELECT page_id, v::BIGINT AS answer FROM q
WHERE floor(v) = v AND v >= 0 AND v < 9.2e18
""")
def q_dropna_subset(spark, sf_dir):
    """X8 + F2: parse the last URL path segment as a non-negative integer
    (null when it is not one), then drop rows with a null answer."""
    p = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    seg = F.regexp_extract("url", r"/([^/?#]*)([?#].*)?$", 1)
    return drop_nulls(p.select("page_id", parse_nonneg_int(seg).alias("answer")), ["answer"])


# ---- G3 / A11 / X14 --------------------------------------------------------------

@query("zscore_train_stats", sql="""
WITH s AS (SELECT o_orderkey, o_totalprice,
  CASE WHEN ('0x' || substr(md5('0:' || o_orderkey::varchar), 1, 8))::ubigint < 3006477107
       THEN 'train' ELSE 'test' END AS split FROM orders),
m AS (SELECT avg(o_totalprice) AS mu, greatest(stddev_pop(o_totalprice), 1e-12) AS sd
      FROM s WHERE split = 'train')
SELECT o_orderkey, split, round((o_totalprice - mu) / sd, 6) AS z_totalprice FROM s, m
""")
def q_zscore_train_stats(spark, sf_dir):
    """Leak-free scaling -- mean and population std from the train split
    only, applied to both splits (parameters: one row, collected)."""
    o = sp.hash_split(read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]),
                      "o_orderkey", 0.7, seed=0)
    params = st.fit_scalars(st.moments(o.where("split = 'train'"), ["o_totalprice"], ddof=0))
    z = st.zscore_columns(o, ["o_totalprice"], params, suffix="_z")
    return z.select("o_orderkey", "split", F.round("o_totalprice_z", 6).alias("z_totalprice"))


@query("zscore_per_group", sql="""
WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mq, greatest(stddev_pop(l_quantity), 1e-12) AS sq,
                  avg(l_extendedprice) AS mp, greatest(stddev_pop(l_extendedprice), 1e-12) AS spp
           FROM lineitem GROUP BY l_returnflag)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag,
       round((l.l_quantity - m.mq) / m.sq, 6) AS z_qty,
       round((l.l_extendedprice - m.mp) / m.spp, 6) AS z_price
FROM lineitem l JOIN m USING (l_returnflag)
""")
def q_zscore_per_group(spark, sf_dir):
    """A11 + X14 per group: population std floored at 1e-12, joined back on the
    group key (broadcast after a size check)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"])
    z = st.zscore_by_group(li, ["l_quantity", "l_extendedprice"], ["l_returnflag"], ddof=0)
    return z.select("l_orderkey", "l_linenumber", "l_returnflag",
                    F.round("l_quantity_z", 6).alias("z_qty"),
                    F.round("l_extendedprice_z", 6).alias("z_price"))


# ---- G1 / G2 / W8 / W10 / W11 / W6 / G7 -------------------------------------------

_HASH = "('0x' || substr(md5('{seed}:' || {col}::varchar), 1, 8))::ubigint"


@query("hash_split_counts", sql=f"""
SELECT CASE WHEN {_HASH.format(seed=42, col='o_orderkey')} < 3435973837 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n
FROM orders GROUP BY 1
""")
def q_hash_split_counts(spark, sf_dir):
    """G1: 80/20 split on a salted hash of the key; sizes per split."""
    o = sp.hash_split(read_table(spark, sf_dir, "orders", ["o_orderkey"]), "o_orderkey", 0.8, seed=42)
    return st.count_by(o, ["split"])


@query("stratified_split", sql="""
WITH r AS (SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('0:' || o_orderkey::varchar), o_orderkey) AS rk,
  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rk <= floor(0.7 * n) THEN 'train' ELSE 'test' END AS split
FROM r
""")
def q_stratified_split(spark, sf_dir):
    """Exact 70/30 split within each class, reproducible hash order."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    return sp.stratified_split(o, "o_orderkey", "o_orderstatus", 0.7, seed=0) \
        .select("o_orderkey", "o_orderstatus", "split")


@query("exact_shuffle_split", sql="""
WITH r AS (SELECT o_orderkey,
  row_number() OVER (ORDER BY md5('0:' || o_orderkey::varchar), o_orderkey) AS rk,
  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rk <= floor(0.8 * n) THEN 'train' ELSE 'val' END AS split FROM r
""")
def q_exact_shuffle_split(spark, sf_dir):
    """Shuffle then cut at ``int(0.8 n)`` -- exact sizes."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return sp.exact_fraction_split(o, "o_orderkey", 0.8, seed=0).select("o_orderkey", "split")


@query("validation_fraction_split", sql="""
WITH r AS (SELECT event_id,
  row_number() OVER (ORDER BY md5('7:' || event_id::varchar), event_id) AS rk,
  count(*) OVER () AS n FROM events)
SELECT CASE WHEN rk <= floor(0.2 * n) THEN 'val' ELSE 'train' END AS split, count(*) AS n
FROM r GROUP BY 1
""")
def q_validation_fraction_split(spark, sf_dir):
    """``floor(0.2 n)`` validation rows, the rest train."""
    ev = read_table(spark, sf_dir, "events", ["event_id"])
    s = sp.exact_fraction_split(ev, "event_id", 0.2, seed=7, validation_first=True)
    return st.count_by(s, ["split"])


@query("percent_split", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rk, count(*) OVER () AS n
           FROM orders)
SELECT o_orderkey, CASE WHEN rk <= floor(0.7 * n) THEN 'train' ELSE 'test' END AS split FROM r
""")
def q_percent_split(spark, sf_dir):
    """Contiguous 70% / 30% split in key order."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return sp.percent_split(o, "o_orderkey", 0.7).select("o_orderkey", "split")


@query("fixed_batches", sql="""
SELECT o_orderkey,
       ((row_number() OVER (ORDER BY md5('0:' || o_orderkey::varchar), o_orderkey) - 1) // 64)::BIGINT AS batch_id
FROM orders
""")
def q_fixed_batches(spark, sf_dir):
    """Shuffled fixed-size batches of 64."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return sp.fixed_batches(o, "o_orderkey", 64, seed=0).select("o_orderkey", "batch_id")


@query("row_positions", sql="""
SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx,
       (row_number() OVER (ORDER BY event_id) - 1) % 5 AS batch
FROM events
""")
def q_row_positions(spark, sf_dir):
    """W2 + F7: dense 0-based row index in key order (``zipWithIndex``), and the
    interleaved micro-batch it falls in (``idx % 5``)."""
    ev = read_table(spark, sf_dir, "events", ["event_id"])
    r = sp.id_rank(ev, "event_id", size_col=None)
    return r.select("event_id", (F.col("_rank") - 1).alias("idx"),
                    F.pmod(F.col("_rank") - 1, F.lit(5)).alias("batch"))


@query("largest_remainder_quota", sql="""
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT *, n / sum(n) OVER () AS share, n / sum(n) OVER () * 100000 AS ex FROM c),
b AS (SELECT *, floor(ex)::BIGINT AS base, ex - floor(ex) AS frac FROM e),
r AS (SELECT *, 100000 - sum(base) OVER () AS rem,
             row_number() OVER (ORDER BY frac DESC, o_orderpriority) AS rk FROM b)
SELECT o_orderpriority, n, round(share, 9) AS share,
       base + CASE WHEN rk <= rem THEN 1 ELSE 0 END AS quota FROM r
""")
def q_largest_remainder_quota(spark, sf_dir):
    """A10 + W6 + G7: class shares and 100,000 synthetic rows apportioned to
    the classes by largest remainder (the quotas sum to exactly 100,000)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"])
    freq = st.frequency_table(o, "o_orderpriority")
    q = sp.largest_remainder(freq, "o_orderpriority", "n", 100_000)
    return q.select("o_orderpriority", "n", F.round("share", 9).alias("share"), "quota")


# ---- W7 / U2 / U1 ---------------------------------------------------------------

@query("dedup_keep_first", sql="""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
                    FROM documents) WHERE rn = 1
""")
def q_dedup_keep_first(spark, sf_dir):
    """Keep the first document (smallest id) of each exact text."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return sp.dedup_keep_first(d, ["text"], "doc_id").select("doc_id")


@query("union_sources", sql="""
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
""")
def q_union_sources(spark, sf_dir):
    """Union by name of per-source pieces, tagged with the source."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    names = ["party_key", "name", "nationkey", "acctbal"]
    return union_sources({"customer": c.toDF(*names), "supplier": s.toDF(*names)})


# ---- W1 / X12 / W3 / W4 / W5 ---------------------------------------------------------

_NOTES_SQL = """
WITH n AS (SELECT user_id AS seq_id, epoch_us(ts) / 1e6 AS start, value AS duration,
                  event_type AS pitch, event_id FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY start, event_id) AS pos,
             count(*) OVER (PARTITION BY seq_id) AS seq_len,
             lag(start) OVER (PARTITION BY seq_id ORDER BY start, event_id) AS prev_start FROM n),
st AS (SELECT seq_id, pos, pitch, round_even((start - prev_start) / 0.125, 0) * 0.125 AS step,
              round_even(duration / 0.125, 0) * 0.125 AS duration
       FROM p WHERE prev_start IS NOT NULL)
"""


@query("seq_steps_quantised", sql=_NOTES_SQL + """
SELECT seq_id, pos, pitch, step, duration FROM st
""")
def q_seq_steps(spark, sf_dir):
    """W1 + X12 + O2: per sequence in (start, id) order, step to the previous
    note and duration, both quantised half-to-even to 1/8; first note dropped."""
    s = seq.steps(note_events(spark, sf_dir))
    return s.select("seq_id", "pos", "pitch", "step", "duration")


@query("seq_sliding_windows", sql=_NOTES_SQL + """
, w AS (SELECT seq_id, pos AS window_start,
   list(pitch) OVER win AS wp, list(step) OVER win AS ws, list(duration) OVER win AS wd
   FROM st WINDOW win AS (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 25 FOLLOWING))
SELECT seq_id, window_start, wp[1:25] AS in_pitch, ws[1:25] AS in_step, wd[1:25] AS in_duration,
       wp[26] AS target_pitch, ws[26] AS target_step, wd[26] AS target_duration
FROM w WHERE len(wp) = 26
""")
def q_seq_sliding_windows(spark, sf_dir):
    """Windows of 25 input notes + 1 target note over the quantised steps."""
    s = seq.steps(note_events(spark, sf_dir))
    return seq.sliding_windows(s, 25)


@query("seq_running_time", sql=_NOTES_SQL + """
SELECT seq_id, pos,
       round(sum(least(step, 1.0)) OVER (PARTITION BY seq_id ORDER BY pos), 6) AS abs_start,
       round(sum(least(step, 1.0)) OVER (PARTITION BY seq_id ORDER BY pos) + duration, 6) AS abs_end
FROM st
""")
def q_seq_running_time(spark, sf_dir):
    """W4 + X13: steps (clipped at 1.0, the max silence) back to absolute
    start and end times by running sum."""
    s = seq.steps(note_events(spark, sf_dir))
    r = seq.running_time(s, max_step=1.0)
    return r.select("seq_id", "pos", F.round("abs_start", 6).alias("abs_start"),
                    F.round("abs_end", 6).alias("abs_end"))


@query("seq_seed_slice", sql="""
WITH n AS (SELECT user_id AS seq_id, epoch_us(ts) / 1e6 AS start, value AS duration,
                  event_type AS pitch, event_id FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY start, event_id) AS pos,
             count(*) OVER (PARTITION BY seq_id) AS seq_len,
             lag(start) OVER (PARTITION BY seq_id ORDER BY start, event_id) AS prev_start FROM n),
b AS (SELECT *, CASE WHEN seq_len >= 50 THEN 25 WHEN 25 < seq_len THEN 25 ELSE 0 END AS first_pos,
             CASE WHEN seq_len >= 50 THEN 50 ELSE seq_len END AS last_pos FROM p)
SELECT seq_id, pos - first_pos AS slice_pos, pitch,
       round_even((start - CASE WHEN pos = first_pos + 1 THEN start ELSE prev_start END) / 0.125, 0) * 0.125 AS step,
       round_even(duration / 0.125, 0) * 0.125 AS duration
FROM b WHERE pos > first_pos AND pos <= last_pos
""")
def q_seq_seed_slice(spark, sf_dir):
    """Notes 26..50 of each sequence (fewer when the sequence is short),
    steps within the slice starting at 0."""
    s = seq.seed_slice(note_events(spark, sf_dir), skip=25, n=25)
    return s.select("seq_id", "slice_pos", "pitch", "step", "duration")


@query("binarise_flag", sql="""
SELECT doc_id, CASE WHEN lower(trim(lang)) = 'en' THEN 1 ELSE 0 END AS is_en FROM documents
""")
def q_binarise_flag(spark, sf_dir):
    """``trim(lower(x)) == 'en'`` as 0/1 (numeric fallback when no row of
    the column holds the text value)."""
    from kiln.operators.clean import binarise
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang"])
    return binarise(d, "lang", "en", "is_en").select("doc_id", "is_en")


@query("csv_lines_roundtrip", sql="""
SELECT event_id, user_id, event_type, value, event_id AS line_event_id, value AS line_value FROM events
""")
def q_csv_lines_roundtrip(spark, sf_dir):
    """S7 + S3 + S2 + P1: events written as CSV with a header under the shared
    folder, read back twice -- as CSV with an explicit schema, and as raw text
    lines split and typed by position (the header line parses to nulls and
    is dropped) -- and joined on the id."""
    import os

    from kiln.session import shared_path
    from kiln.sources.io import read_csv, read_lines
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    path = os.path.join(shared_path(spark, "events-csv"), "csv")
    ev.write.mode("overwrite").option("header", True).csv(path)
    typed = read_csv(spark, path, "event_id bigint, user_id bigint, event_type string, value double",
                     multiline=False)
    lines = read_lines(spark, path).select(*split_fields(
        "value", ",", ["line_event_id", "line_user_id", "line_type", "line_value"]))
    lines = drop_nulls(lines, ["line_event_id"]).select(
        F.col("line_event_id").cast("bigint").alias("line_event_id"), "line_value")
    return typed.join(lines, typed.event_id == lines.line_event_id)
