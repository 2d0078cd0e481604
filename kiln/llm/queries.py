"""One thin query per operator over the whole tables, and its oracle SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (langid, mixing, ordinal, phrase_index, prefix_trie, ring, runs, secrets, setsketch,
                      syncmers, toxicity, voronoi, warc)
from kiln.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# -- 1 -----------------------------------------------------------------------

OP1_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100
"""


@query("op1_warc_dictionary", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# -- 2 -----------------------------------------------------------------------

@query("op2_secret_novelty")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 3 -----------------------------------------------------------------------

@query("op3_toxicity_subword")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "labels", "doc_id", "toxic"))


# -- 4 -----------------------------------------------------------------------

@query("op4_ring_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 5 -----------------------------------------------------------------------

@query("op5_ordinal_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good."""
    grades = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        "doc_id", F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
        .alias("grade"))
    return ordinal.quality(table(spark, sf_dir, "documents", "doc_id", "text"), grades)


# -- 6 -----------------------------------------------------------------------

@query("op6_language_nb")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


# -- 7 -----------------------------------------------------------------------

OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (SELECT *, ('0x' || substr(md5('mix7|' || coalesce(doc_id::VARCHAR, '') || '|' || size), 1, 15))::BIGINT AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS words, count(*) AS n,
             [5.0::DOUBLE, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
             row_number() OVER (ORDER BY source NULLS LAST) AS i, count(*) OVER () AS n_sources FROM d GROUP BY source),
c AS (SELECT *, sum(words) OVER ()::DOUBLE - coalesce(sum(3 * words) OVER (ORDER BY 3 * words / w, i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest_words,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * words / w, i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_w, 3 * words / w AS r FROM s),
f AS (SELECT min((r, i)) AS first_free, arg_min(rest_words, (r, i)) AS free_words, arg_min(rest_w, (r, i)) AS free_w
      FROM c WHERE 3 * words * rest_w > rest_words * w),
t AS (SELECT c.source, c.words, c.n, c.n_sources,
             CASE WHEN f.first_free IS NULL OR (c.r, c.i) < f.first_free THEN 3.0::DOUBLE * c.words ELSE f.free_words * c.w / f.free_w END AS target
      FROM c CROSS JOIN f),
q AS (SELECT *, CASE WHEN words = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT // words END AS epochs,
             CASE WHEN words = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT % words END AS rest,
             least(greatest(1, least(65536, 100000000 // (3 * n_sources))), (n + 255) // 256) AS blocks FROM t),
b AS (SELECT k.*, q.words AS source_size, q.target, q.epochs, q.rest,
             ((k.key::HUGEINT * q.blocks) >> 60)::BIGINT AS block FROM k JOIN q ON k.source IS NOT DISTINCT FROM q.source),
bs AS (SELECT source, block, any_value(rest) AS rest, sum(size) AS words FROM b GROUP BY source, block),
bc AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY block) AS cum FROM bs),
e AS (SELECT source, min(block) AS end_block, arg_min(rest - cum + words, block) AS need FROM bc
      WHERE rest > 0 AND cum >= rest AND cum - words < rest GROUP BY source),
ins AS (SELECT b.source, b.key, e.need, sum(b.size) AS words FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source AND b.block = e.end_block
        GROUP BY b.source, b.key, e.need),
ic AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY key) AS cum FROM ins),
cut AS (SELECT source, need, max(key) FILTER (cum <= need) AS last_key, coalesce(max(cum) FILTER (cum <= need), 0) AS got
        FROM ic GROUP BY source, need),
ex AS (SELECT ic.source, arg_min(ic.key, (abs(ic.need - cut.got - ic.words), ic.key)) AS extra_key
       FROM ic JOIN cut ON ic.source IS NOT DISTINCT FROM cut.source
       WHERE ic.cum > ic.need AND abs(ic.need - cut.got - ic.words) < ic.need - cut.got GROUP BY ic.source)
SELECT b.doc_id, b.size, b.source_size, b.target,
       (b.size * (b.epochs + CASE WHEN b.block < e.end_block OR (b.block = e.end_block AND
          (coalesce(b.key <= cut.last_key, false) OR coalesce(b.key = ex.extra_key, false))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source
LEFT JOIN cut ON b.source IS NOT DISTINCT FROM cut.source LEFT JOIN ex ON b.source IS NOT DISTINCT FROM ex.source
"""


@query("op7_source_mix", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


# -- 8 -----------------------------------------------------------------------

OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.sh = b.sh AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT r.a, e.b FROM reach r JOIN sym e ON r.b = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
"""


@query("op8_setsketch_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 9 -----------------------------------------------------------------------

OP9_SQL = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ia AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS win FROM ia),
sizes AS (SELECT DISTINCT n FROM wins),
da AS (SELECT d.r, s.n, d.w, unnest(range(1, len(d.w) - s.n + 2)) AS p FROM dw d, sizes s WHERE len(d.w) >= s.n),
occ AS (SELECT r, p, n, array_to_string(w[p:p+n-1], ' ') AS win FROM da),
found AS (SELECT o.r, o.p, o.n, x.item_id FROM occ o JOIN wins x USING (n, win)),
hits AS (SELECT r, count(DISTINCT q) AS n_hit
         FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


@query("op9_phrase_index", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "benchmark", "item_id", "text"))
    ids = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


# -- 10 ----------------------------------------------------------------------

@query("op10_syncmer_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 11 ----------------------------------------------------------------------

OP11_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM k WHERE rank <= 5
"""


@query("op11_voronoi_knn", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.embedding_neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


# -- 12 ----------------------------------------------------------------------

OP12_SQL = r"""
WITH t AS (SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, x.role, x.text) AS xs FROM t GROUP BY conv_id),
c AS (SELECT conv_id, xs, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(
             [[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(conv_id::VARCHAR, '')])),
             lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 6 AS h FROM o),
r AS (SELECT c.conv_id, list_concat(coalesce(b.xs, [])[1:c.h], c.xs[c.h + 1:]) AS xs
      FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(xs) AS n, unnest(range(0, len(xs) + 1)) AS d, xs FROM r),
nodes AS (SELECT d, xs[1:d] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
          FROM p GROUP BY d, xs[1:d]),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY d - 1, path[1:d - 1]),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children,
                      CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.d].text) END AS saved
               FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.path = n.path),
up AS (SELECT unnest(range(0, d + 1)) AS pre, path, n_children, saved FROM full_nodes),
below AS (SELECT pre AS d, path[1:pre] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM up
          GROUP BY pre, path[1:pre])
SELECT f.conv_id, f.d AS depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN below b ON b.d = f.d AND b.path = f.path
LEFT JOIN nodes a ON f.d > 0 AND a.d = f.d - 1 AND a.path = f.path[1:f.d - 1]
"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


# -- 13 ----------------------------------------------------------------------

@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"))
