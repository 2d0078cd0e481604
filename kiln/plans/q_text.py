"""Text cleaning, prompt building and token-chunk queries (X2-X9, X22-X25,
M7, F5, W8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions.strings import (TAG_PATTERN, clean_solution, fill_template, is_present,
                                    parse_nonneg_int, strip_markup, strip_pattern)
from kiln.operators import split as sp
from kiln.operators import text as tx
from kiln.plans.registry import query
from kiln.sources.io import read_table

# Instruction template for prompt building (our own wording; ``%s`` is the
# cleaned question).
PROMPT_TEMPLATE = ("Instructions: read the problem below, solve it, then write an "
                   "\"Answer\" section with only the final answer.\n\nProblem: %s\n")
ANSWER_PREFIX = "Answer: "


@query("strip_tags", sql=r"""
SELECT page_id,
       regexp_replace(regexp_replace(html, '\n\n!\[\]\(.*?\)', '', 'g'), '<.*?>', '', 'g') AS clean,
       length(regexp_replace(regexp_replace(html, '\n\n!\[\]\(.*?\)', '', 'g'), '<.*?>', '', 'g'))::INTEGER AS n_chars
FROM pages
""")
def q_strip_tags(spark, sf_dir):
    """Remove Markdown images, then tags (non-greedy, '.' stops at newline)."""
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    c = strip_markup("html")
    return p.select("page_id", c.alias("clean"), F.length(c).alias("n_chars"))


@query("clean_answer_int", sql=r"""
WITH p AS (SELECT event_id, regexp_replace(regexp_replace(regexp_extract(props, ':([^:]*)$', 1),
                  'times 10\^\d+', '', 'g'), '[\[\]''$\\{}]', '', 'g') AS raw FROM events),
q AS (SELECT event_id, CASE WHEN regexp_matches(raw, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
                            THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v FROM p)
SELECT event_id, CASE WHEN floor(v) = v AND v >= 0 AND v < 9.2e18 THEN v::BIGINT END AS answer FROM q
""")
def q_clean_answer_int(spark, sf_dir):
    """X3 + X8: the value after the last ':' of a JSON-ish prop string, with
    ``times 10^d`` removed and bracket/dollar characters deleted, parsed as a
    non-negative integer (else null)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    raw = F.regexp_extract("props", r":([^:]*)$", 1)
    return ev.select("event_id", parse_nonneg_int(raw).alias("answer"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PROMPT_SQL = f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
pr AS (SELECT u.conv_id, u.turn, regexp_replace(u.text, '<.*?>', '', 'g') AS question,
  CASE WHEN a.text IS NOT NULL AND a.text <> '' THEN
    regexp_replace(regexp_replace(
      trim(trim(trim(trim(a.text, '['), ']'), ''''), '"'),
      '\\n\\n!\\[\\]\\(.*?\\)', '', 'g'), '<.*?>', '', 'g')
  ELSE 'NONE' END AS solution
  FROM u LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY solution ORDER BY conv_id, turn) AS rn FROM pr)
       WHERE rn = 1 AND question IS NOT NULL AND question <> ''),
r AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || conv_id::varchar || ':' || turn::varchar),
                                          conv_id::varchar || ':' || turn::varchar) AS rk,
             count(*) OVER () AS n FROM dd)
SELECT conv_id, turn, printf({_sql_str(PROMPT_TEMPLATE)}, question) AS prompt,
       {_sql_str(ANSWER_PREFIX)} || solution AS prompt_answer,
       CASE WHEN rk <= floor(0.8 * n) THEN 'train' ELSE 'val' END AS split
FROM r
"""


@query("prompt_pairs", sql=_PROMPT_SQL)
def q_prompt_pairs(spark, sf_dir):
    """X6 + X7 + X9 + X4 + F5 + W7 + W8: pair each user turn with the next
    assistant turn, or with none (equi-join on the unique (conv_id, turn) key,
    no window over a whole conversation); question = tags stripped; solution = wrapper
    characters and markup stripped, ``NONE`` when blank; keep the first pair
    per solution; drop empty questions; fill the prompt template; exact
    80/20 shuffled split."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("q"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("s"))
    pairs = u.join(a, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", strip_pattern("q", TAG_PATTERN).alias("question"),
        clean_solution("s").alias("solution"))
    pairs = pairs.withColumn("pair_id", F.concat_ws(":", F.col("conv_id").cast("string"),
                                                   F.col("turn").cast("string")))
    firsts = pairs.groupBy("solution").agg(
        F.min(F.struct("conv_id", "turn")).alias("_f")).select("_f.conv_id", "_f.turn")
    kept = pairs.join(firsts, ["conv_id", "turn"], "left_semi").where(is_present("question"))
    out = kept.select("conv_id", "turn", "pair_id",
                      fill_template(PROMPT_TEMPLATE, "question").alias("prompt"),
                      F.concat(F.lit(ANSWER_PREFIX), F.col("solution")).alias("prompt_answer"))
    return sp.exact_fraction_split(out, "pair_id", 0.8, seed=0).drop("pair_id")


_CHUNK_SQL = r"""
WITH t AS (SELECT doc_id,
  list_transform(list_transform(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\f\r ]'), lambda x: lower(x)),
                 lambda x: 1 + ('0x' || substr(md5(x), 1, 15))::BIGINT) AS p,
  list_transform(list_transform(regexp_extract_all('Answer: ' || source, '\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\f\r ]'), lambda x: lower(x)),
                 lambda x: 1 + ('0x' || substr(md5(x), 1, 15))::BIGINT) AS a
  FROM documents),
b AS (SELECT doc_id, p, a, len(p) AS n, 512 - len(a) AS budget FROM t),
s AS (SELECT doc_id, p, a, budget,
        unnest(generate_series(0, (greatest(ceil((n - budget) / (budget - 128)), 0) * (budget - 128))::BIGINT,
                               (budget - 128)::BIGINT)) AS start
      FROM b WHERE budget > 128),
c AS (SELECT doc_id AS sample_id, (start // (budget - 128))::INTEGER AS chunk_index,
             p[start + 1 : start + budget] || a AS ids FROM s)
"""


@query("token_chunks", sql=_CHUNK_SQL + """
SELECT sample_id, chunk_index, list_resize(ids::BIGINT[], 512, 0) AS input_ids, len(ids)::INTEGER AS n_real FROM c
""")
def q_token_chunks(spark, sf_dir):
    """M7 + X23 + X24: documents tokenised, hashed to ids, cut into 512-token
    chunks overlapping by 128, each with the answer appended, padded."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    ch = tx.chunk(d, "doc_id", "text", F.concat(F.lit(ANSWER_PREFIX), F.col("source")))
    return ch.select("sample_id", "chunk_index", "input_ids", "n_real")


@query("chunk_pad_mask", sql=_CHUNK_SQL + """
SELECT sample_id, chunk_index,
       list_resize(list_resize([]::TINYINT[], len(ids), 1::TINYINT), 512, 0::TINYINT) AS attention_mask
FROM c
""")
def q_chunk_pad_mask(spark, sf_dir):
    """0/1 attention mask of each padded chunk."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    ch = tx.chunk(d, "doc_id", "text", F.concat(F.lit(ANSWER_PREFIX), F.col("source")))
    return ch.select("sample_id", "chunk_index", "attention_mask")


@query("chunk_labels", sql=_CHUNK_SQL + """
, r AS (SELECT sample_id, chunk_index, list_resize(ids::BIGINT[], 512, 0) AS input_ids FROM c)
SELECT sample_id, chunk_index, input_ids[2:] || [-100::BIGINT] AS labels FROM r
""")
def q_chunk_labels(spark, sf_dir):
    """labels = input ids shifted left by one, -100 appended (pad
    positions are not masked, as in the source)."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    ch = tx.chunk(d, "doc_id", "text", F.concat(F.lit(ANSWER_PREFIX), F.col("source")))
    return ch.select("sample_id", "chunk_index", "labels")


@query("chunk_offsets", sql=r"""
WITH runs AS (SELECT doc_id, r.run, r.k FROM documents,
              unnest(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\f\r ]|[\t\n\f\r ]+')) WITH ORDINALITY AS r(run, k)),
pos AS (SELECT doc_id, k, run, sum(length(run)) OVER (PARTITION BY doc_id ORDER BY k) - length(run) AS st FROM runs),
tk AS (SELECT doc_id, list(st ORDER BY k) AS ps, list(st + length(run) ORDER BY k) AS pe
       FROM pos WHERE NOT regexp_matches(run, '^[\t\n\f\r ]+$') GROUP BY doc_id),
ans AS (SELECT doc_id, source FROM documents),
ar AS (SELECT doc_id, r.run, r.k FROM ans,
       unnest(regexp_extract_all('Answer: ' || source, '\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\f\r ]|[\t\n\f\r ]+')) WITH ORDINALITY AS r(run, k)),
apos AS (SELECT doc_id, k, run, sum(length(run)) OVER (PARTITION BY doc_id ORDER BY k) - length(run) AS st FROM ar),
atk AS (SELECT doc_id, list(st ORDER BY k) AS a_s, list(st + length(run) ORDER BY k) AS a_e, count(*) AS na
        FROM apos WHERE NOT regexp_matches(run, '^[\t\n\f\r ]+$') GROUP BY doc_id),
b AS (SELECT d.doc_id, coalesce(tk.ps, []) AS ps, coalesce(tk.pe, []) AS pe, atk.a_s, atk.a_e,
             len(coalesce(tk.ps, [])) AS n, 512 - atk.na AS budget
      FROM documents d LEFT JOIN tk USING (doc_id) JOIN atk USING (doc_id)),
s AS (SELECT *, unnest(generate_series(0, (greatest(ceil((n - budget) / (budget - 128)), 0) * (budget - 128))::BIGINT,
                               (budget - 128)::BIGINT)) AS start FROM b WHERE budget > 128)
SELECT doc_id AS sample_id, (start // (budget - 128))::INTEGER AS chunk_index,
       (ps[start + 1 : start + budget] || a_s)::BIGINT[] AS offset_start,
       (pe[start + 1 : start + budget] || a_e)::BIGINT[] AS offset_end
FROM s
""")
def q_chunk_offsets(spark, sf_dir):
    """Character [start, end) of each real token of each chunk (prompt
    offsets into the document, answer offsets into the answer string)."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    ch = tx.chunk(d, "doc_id", "text", F.concat(F.lit(ANSWER_PREFIX), F.col("source")),
                  with_spans=True)
    return ch.select("sample_id", "chunk_index", "offset_start", "offset_end")


@query("chunk_rejects", sql=r"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN NULL ELSE source END AS prompt,
                  CASE WHEN doc_id % 5 = 1 THEN NULL ELSE text END AS answer FROM documents),
r AS (SELECT doc_id AS sample_id, CASE WHEN prompt IS NULL THEN 'no prompt' WHEN answer IS NULL THEN 'no answer'
        WHEN 512 - len(regexp_extract_all(answer, 'TOKEN')) <= 128 THEN 'answer too long' END AS reason FROM t)
SELECT sample_id, reason FROM r WHERE reason IS NOT NULL
""".replace("TOKEN", tx.TOKEN_PATTERN))
def q_chunk_rejects(spark, sf_dir):
    """Documents as answers to short prompts; nulls put in by id. Every
    row is either chunked or listed here with its reason."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    prompt = F.when(F.col("doc_id") % 7 != 3, F.col("source"))
    answer = F.when(F.col("doc_id") % 5 != 1, F.col("text"))
    return tx.rejected_rows(d, "doc_id", prompt, answer)


@query("token_vocabulary", sql=r"""
SELECT 1 + ('0x' || substr(md5(token), 1, 15))::BIGINT AS id, token, count(*) AS n
FROM (SELECT lower(unnest(regexp_extract_all(text, 'TOKEN'))) AS token FROM documents) GROUP BY token
""".replace("TOKEN", tx.TOKEN_PATTERN))
def q_token_vocabulary(spark, sf_dir):
    """M7: the table that maps token ids back."""
    return tx.vocabulary(read_table(spark, sf_dir, "documents", ["text"]), "text")


@query("split_roundtrip", sql=_PROMPT_SQL.replace("FROM r\n", "FROM r WHERE rk <= floor(0.8 * n)\n", 1)
       .replace("SELECT conv_id, turn, printf", "SELECT * FROM (SELECT conv_id, turn, printf", 1)
       .rstrip() + ") AS t")
def q_split_roundtrip(spark, sf_dir):
    """S8 + S9 + S10 (+ S4): prompt pairs written as JSON records and as
    parquet partitioned by split under the shared folder; the train split
    read back with partition pruning, and the JSON copy re-read with an
    explicit schema and checked to hold the same number of rows."""
    import os

    from kiln.session import shared_path
    from kiln.sources.io import read_json, read_split, write_json, write_parquet
    pairs = q_prompt_pairs(spark, sf_dir)
    base = shared_path(spark, "prompt-splits")
    write_parquet(pairs, os.path.join(base, "parquet"), partition_by=["split"])
    write_json(pairs, os.path.join(base, "json"))
    back = read_json(spark, os.path.join(base, "json"), pairs.schema)
    if back.count() != spark.read.parquet(os.path.join(base, "parquet")).count():
        raise RuntimeError("JSON and parquet copies differ in size")
    train = read_split(spark, os.path.join(base, "parquet"), "train")
    return train.select("conv_id", "turn", "prompt", "prompt_answer", "split")


# ---- fixed value: the phrase joining a question and its context ----------
CONTEXT_JOINER = " Use the follwing information when solving: "
# ---------------------------------------------------------------------------


@query("prompt_context_intended", sql=f"""
WITH s AS (SELECT conv_id, arg_min(text, turn) AS context FROM conversations WHERE role = 'system' GROUP BY conv_id),
u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')
SELECT u.conv_id, u.turn,
  regexp_replace(regexp_replace(
    CASE WHEN s.context IS NOT NULL AND s.context <> '' THEN u.text || {_sql_str(CONTEXT_JOINER)} || s.context
         ELSE u.text END,
    '\\n\\n!\\[\\]\\(.*?\\)', '', 'g'), '<.*?>', '', 'g') AS question
FROM u LEFT JOIN s USING (conv_id)
""")
def q_prompt_context_intended(spark, sf_dir):
    """X7 (intended mode, trap 7): the question joined with its context -- the
    conversation's first system turn -- when one is present, then images and
    tags stripped from the combined text. The context table has one row per
    conversation; the join is on the conversation id."""
    from kiln.functions.strings import join_if_present
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    ctx = c.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min(F.struct("turn", "text")).alias("_s")).select("conv_id", F.col("_s.text").alias("context"))
    u = c.where(F.col("role") == "user").select("conv_id", "turn", "text")
    j = u.join(ctx, "conv_id", "left")
    return j.select("conv_id", "turn",
                    strip_markup(join_if_present("text", "context", CONTEXT_JOINER)).alias("question"))
