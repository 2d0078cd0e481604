"""Subword token queries (M7, K4) on ``documents`` with a public byte-level
vocabulary. The oracle merges every distinct piece by recursion over ranked
pairs, in SQL, from the same file."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import subwords as sw
from kiln.operators import text as tx
from kiln.plans.q_text import _CHUNK_SQL
from kiln.plans.registry import query
from kiln.sources.io import read_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ANSWER_PREFIX = "Answer: "

# RE2 has no look-ahead: a mark before the last of several white space
# characters does what it does (the rest is a piece, the last one starts anew)
_SUBWORD_SQL = r"""
WITH RECURSIVE ranks AS (
  SELECT hex(from_base64(column0)) AS tok, column1 AS id
  FROM read_csv('VOCABULARY', delim=' ', header=false, quote='', escape='', columns={'column0': 'VARCHAR', 'column1': 'BIGINT'})),
given AS (SELECT doc_id, 'p' AS part, text AS t FROM documents UNION ALL SELECT doc_id, 'a', 'Answer: ' || source FROM documents),
cut AS (SELECT doc_id, part, regexp_extract_all(regexp_replace(t, '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g'),
          '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+') AS pieces FROM given),
used AS (SELECT doc_id, part, u.piece, u.pos FROM cut, unnest(pieces) WITH ORDINALITY AS u(piece, pos)),
merged AS (
  SELECT piece, [substr(hex(encode(piece)), 2 * i + 1, 2) FOR i IN range(strlen(piece))] AS toks FROM (SELECT DISTINCT piece FROM used)
  UNION ALL
  SELECT piece, toks[1:best.i - 1] || [toks[best.i] || toks[best.i + 1]] || toks[best.i + 2:]
  FROM (SELECT m.piece, any_value(m.toks) AS toks, min({'id': k.id, 'i': u.i}) AS best
        FROM merged m, unnest(range(1, len(m.toks))) AS u(i) JOIN ranks k ON k.tok = m.toks[u.i] || m.toks[u.i + 1]
        GROUP BY m.piece)),
final AS (SELECT piece, arg_min(toks, len(toks)) AS toks FROM merged GROUP BY piece),
named AS (SELECT piece, list(k.id ORDER BY u.i) AS ids FROM final, unnest(toks) WITH ORDINALITY AS u(tok, i) JOIN ranks k USING (tok) GROUP BY piece),
coded AS (SELECT doc_id, part, flatten(list(ids ORDER BY pos)) AS ids FROM used JOIN named USING (piece) GROUP BY doc_id, part),
docs AS (SELECT g.doc_id, g.part, CASE WHEN g.t IS NOT NULL THEN coalesce(c.ids, []) END AS ids
         FROM given g LEFT JOIN coded c ON c.doc_id = g.doc_id AND c.part = g.part)
""".replace("VOCABULARY", VOCABULARY)


def _documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return d.withColumn("answer", F.concat(F.lit(ANSWER_PREFIX), F.col("source")))


@query("subword_ids", sql=_SUBWORD_SQL + "SELECT doc_id, ids AS input_ids FROM docs WHERE part = 'p'")
def q_subword_ids(spark, sf_dir):
    """M7: every document as ids of a public subword vocabulary."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return sw.encoded(d, {"input_ids": "text"}, sw.subword_tokenizer(spark, VOCABULARY), keep=["doc_id"])


@query("subword_roundtrip", sql="""
SELECT doc_id, length(text)::BIGINT AS n_chars, md5(text) AS text_md5 FROM documents
""")
def q_subword_roundtrip(spark, sf_dir):
    """M7: ids mapped back through the vocabulary table give the text."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    ids = sw.encoded(d, {"input_ids": "text"}, sw.subword_tokenizer(spark, VOCABULARY), keep=["doc_id"])
    back = sw.decoded(ids, ["doc_id"], "input_ids", sw.read_vocabulary(spark, VOCABULARY))
    return back.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


_CHUNKS_SQL = _SUBWORD_SQL + """
, b AS (SELECT p.doc_id, p.ids AS p, a.ids AS a, len(p.ids) AS n, 512 - len(a.ids) AS budget
        FROM docs p JOIN docs a ON a.doc_id = p.doc_id AND a.part = 'a' WHERE p.part = 'p' AND p.ids IS NOT NULL AND a.ids IS NOT NULL),
s AS (SELECT *, unnest(generate_series(0, (greatest(ceil((n - budget) / (budget - 128)), 0) * (budget - 128))::BIGINT,
                                       (budget - 128)::BIGINT)) AS start FROM b WHERE budget > 128),
c AS (SELECT doc_id AS sample_id, (start // (budget - 128))::INTEGER AS chunk_index, p[start + 1 : start + budget] || a AS ids FROM s)
SELECT sample_id, chunk_index, list_resize(ids, 512, 50256) AS input_ids, len(ids)::INTEGER AS n_real,
       list_resize(ids, 512, 50256)[2:] || [-100::BIGINT] AS labels FROM c
"""


@query("subword_chunks", sql=_CHUNKS_SQL)
def q_subword_chunks(spark, sf_dir):
    """M7 + X22 + X23 + X24: subword ids cut into 512-token chunks overlapping
    by 128, the answer whole in every chunk, padded with the free id 50256,
    labels shifted left."""
    ch = tx.chunk(_documents(spark, sf_dir), "doc_id", "text", "answer",
                  tokenizer=sw.subword_tokenizer(spark, VOCABULARY), pad_id=50256)
    return ch.select("sample_id", "chunk_index", "input_ids", "n_real", "labels")


class _Plain:
    """A caller's own tokenizer: the library's token rule in Python."""

    def __call__(self, texts):
        import hashlib

        import regex
        out = []
        for t in texts:
            ids, starts, ends = [], [], []
            for m in regex.finditer(tx.TOKEN_PATTERN, t):
                ids.append(1 + int(hashlib.md5(m.group().lower().encode()).hexdigest()[:15], 16))
                starts.append(m.start())
                ends.append(m.end())
            out.append((ids, starts, ends))
        return out


@query("chunk_own_tokenizer", sql=_CHUNK_SQL + """
SELECT sample_id, chunk_index, list_resize(ids::BIGINT[], 512, 0) AS input_ids, len(ids)::INTEGER AS n_real FROM c
""")
def q_chunk_own_tokenizer(spark, sf_dir):
    """K4: ``chunk`` with a caller's tokenizer, equal to ``token_chunks``."""
    ch = tx.chunk(_documents(spark, sf_dir), "doc_id", "text", "answer", tokenizer=_Plain())
    return ch.select("sample_id", "chunk_index", "input_ids", "n_real")
