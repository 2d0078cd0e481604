"""Text -> training sequences.

Tokens are runs of letters, runs of digits and single symbols, lower-cased;
only white space is left out. A token's id is a 60-bit hash of the token (0 is
padding): no vocabulary join, so frequent tokens never make a skewed shuffle,
and the ids are the same on every engine that has md5. ``vocabulary`` gives
the table that maps ids back and fails if two tokens ever shared one.

Chunking follows a pair-encoding tokenizer with ``truncation="only_first"``
and overflow: the first sequence (prompt) is cut into windows of ``budget =
max_len - len(answer) - specials`` tokens overlapping by ``overlap`` tokens;
every chunk carries the whole second sequence (answer) and is padded to
``max_len``. Everything is array expressions inside the row plus one
``posexplode`` of the chunk starts -- no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.arrays import attention_mask, chunk_starts, pad_to, shift_left
from kiln.operators.subwords import SLICE_BYTES, Tokenizer, encoded, slices, text_bytes

TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\f\r ]"
PAD_ID = 0


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text: Column | str) -> Column:
    """M7: lower-cased tokens."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), 0), lambda t: F.lower(t))


def token_id(tok: Column) -> Column:
    """Hash id from 1 (60 bits of md5)."""
    return F.conv(F.substring(F.md5(tok), 1, 15), 16, 10).cast("bigint") + F.lit(1).cast("bigint")


def token_ids(text: Column | str) -> Column:
    return F.transform(tokens(text), token_id)


def vocabulary(df: DataFrame, text: Column | str) -> DataFrame:
    """(id, token, n): every token with its id and count. Two tokens with one
    id fail the job."""
    seen = df.select(F.explode(tokens(text)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    by_id = seen.withColumn("id", token_id(F.col("token"))).groupBy("id").agg(
        F.min("token").alias("token"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("_c"))
    one = F.when(F.col("_c") > 1, F.raise_error(F.lit("two tokens share an id")).cast("string")).otherwise(F.col("token"))
    return by_id.select("id", one.alias("token"), "n")


def chunk(df: DataFrame, id_col: str, prompt: Column | str, answer: Column | str,
          max_len: int = 512, overlap: int = 128, specials: int = 0,
          with_spans: bool = False, tokenizer: Tokenizer | None = None, pad_id: int = PAD_ID) -> DataFrame:
    """X23 + X24 + X22: one output row per chunk with ``sample_id`` (X25, the
    source row), ``chunk_index``, ``input_ids`` (padded), ``attention_mask``
    (tinyint), ``labels`` (ids shifted left, -100 appended) and ``n_real``.
    Rows with a null prompt or answer, and rows whose answer leaves no more
    than ``overlap`` tokens of budget, have no chunks: ``rejected_rows`` lists
    them with the reason. ``tokenizer`` replaces the token rule of this module
    by a caller's own (K4, see ``subwords.encoded``)."""
    given = df.where(_c(prompt).isNotNull() & _c(answer).isNotNull())
    # ids and spans once per row, before the chunks are unfolded
    if tokenizer is not None:
        texts = given.select(F.col(id_col).alias("sample_id"), _c(prompt).alias("_pt"), _c(answer).alias("_at"))
        base = encoded(texts, {"_p": "_pt", "_a": "_at"}, tokenizer, spans=with_spans, keep=["sample_id"]) \
            .withColumnsRenamed({"_p_spans": "_ps", "_a_spans": "_as"})
    else:
        base = given.select(F.col(id_col).alias("sample_id"), token_ids(prompt).alias("_p"), token_ids(answer).alias("_a"),
                            *([token_spans(_c(prompt)).alias("_ps"), token_spans(_c(answer)).alias("_as")]
                              if with_spans else []))
    budget = F.lit(max_len - specials) - F.size("_a")
    starts = chunk_starts(F.size("_p"), budget, overlap)
    ex = base.select("*", budget.alias("_budget"),
                     F.posexplode(starts).alias("chunk_index", "_start"))
    body = F.concat(F.slice("_p", F.col("_start") + 1, F.col("_budget")), F.col("_a"))
    out = (ex.withColumn("_ids", body)
           .withColumn("n_real", F.size("_ids"))
           .withColumn("input_ids", pad_to("_ids", max_len, F.lit(pad_id).cast("bigint")))
           .withColumn("attention_mask", attention_mask("_ids", max_len))
           .withColumn("labels", shift_left("input_ids")))
    keep = ["sample_id", "chunk_index", "input_ids", "attention_mask", "labels", "n_real"]
    if with_spans:
        n_p = F.least(F.col("_budget"), F.size("_p") - F.col("_start"))
        out = (out.withColumn("offset_start", F.concat(F.slice("_ps.starts", F.col("_start") + 1, n_p),
                                                    F.col("_as.starts")))
               .withColumn("offset_end", F.concat(F.slice("_ps.ends", F.col("_start") + 1, n_p),
                                                  F.col("_as.ends"))))
        keep += ["offset_start", "offset_end"]
    return out.select(*keep)


def rejected_rows(df: DataFrame, id_col: str, prompt: Column | str, answer: Column | str, max_len: int = 512,
                  overlap: int = 128, specials: int = 0, tokenizer: Tokenizer | None = None) -> DataFrame:
    """(sample_id, reason) of the rows that ``chunk`` has no chunks for."""
    rows = df.select(F.col(id_col).alias("sample_id"), _c(prompt).isNull().alias("_none"), _c(answer).alias("_at"))
    if tokenizer is not None:
        rows = encoded(rows, {"_a": "_at"}, tokenizer).withColumn("_n", F.size("_a"))
    else:
        rows = rows.withColumn("_n", F.size(tokens("_at")))
    reason = F.when(F.col("_none"), "no prompt").when(F.col("_at").isNull(), "no answer") \
        .when(F.lit(max_len - specials) - F.col("_n") <= overlap, "answer too long")
    return rows.select("sample_id", reason.alias("reason")).where("reason is not null")


_SPAN_TYPE = T.StructType([T.StructField("starts", T.ArrayType(T.LongType())),
                           T.StructField("ends", T.ArrayType(T.LongType()))])


@F.arrow_udf(_SPAN_TYPE)
def token_spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Character [start, end) of every token (same pattern as
    ``tokens``). Spark has no match-position function; this small helper
    runs on the executors, one linear regex scan per row, and gives its spans
    back in slices of a bounded number of characters."""
    import regex
    pat = regex.compile(TOKEN_PATTERN)
    for batch in texts:
        for start, n in slices(text_bytes(batch), SLICE_BYTES):
            starts, ends, upto = [], [], [0]
            for s in batch.slice(start, n).to_pylist():
                for m in pat.finditer(s or ""):
                    starts.append(m.start())
                    ends.append(m.end())
                upto.append(len(starts))
            at = pa.array(upto, pa.int32())
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(at, pa.array(x, pa.int64())) for x in (starts, ends)], ["starts", "ends"])
