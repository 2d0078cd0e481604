"""Subword tokens (M7): a given byte-pair vocabulary applied to whole texts.

The vocabulary is a file of a public tokenizer (one token a line: base64 of
its bytes, then its rank, which is also its id); its path is a parameter and
nothing is trained here. A text is cut into pieces by the tokenizer's pattern
and every piece is merged on its own: starting from single bytes, the adjacent
pair whose joined bytes have the lowest rank is merged (leftmost on ties)
until no adjacent pair is a token. A long piece is merged with a heap over a
linked list, so one piece of a megabyte takes n log n steps; pieces that recur
are remembered within a task, up to a bounded number, those used last longest.

``encoded`` runs any tokenizer -- this one or a caller's own (K4) -- over
slices of Arrow batches that hold a bounded number of characters: one row in,
one row out, no shuffle, and no row is handled on the driver. ``decoded`` goes
back the same way. The vocabulary reaches the tasks as one broadcast value
whose size is checked when it is read."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MAX_VOCABULARY_BYTES = 64 << 20
MEMO_PIECES = 100_000
SHORT_BYTES = 128            # a piece up to this length is merged by plain scans, which are faster there
SLICE_BYTES = 1 << 20        # text that is encoded before its ids leave the task
SLICE_IDS = 1 << 18          # ids that are decoded before their text leaves the task

# --- fixed value: how the byte-level vocabularies cut a text into pieces ---
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ---------------------------------------------------------------------------

#: ids with the character span [start, end) of each
Encoding = tuple[Sequence[int], Sequence[int], Sequence[int]]
#: texts (no nulls) -> one encoding each
Tokenizer = Callable[[list[str]], list[Encoding]]


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(id, token): a rank file as a table; ``token`` is binary."""
    parts = F.split("value", " ")
    return spark.read.text(path).where("value <> ''").select(
        F.get(parts, F.lit(1)).cast("long").alias("id"), F.unbase64(F.get(parts, F.lit(0))).alias("token"))


class Subwords:
    """A tokenizer from ranked merges; built on the driver, used in tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PIECE_PATTERN) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes: not every text can be encoded")
        self.ranks, self.pattern = ranks, pattern
        self._find, self._ids, self._spans = None, _Memo(), _Memo()

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "_find": None, "_ids": _Memo(), "_spans": _Memo()}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        return self._merge_short(piece) if len(piece) <= SHORT_BYTES else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, float("inf")
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)                   # the leftmost
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))                 # of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))             # start of the part to the left
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue                            # one of its parts has grown or gone
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            left = before[i]
            if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _piece(self, piece: str) -> tuple[list[int], list[int], list[int]]:
        """Ids of a piece and their character spans within it. A token that
        covers part of a character spans the whole of it."""
        raw = piece.encode("utf-8", "replace")
        ids = self.merge(raw)
        sizes = [len(self._tokens[i]) for i in ids]
        if len(raw) == len(piece):                  # a byte a character
            ends = list(accumulate(sizes))
            return ids, [0, *ends[:-1]], ends
        char = [i for i, c in enumerate(piece) for _ in range(len(c.encode("utf-8", "replace")))]
        starts, ends, at = [], [], 0
        for size in sizes:
            starts.append(char[at])
            ends.append(char[at + size - 1] + 1)
            at += size
        return ids, starts, ends

    def _ready(self) -> None:
        if self._find is None:
            import regex
            self._find = regex.compile(self.pattern)
            self._tokens = {i: t for t, i in self.ranks.items()}

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The ids alone, as ``__call__`` gives them, without the cost of spans."""
        self._ready()
        memo, out = self._ids, []
        for text in texts:
            found = [m.group() for m in self._find.finditer(text)] if self._find.groups else self._find.findall(text)
            ids = []
            for piece in found:
                known = memo.get(piece)
                if known is None:
                    known = memo.put(piece, self.merge(piece.encode("utf-8", "replace")))
                ids += known
            out.append(ids)
        return out

    def __call__(self, texts: list[str]) -> list[Encoding]:
        self._ready()
        memo, out = self._spans, []
        for text in texts:
            ids, starts, ends = [], [], []
            for m in self._find.finditer(text):
                piece = m.group()
                known = memo.get(piece)
                if known is None:
                    known = memo.put(piece, self._piece(piece))
                at = m.start()
                ids += known[0]
                starts += [at + s for s in known[1]]
                ends += [at + e for e in known[2]]
            out.append((ids, starts, ends))
        return out


class _Memo:
    """What short pieces gave, in two generations of at most ``MEMO_PIECES``
    each: when the younger is full the older is dropped, and what is used
    passes to the younger, so frequent pieces stay."""

    def __init__(self) -> None:
        self._young, self._old = {}, {}

    def get(self, piece: str):
        known = self._young.get(piece)
        if known is None and (known := self._old.get(piece)) is not None:
            self.put(piece, known)
        return known

    def put(self, piece: str, known):
        if len(piece) <= 64:
            if len(self._young) >= MEMO_PIECES:
                self._young, self._old = {}, self._young
            self._young[piece] = known
        return known


def _bounded(vocabulary: DataFrame) -> list[Row]:
    """A vocabulary's rows on the driver; it must fit ``MAX_VOCABULARY_BYTES``."""
    size = vocabulary.agg(F.coalesce(F.sum(F.octet_length("token") + 16), F.lit(0)).alias("b")).first()["b"]
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is over {MAX_VOCABULARY_BYTES}")
    return vocabulary.collect()


def subword_tokenizer(spark: SparkSession, path: str, pattern: str = PIECE_PATTERN) -> Subwords:
    """The tokenizer of a rank file. The file must fit ``MAX_VOCABULARY_BYTES``."""
    return Subwords({bytes(r["token"]): r["id"] for r in _bounded(read_vocabulary(spark, path))}, pattern)


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, number) of stretches of rows whose sizes sum to at most
    ``most``; a larger row is a stretch of its own."""
    upto, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right"))
        stop = max(stop, at + 1)
        yield at, stop - at
        at = stop


def text_bytes(col: pa.Array) -> np.ndarray:
    """Bytes of every text, and one for the row itself."""
    return pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def encoded(df: DataFrame, texts: dict[str, str], tokenizer: Tokenizer, spans: bool = False,
            keep: Sequence[str] | None = None) -> DataFrame:
    """K4: ``df`` (its columns ``keep``, all by default) with, for every ``out:
    text column`` of ``texts``, the token ids as column ``out``
    (array<bigint>) and, with ``spans``, their character spans as
    ``out_spans`` (struct of starts and ends). A null text has null ids. The
    output's schema follows from the arguments. A tokenizer that has a method
    ``ids`` (texts -> ids of each) is asked for ids alone where spans are not
    wanted. It is called with texts of ``SLICE_BYTES`` in all, or one longer
    text."""
    held = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(tokenizer))
    kept = list(df.columns if keep is None else keep)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c].simpleString()}" for c in kept] + [
        s for out in texts for s in [f"`{out}` array<bigint>"] + (
            [f"`{out}_spans` struct<starts:array<bigint>,ends:array<bigint>>"] if spans else [])])
    numbers = pa.list_(pa.int64())
    asked = list(dict.fromkeys(texts.values()))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = cloudpickle.loads(held.value)
        only = None if spans else getattr(run, "ids", None)
        for whole in batches:
            sizes = sum((text_bytes(whole.column(c)) for c in asked), np.zeros(whole.num_rows, np.int64))
            for start, n in slices(sizes, SLICE_BYTES):
                batch = whole.slice(start, n)
                arrays, names = [batch.column(c) for c in kept], list(kept)
                for out, source in texts.items():
                    given = batch.column(source).to_pylist()
                    there = [t for t in given if t is not None]
                    done = iter(only(there) if only else run(there))
                    rows = [None if t is None else next(done) for t in given]
                    arrays.append(pa.array(rows if only else [r and r[0] for r in rows], numbers))
                    names.append(out)
                    if spans:
                        arrays.append(pa.StructArray.from_arrays(
                            [pa.array([r and r[i] for r in rows], numbers) for i in (1, 2)], ["starts", "ends"]))
                        names.append(f"{out}_spans")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return df.mapInArrow(step, schema)


def decoded(df: DataFrame, keys: Sequence[str], ids: str, vocabulary: DataFrame) -> DataFrame:
    """(keys, text): ids mapped back to text through the vocabulary table,
    every row by its own ids; an id without a token fails the job, and null
    ids give null text. The vocabulary must fit ``MAX_VOCABULARY_BYTES``."""
    held = df.sparkSession.sparkContext.broadcast(
        {r["id"]: bytes(r["token"]) for r in _bounded(vocabulary) if r["token"] is not None})
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = held.value
        for whole in batches:
            sizes = pc.list_value_length(whole.column(ids)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, n in slices(sizes + 1, SLICE_IDS):
                batch = whole.slice(start, n)
                try:
                    raw = [None if r is None else b"".join([token[i] for i in r if i is not None])
                           for r in batch.column(ids).to_pylist()]
                except KeyError as e:
                    raise ValueError("an id is not in the vocabulary") from e
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(raw, pa.binary())], [*keys, "_raw"])

    out = df.select(*keys, ids).mapInArrow(step, ", ".join([f"`{k}` {kinds[k].simpleString()}" for k in keys] + ["_raw binary"]))
    return out.select(*keys, F.decode("_raw", "UTF-8").alias("text"))
