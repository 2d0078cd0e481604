"""Secret scan by dictionary-primed compression novelty.

Fixed patterns give the base findings. Beyond them, strings that follow a
sensitive word (key, secret, token, ...) are candidates; how new one is, is
measured as its marginal compressed size: the bytes that Zstandard needs for
the surrounding text with the candidate, less those for the surroundings
alone, both primed with a dictionary of the corpus's identifiers. Names and
words that the corpus or the surroundings know cost a few bytes; a random key
costs nearly its length and is reported as kind ``novel``. No string that is a
candidate in any document enters the dictionary, so a key is as new in its
thousandth copy as in its first.

Positions are code points, ends exclusive."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns and the least length of what they must match
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "novel")

# words that make what follows sensitive
SENSITIVE = ("key", "secret", "token", "passw", "pwd", "auth", "bearer", "credential", "private")
SENSITIVE_RE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=!$%^*#&~-]{6,}", re.ASCII)
DELIMITERS = "=-"                  # at the start of a candidate they join it to its name
REPEATED = re.compile(r"(?:([!$%^*#&~])\1+)?$")     # ornament at its end
AROUND = 256                       # code points of surroundings on either side
NOVELTY = 0.6                      # marginal compressed bytes per character of a reported string ...
SURE_LENGTH, PER_MISSING = 16, 0.05    # ... more for each character that a shorter string lacks
SURE_REACH, PER_DISTANCE = 64, 0.002   # ... and for each code point that it starts farther from the sensitive word
CEILING = 1.15                     # what a string of random characters costs at most
PLAIN_LETTERS, PLAIN_DIGITS = 20, 16   # least length of strings of one class, which are words or numbers below
RUN = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{12,}", re.ASCII)    # an identifier after any leading digits
IDENTIFIER_LENGTHS = range(12, 65)
COUNTED = 50_000                   # identifiers a task holds before it sends their counts on
DICT_WORDS, DICT_BYTES = 8192, 112 << 10

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Findings of the fixed patterns, leftmost and non-overlapping per kind;
    matches that are too short are dropped."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def novelty(text: str, start: int, end: int, compressor: zstandard.ZstdCompressor) -> float:
    """Marginal compressed bytes per byte of ``text[start:end]``."""
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    found = text[start:end].encode()
    around = (before + after).encode()
    return (len(compressor.compress(around + b"\n" + found)) - len(compressor.compress(around))) / max(len(found), 1)


def threshold(length: int, distance: int) -> float:
    """Marginal bytes per character that a string of this length needs, this
    many code points after a sensitive word."""
    return NOVELTY + PER_MISSING * max(0, SURE_LENGTH - length) + PER_DISTANCE * max(0, distance - SURE_REACH)


def candidates(text: str) -> Iterator[tuple[int, int, float]]:
    """Strings after a sensitive word with the novelty that each needs: of two
    or more classes (letters, digits, marks) from 6 characters, of letters or
    digits alone from ``PLAIN_LETTERS`` and ``PLAIN_DIGITS``. The need grows
    with the distance to the word until no string could meet it."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return
    done = 0
    for word in SENSITIVE_RE.finditer(text):
        for m in CANDIDATE.finditer(text, max(word.end(), done)):
            found = m[0].lstrip(DELIMITERS)
            start = m.end() - len(found)
            found = found[:REPEATED.search(found).start()]
            if threshold(SURE_LENGTH, start - word.end()) > CEILING:
                break
            done = m.end()
            letters, digits = sum(map(str.isalpha, found)), sum(map(str.isdigit, found))
            mixed = (letters > 0) + (digits > 0) + any(c in "!$%^*#&~" for c in found) > 1
            if len(found) >= 6 and (mixed or letters >= PLAIN_LETTERS or digits >= PLAIN_DIGITS):
                yield start, start + len(found), threshold(len(found), start - word.end())


def novel_spans(text: str, taken: list[Span], compressor: zstandard.ZstdCompressor) -> list[Span]:
    """Incompressible candidates that no base span covers."""
    return [("novel", a, b) for a, b, need in candidates(text)
            if not any(x < b and a < y for _, x, y in taken) and novelty(text, a, b, compressor) >= need]


def text_of(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def identifiers(text: str) -> Iterator[tuple[str, bool]]:
    """(identifier, whether it is a candidate or part of one)."""
    spans = list(candidates(text))
    for m in RUN.finditer(text):
        word = m[0].lstrip("0123456789")
        if len(word) in IDENTIFIER_LENGTHS:
            yield word, any(a < m.end() and m.start() < b for a, b, _ in spans)


def _count_identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent(found: dict[str, list]) -> pa.RecordBatch:
        cols = list(zip(*found.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.bool_()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], names=["w", "n", "candidate", "low", "high"])

    found: dict[str, list] = {}
    for batch in batches:
        for value in batch.column("text"):
            text = value.as_py() or ""
            digest = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)
            for word, candidate in identifiers(text):
                had = found.setdefault(word, [0, False, digest, digest])
                had[:] = had[0] + 1, had[1] or candidate, min(had[2], digest), max(had[3], digest)
            if len(found) >= COUNTED:
                yield sent(found)
                found = {}
    if found:
        yield sent(found)


def identifier_dictionary(docs: DataFrame) -> bytes:
    """The corpus's most used identifiers, joined, the most used last (nearest
    to the text), at most ``DICT_BYTES``: those of at least two distinct texts
    (their least and greatest digest differ) that are no part of a candidate
    in any document. Counted over all documents."""
    words = docs.select("text").mapInArrow(_count_identifiers, "w string, n long, candidate boolean, low long, high long")
    top = words.groupBy("w").agg(F.sum("n").alias("n"), F.max("candidate").alias("candidate"),
                                 F.min("low").alias("low"), F.max("high").alias("high")) \
        .where("not candidate and low <> high") \
        .orderBy(F.desc("n"), "w").limit(DICT_WORDS).collect()
    joined, size = [], 0
    for r in top:
        if size + len(r.w) + 1 > DICT_BYTES:
            break
        joined.append(r.w)
        size += len(r.w) + 1
    return " ".join(reversed(joined)).encode()


def _scanner(words: bytes):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(words) >= 8 else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_dict_id=False)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                more = novel_spans(text, base, compressor)
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(in_order(base + more)), len(more)))
            cols = list(zip(*rows)) if rows else [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])
    return scan


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex,
    sha256 of the base spans as text, all spans as text, n_novel. Null and
    empty texts have no spans."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_scanner(identifier_dictionary(docs)),
                           "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                           "spans string, n_novel long")
