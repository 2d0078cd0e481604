"""Dictionary-compressed WARC archives.

A Zstandard dictionary is built from a bounded sample of records and put, as
is, into a leading skippable frame (magic 0x184D2A5D) of every archive; each
record then is one Zstandard frame of its own that refers to the dictionary,
so any record can be read alone and archives are self-contained. Equal
payloads are stored once: the record with the smallest page_id is the
response, the others are ``revisit`` records that name it.

Archives are written with Spark's own file commit (a lost executor leaves no
half archive): tasks build whole archives of about ``ARCHIVE_BYTES``, and each
is one row and one file of the text sink, whose line separator is chosen to be
an empty skippable frame, which Zstandard readers skip. They are read back
through Spark as whole files, so both work on any store Spark reads."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.frames import hash60
from kiln.session import materialize, shared_path

DICT_MAGIC = 0x184D2A5D
END_OF_ROW = "P*M\x18\x00\x00\x00\x00"       # magic 0x184D2A50, length 0: an empty skippable frame
ARCHIVE_BYTES = 8 << 20                      # compressed bytes after which an archive is closed
DICT_BYTES = 112 << 10
SAMPLE_RECORDS, SAMPLE_RECORD_BYTES = 400, 64 << 10   # bounds of the dictionary sample
MIN_REVISIT_BYTES = 100
LEVEL = 3


# -- records -----------------------------------------------------------------

def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str,
           refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a ``response`` carries the payload, a ``revisit``
    only its digest and length and the record it refers to."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", "Content-Type: text/html; charset=utf-8",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; the payload of a response is digested anew and
    must match its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    f = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(f["Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError("record has a wrong length")
    urn = lambda k: int(f[k][len("<urn:page:"):-1]) if k in f else None
    digest, size = f["WARC-Payload-Digest"].removeprefix("sha256:"), int(f["X-Payload-Length"])
    if f["WARC-Type"] == "response":
        if hashlib.sha256(body).hexdigest() != digest or len(body) != size:
            raise ValueError("payload does not match its digest")
    return {"page_id": urn("WARC-Record-ID"), "url": f.get("WARC-Target-URI"), "payload": body,
            "payload_bytes": size, "payload_digest": digest, "record_type": f["WARC-Type"],
            "refers_to": urn("WARC-Refers-To")}


# -- archives ----------------------------------------------------------------

def dictionary(samples: list[bytes]) -> bytes:
    """Dictionary from sample records: trained where there is enough to learn
    from, else the samples themselves as content to refer to; empty for none."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _loaded(words: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(words) if words else None


def frame_end(data: memoryview, at: int) -> int:
    """End of the frame (Zstandard or skippable) that starts at ``at``."""
    magic, = struct.unpack_from("<I", data, at)
    if magic & 0xFFFFFFF0 == 0x184D2A50:
        return at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    head = bytes(data[at:at + 18])
    checksum = head[4] & 4
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + (4 if checksum else 0)


def read_archive(content: bytes) -> Iterator[bytes]:
    """Records of one archive, in order."""
    data, at = memoryview(content), 0
    reader = zstandard.ZstdDecompressor()
    while at < len(data):
        end = frame_end(data, at)
        magic, = struct.unpack_from("<I", data, at)
        if magic == DICT_MAGIC and at == 0:
            reader = zstandard.ZstdDecompressor(dict_data=_loaded(bytes(data[8:end])))
        elif magic & 0xFFFFFFF0 != 0x184D2A50:
            yield reader.decompress(data[at:end])
        at = end


def _archiver(words: bytes):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_loaded(words), write_checksum=True)
        lead = struct.pack("<II", DICT_MAGIC, len(words)) + words if words else b""
        held, size = [lead], len(lead)
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "payload_digest", "refers_to")]
            for page, url, html, digest, refers in zip(*cols):
                refers = refers.as_py()
                payload = (html.as_py() or "").encode()
                held.append(writer.compress(record(page.as_py(), url.as_py(), payload, digest.as_py(),
                                                   "response" if refers is None else "revisit", refers)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                    held, size = [lead], len(lead)
        if len(held) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
    return build


def classified(pages: DataFrame) -> DataFrame:
    """Adds payload_bytes, payload_digest and refers_to (null for responses).
    The smallest page_id of each repeated payload is found from digests alone;
    only revisits' ids are then joined to the pages."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"),
                         F.sha2(payload, 256).alias("payload_digest"))
    ids = pages.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).select("page_id", "payload_digest")
    firsts = materialize(ids.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"),
                                                           F.count(F.lit(1)).alias("n"))
                         .where("n > 1 and refers_to is not null").drop("n"), "warc-firsts")
    revisits = materialize(ids.join(firsts, "payload_digest").where("page_id is null or page_id <> refers_to")
                           .select("page_id", "payload_digest", "refers_to").distinct(), "warc-revisits")
    r = revisits.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to")
    on = pages.page_id.eqNullSafe(r["_id"]) & (pages.payload_digest == r["_digest"])
    return pages.join(r, on, "left").drop("_id", "_digest")


def sample_dictionary(pages: DataFrame) -> bytes:
    """Dictionary of a bounded sample: the ``SAMPLE_RECORDS`` pages with the
    smallest id hashes among those of at most ``SAMPLE_RECORD_BYTES``."""
    fit = pages.where(F.octet_length("html") <= SAMPLE_RECORD_BYTES).where("page_id is not null")
    ids = [r[0] for r in fit.select("page_id").orderBy(hash60("warc", F.col("page_id")), "page_id")
           .limit(SAMPLE_RECORDS).collect()]
    rows = fit.where(F.col("page_id").isin(ids)).select("page_id", "url", "html") \
        .limit(SAMPLE_RECORDS).collect() if ids else []
    samples = []
    for r in sorted(rows, key=lambda r: (r.page_id, r.html)):
        payload = r.html.encode()
        samples.append(record(r.page_id, r.url, payload, hashlib.sha256(payload).hexdigest(), "response", None))
    return dictionary(samples)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``. Null
    html is an empty payload, a null url or page_id leaves its header out. Rows
    that repeat the smallest page_id with the same payload are all responses.
    An empty table writes no archive."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    words = sample_dictionary(pages)
    classified(pages).select("page_id", "url", "html", "payload_digest", "refers_to") \
        .mapInArrow(_archiver(words), "archive binary") \
        .select(F.col("archive").cast("string").alias("value")) \
        .write.option("lineSep", END_OF_ROW).option("maxRecordsPerFile", 1).mode("overwrite").text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    types = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    for batch in batches:
        for content in batch.column("content"):
            rows: list[dict] = []
            size = 0
            for raw in read_archive(content.as_buffer()):
                rows.append(parse(raw))
                size += len(raw)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t)
                                                      for c, t in zip(cols, types)], names=list(cols))
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t)
                                                  for c, t in zip(cols, types)], names=list(cols))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path``, payloads checked against their
    digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_records, "page_id long, url string, payload binary, payload_bytes long, "
                                      "payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of ``pages`` into the shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
