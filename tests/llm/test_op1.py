"""Archives: exact round trip, dictionary frame, one frame per record, revisits."""
import glob
import hashlib
import struct

import pytest
import zstandard

from kiln.llm import warc
from kiln.session import shared_path


def brute(pages):
    firsts = {}
    for p, _, h in pages:
        b = (h or "").encode()
        if len(b) >= 100 and p is not None:
            firsts[b] = min(firsts.get(b, p), p)
    out = []
    for p, _, h in pages:
        b = (h or "").encode()
        first = firsts.get(b)
        revisit = first is not None and first != p
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


PAGES = [(i, f"http://h/{i}", "<html>" + f"page {i % 7} " * 40 + "</html>") for i in range(60)] + [
    (100, None, None), (101, "http://e/", ""), (102, "http://s/\r\nX: y", "<p>short</p>"),
    (103, "http://s/", "<p>short</p>"), (104, "u", "x" * 100), (105, "u", "x" * 100), (None, "n", "x" * 100),
    (106, "u", "é" * 49), (107, "u", "é" * 49), (108, "u", "é" * 50), (109, "u", "é" * 50), (110, "u", "z" * 3_000_000),
    (111, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (112, "u", "P*M\x18\x00\x00\x00\x00" * 20)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, "r") for p in PAGES],
                                 "page_id long, url string, html string, payload_bytes int, record_type string")


def test_round_trip(pages):
    got = [tuple(r) for r in warc.round_trip(pages.repartition(3)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == brute(PAGES)


def test_payloads_and_urls_come_back(pages):
    got = {r.page_id: r for r in warc.round_trip(pages).where("record_type = 'response'").collect()}
    assert bytes(got[110].payload) == b"z" * 3_000_000
    assert bytes(got[112].payload) == PAGES[-1][2].encode()
    assert got[102].url == "http://s/%0D%0AX: y" and got[100].url is None


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_repeated_rows_of_the_first_page(spark):
    rows = [(1, "u", "y" * 200)] * 2 + [(2, "u", "y" * 200)] * 2
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == \
        [(1, "response", None)] * 2 + [(2, "revisit", 1)] * 2


def test_archive_layout(spark, pages):
    path = shared_path(spark, "warc-layout")
    warc.write_archives(pages, path)
    files = [open(f, "rb").read() for f in glob.glob(path.removeprefix("file:") + "/part-*")]
    assert files
    for data in files:
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICT_MAGIC
        words = zstandard.ZstdCompressionDict(data[8:8 + size])
        view, at, records = memoryview(data), 8 + size, 0
        while at < len(data):
            end = warc.frame_end(view, at)
            if struct.unpack_from("<I", data, at)[0] == 0xFD2FB528:
                # every record alone can be read with the dictionary
                raw = zstandard.ZstdDecompressor(dict_data=words).decompress(data[at:end])
                assert raw.startswith(b"WARC/1.1\r\n")
                records += 1
            at = end
        assert records


def test_archives_close_at_their_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4096)
    rows = [(i, "u", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(120)]
    path = shared_path(spark, "warc-many")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    assert len(glob.glob(path.removeprefix("file:") + "/part-*")) > 1
    assert warc.read_archives(spark, path).count() == 120


def test_damage_is_seen():
    raw = warc.record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), "response", None)
    assert warc.parse(raw)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"hello", b"jello"))
