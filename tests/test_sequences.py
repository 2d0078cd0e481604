"""Sequence files of a caller's format."""
import struct

import pytest

from kiln.sources.sequences import read_sequences


def notes(content):
    """A count, then pairs of a 32-bit pitch and a 64-bit start."""
    (n,) = struct.unpack_from("<i", content)
    if len(content) != 4 + 12 * n:
        raise ValueError(f"{len(content)} bytes for {n} notes")
    return [struct.unpack_from("<id", content, 4 + 12 * i) for i in range(n)]


@pytest.fixture
def folder(tmp_path):
    def put(name, pairs, cut=None):
        raw = struct.pack("<i", len(pairs)) + b"".join(struct.pack("<id", *p) for p in pairs)
        (tmp_path / name).write_bytes(raw[:cut])
    put("a.notes", [(60, 0.5), (61, 1.5), (62, 2.0)])
    put("b.notes", [])
    put("c.notes", [(1, 1.0), (2, 2.0)], cut=-5)
    put("d.notes", [(i, i / 2) for i in range(25_000)])
    (tmp_path / "e.notes").write_bytes(b"")
    return str(tmp_path)


def test_rows_order_and_rejects(spark, folder):
    def decoder(content):
        import struct
        (n,) = struct.unpack_from("<i", content)
        if len(content) != 4 + 12 * n:
            raise ValueError(f"{len(content)} bytes for {n} notes")
        return [struct.unpack_from("<id", content, 4 + 12 * i) for i in range(n)]

    rows, rejects = read_sequences(spark, folder, decoder, "pitch int, start double")
    got = {}
    for r in rows.collect():
        got.setdefault(r.seq_id.rsplit("/", 1)[1], []).append((r.pos, r.pitch, r.start))
    assert sorted(got) == ["a.notes", "d.notes"]
    assert sorted(got["a.notes"]) == [(0, 60, 0.5), (1, 61, 1.5), (2, 62, 2.0)]
    assert sorted(got["d.notes"]) == [(i, i, i / 2) for i in range(25_000)]
    why = {r.seq_id.rsplit("/", 1)[1]: r.reason for r in rejects.collect()}
    assert why == {"c.notes": "ValueError: 23 bytes for 2 notes"}


def test_rows_that_do_not_fit_the_schema(spark, folder):
    rows, rejects = read_sequences(spark, folder + "/a*", lambda content: [(1, 2), (3,)], "a int, b int")
    assert rows.count() == 0 and rejects.first().reason == "ValueError: a row of 1 fields, not 2"
    rows, rejects = read_sequences(spark, folder + "/a*", lambda content: [("x",)], "a int")
    assert rows.count() == 0 and rejects.first().reason.startswith("Arrow")
    with pytest.raises(ValueError, match="pos"):
        read_sequences(spark, folder, notes, "pos int")
