"""A file's rows wait outside memory until the whole file is decoded."""
from kiln.sources.sequences import read_sequences


def test_a_long_file_needs_little_memory(spark, tmp_path):
    def decoder(content):
        def resident():
            return int(open("/proc/self/statm").read().split()[1]) * 4096
        before, n = resident(), int(content)
        for i in range(n):
            yield i, i / 2
        if resident() - before > 120 << 20:
            raise MemoryError("the decoded rows were held")
        if n % 2:
            raise ValueError("odd")

    (tmp_path / "a").write_text("1500000")
    (tmp_path / "b").write_text("30001")
    rows, rejects = read_sequences(spark, str(tmp_path), decoder, "i long, x double")
    assert [r.reason for r in rejects.collect()] == ["ValueError: odd"]
    got = rows.selectExpr("count(*) n", "count(distinct pos) d", "sum(abs(pos - i) + abs(x - i / 2)) off", "max(pos) last").first()
    assert tuple(got) == (1_500_000, 1_500_000, 0.0, 1_499_999)
