"""Positioned reads against plain Python on whole files."""

import random
import re

import pytest

from tokenmill.operators import chunks as K
from tokenmill.sources import byteranges as R
from tokenmill.sources import corpus as IO


def _reader(data):
    return lambda at, n: data[at:at + n]


def _random_bytes(rng, delim, size):
    parts = [delim, delim[:-1], delim[:2], b"x", b"\n", b"\xff", "漢".encode(), b"plain text "]
    return b"".join(rng.choice(parts) for _ in range(size))


@pytest.mark.parametrize("delim", [b"<|eot|>", b"|", b"ab"])
def test_delimiters_and_segments_at_every_place(delim):
    rng = random.Random(len(delim))
    for size in (0, 1, 5, 60):
        data = _random_bytes(rng, delim, size)
        starts = [m.start() for m in re.finditer(re.escape(delim), data)]
        for probe in (1, 3, 1000):
            for lo in range(0, len(data), 7):
                hi = min(len(data), lo + rng.randrange(1, 40))
                pos, seen = R.first_delimiter(_reader(data), lo, hi, delim, probe)
                assert pos == min((s for s in starts if lo <= s < hi), default=None)
                assert seen <= hi - lo + len(delim) - 1
        wanted, at = [], 0
        for s in starts:
            wanted.append((at, data[at:s], True))
            at = s + len(delim)
        if at < len(data):
            wanted.append((at, data[at:], False))
        for width in (1, 2, 5, 13, 10_000):
            cuts = [(lo, min(lo + width, len(data))) for lo in range(0, len(data), width)]
            got = [s for lo, hi in cuts for s in R.range_segments(_reader(data), lo, hi, len(data), delim, 4)]
            assert got == wanted


def test_boundaries_equal_the_scan_over_many_files(spark, tmp_path):
    rng, delim, data = random.Random(5), b"<|eot|>", b""
    for n in range(12):  # some files without any delimiter, one of them empty
        part = _random_bytes(rng, delim, 40) if n % 4 == 0 else b"" if n == 5 else b"no marker " * rng.randrange(1, 9)
        (tmp_path / f"part-{n:05d}").write_bytes(part)
        data += part
    layout = K.raw_file_layout(spark, str(tmp_path), delim.decode()).cache()
    for n in (1, 3, 10, 2 * len(data)):
        bounds, _ = R.seek_boundaries(spark, str(tmp_path), n, delimiter=delim.decode(), probe=5)
        assert bounds == K.chunk_boundaries(layout, n, ("doc_seq",))
    layout.unpersist()


def test_a_probe_for_each_guess_is_read(spark, tmp_path):
    (tmp_path / "long file").mkdir()
    with open(tmp_path / "long file" / "a b%20.txt", "wb") as f:
        for n in range(3000):
            f.write(b"%d " % n * 200 + b"<|endoftext|>")
    bounds, seen = R.seek_boundaries(spark, str(tmp_path / "long file"), 10, probe=4096)
    data = (tmp_path / "long file" / "a b%20.txt").read_bytes()
    assert bounds == sorted({0, len(data), *(data.find(b"<|endoftext|>", i * (len(data) // 10)) for i in range(1, 10))})
    assert seen <= 9 * 4096 < len(data) / 50


def test_no_files_and_bad_delimiters(spark, tmp_path):
    (tmp_path / "empty.txt").write_bytes(b"")
    assert R.seek_boundaries(spark, str(tmp_path), 4) == ([0], 0)
    assert R.byte_segments(spark, str(tmp_path)).collect() == []
    for delimiter in ("", "::", "aba"):
        with pytest.raises(ValueError):
            R.byte_segments(spark, str(tmp_path), delimiter=delimiter)
    with pytest.raises(ValueError):
        R.seek_boundaries(spark, str(tmp_path), 0)


def test_keys_do_not_depend_on_the_ranges(spark, tmp_path):
    rng = random.Random(9)
    for n in range(3):
        (tmp_path / f"part-{n:05d}").write_bytes(_random_bytes(rng, b"<|eot|>", 300))
    one, two = ({(r.file_key, r.start, bytes(r.value), r.ended) for r in R.byte_segments(
        spark, str(tmp_path), delimiter="<|eot|>", range_bytes=width).collect()} for width in (64, 1 << 20))
    assert one == two
    for errors in ("replace", "ignore"):
        got = R.positioned_corpus(spark, str(tmp_path), delimiter="<|eot|>", errors=errors, range_bytes=100)
        want = IO.read_corpus(spark, str(tmp_path), delimiter="<|eot|>", errors=errors)
        assert [r.text for r in got.orderBy("file_key", "start").collect()] == [
            r.text for r in want.orderBy(*IO.ORDER_COLS).collect()]


def test_a_committed_corpus_is_read_by_its_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i} " * (i + 1)) for i in range(50)], "doc_id long, text string")
    path = str(tmp_path / "corpus")
    IO.write_corpus(df, path, order_cols=["doc_id"])
    rows = R.positioned_corpus(spark, path, range_bytes=200).orderBy("end_byte").collect()
    assert [r.text for r in rows] == [f"text {i} ".strip() if i == 0 else (f"text {i} " * (i + 1)).strip() for i in range(50)]
    size, ends = 0, []
    for i in range(50):
        ends.append(size + len(f"text {i} " * (i + 1)) + 2)
        size += len(f"text {i} " * (i + 1)) + 17
    assert [r.end_byte for r in rows] == ends
