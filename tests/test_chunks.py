"""Chunking of raw files and of the writer's layout."""

import random
import re

import pytest

from tokenmill.operators import chunks as K
from tokenmill.operators.clean import clean_documents
from tokenmill.sources.tables import read_documents
from conftest import SF_SMALL


def _file_bytes_from_pieces(pieces):
    rows = sorted(pieces.collect(), key=lambda r: r["lo"])
    return b"".join(bytes(r["bytes"]) for r in rows)


def _random_file(rng, delim, bad_bytes):
    """Records of letters, white space, multi-byte characters, stray bytes and the other marker."""
    parts = [b"x", b"\n", "\u00e9\u6f22".encode(), b"  ", b"<|endoftext|>" if delim != b"<|endoftext|>" else b"<|eot|>"]
    parts += [b"\xff\xfe", b"\xe6\xbc"] if bad_bytes else []
    records = [b"".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(1, 30))]
    return delim.join(records) + (delim if rng.random() < 0.5 else b"")


@pytest.mark.parametrize(("delim", "bad_bytes", "seed"), [(b"<|endoftext|>", False, 1), (b"<|eot|>", False, 2), (b"<|eot|>", True, 3), (b"::", True, 4)])
def test_generated_files_tile_and_round_trip(spark, tmp_path, delim, bad_bytes, seed):
    data = _random_file(random.Random(seed), delim, bad_bytes)
    path = tmp_path / "generated.txt"
    path.write_bytes(data)
    layout = K.raw_file_layout(spark, str(path), delim.decode()).cache()
    starts = [m.start() for m in re.finditer(re.escape(delim), data)]
    assert sorted(r.pos for r in K.delimiter_offsets(layout, ("doc_seq",)).collect()) == starts
    for n in (1, 2, 3, 7, 40):
        step = max(len(data) // n, 1)
        wanted = {0, len(data), *(min((s for s in starts if s >= i * step), default=len(data)) for i in range(1, n))}
        bounds = K.chunk_boundaries(layout, n, ("doc_seq",))
        assert bounds == sorted(wanted)
        pieces = {}
        for r in sorted(K.chunk_pieces(layout, bounds).collect(), key=lambda r: r["lo"]):
            pieces[r["chunk_id"]] = pieces.get(r["chunk_id"], b"") + bytes(r["bytes"])
        spans = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        assert [pieces[i] for i in range(len(spans))] == spans
        chars = {r.chunk_id: r.chars for r in K.corpus_chunks(layout, bounds).collect()}
        shown = {r.chunk_id: r.preview for r in K.chunk_preview(layout, bounds, 12).collect()}
        if not bad_bytes:
            assert chars == {i: len(s.decode()) for i, s in enumerate(spans)}
        assert shown == {i: s.decode(errors="ignore")[:12].replace("\n", "\\n") for i, s in enumerate(spans)}
    layout.unpersist()


def test_preview_reads_on_behind_bytes_that_are_no_text(spark, tmp_path):
    data = b"\xff" * 5000 + b"here it is" + b"<|eot|>" + b"next"
    path = tmp_path / "bad.txt"
    path.write_bytes(data)
    layout = K.raw_file_layout(spark, str(path), "<|eot|>")
    assert [r.preview for r in K.chunk_preview(layout, [0, len(data)], 8).collect()] == ["here it "]
    assert [r.chars for r in K.corpus_chunks(layout, [0, len(data)]).collect()] == [21]


def test_trailing_delimiter_file(spark, tmp_path):
    delim = "<|endoftext|>"
    data = ("one" + delim + "two" + delim).encode()
    p = tmp_path / "e.txt"
    p.write_bytes(data)
    lay = K.raw_file_layout(spark, str(p), delim)
    assert K.file_size(lay) == len(data)
    bounds = K.chunk_boundaries(lay, 3, ("doc_seq",))
    assert _file_bytes_from_pieces(K.chunk_pieces(lay, bounds)) == data


def test_writer_layout_chunks_tile_the_file(spark):
    docs = clean_documents(read_documents(spark, SF_SMALL))
    lay = K.file_layout(docs)
    bounds = K.chunk_boundaries(lay, 8)
    size = K.file_size(lay)
    assert bounds[0] == 0 and bounds[-1] == size
    chunks = K.corpus_chunks(lay, bounds).orderBy("chunk_id").collect()
    assert chunks[0]["start_byte"] == 0 and chunks[-1]["end_byte"] == size
    for a, b in zip(chunks, chunks[1:]):
        assert a["end_byte"] == b["start_byte"]
    # rebuild the virtual file on the driver (tiny fixture) and compare
    rows = docs.orderBy("doc_id").select("text").collect()
    blob = "".join(r["text"] + "\n\n<|endoftext|>\n\n" for r in rows).encode()
    assert len(blob) == size
    assert _file_bytes_from_pieces(K.chunk_pieces(lay, bounds)) == blob
    for c in chunks:
        part = blob[c["start_byte"]:c["end_byte"]]
        assert c["chars"] == len(part.decode("utf-8", errors="ignore"))
        if c["chunk_id"] > 0:
            assert part.startswith(b"<|endoftext|>")
    prev = {r["chunk_id"]: r["preview"] for r in K.chunk_preview(lay, bounds, 50).collect()}
    for c in chunks:
        text = blob[c["start_byte"]:c["end_byte"]].decode("utf-8", errors="ignore")
        assert prev[c["chunk_id"]] == text[:50].replace("\n", "\\n")


def test_guess_past_last_delimiter_goes_to_eof(spark, tmp_path):
    delim = "<|endoftext|>"
    data = ("a" + delim + "b" * 200).encode()
    p = tmp_path / "g.txt"
    p.write_bytes(data)
    lay = K.raw_file_layout(spark, str(p), delim)
    bounds = K.chunk_boundaries(lay, 4, ("doc_seq",))
    assert bounds == [0, len(data)]


def test_delimiters_inside_documents(spark):
    eot = "<|endoftext|>"
    texts = [f"a{eot}b", "c", f"{eot}{eot}é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lay = K.file_layout(df)
    blob = "".join(t + "\n\n" + eot + "\n\n" for t in texts).encode()
    want, i = [], blob.find(eot.encode())
    while i >= 0:
        want.append(i)
        i = blob.find(eot.encode(), i + 1)
    got = sorted(r.pos for r in K.delimiter_offsets(lay).collect())
    assert got == want
    for n in (2, 3, 5, 9):
        step = max(len(blob) // n, 1)
        ref = [0] + [next((d for d in want if d >= i * step), len(blob)) for i in range(1, n)] + [len(blob)]
        assert K.chunk_boundaries(lay, n) == sorted(set(ref))
        assert _file_bytes_from_pieces(K.chunk_pieces(lay, K.chunk_boundaries(lay, n))) == blob
