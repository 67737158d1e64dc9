"""Raw corpus files by byte position.

Two readers that go to a place in a file instead of scanning up to it, both
over the files of a corpus in order, one behind the other:

* ``seek_boundaries`` looks for the first delimiter behind each of ``n`` guesses
  and reads about one probe a guess, whatever the size of the files;
* ``byte_segments`` cuts files into ranges of bytes, one a task, and gives every
  segment the file and byte at which it begins.  These keys do not depend on the
  ranges, so no copy of the rows has to be written to keep them stable.

Files are opened by pyarrow inside tasks (local paths, ``hdfs``, ``s3``, ``gs``
and what else it knows); any other scheme is an error there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import EOT
from tokenmill.functions.text import strip_ws, utf8_decode
from tokenmill.operators.ordered import prefix_offsets
from tokenmill.session import materialize
from tokenmill.sources.commits import snapshot_paths
from tokenmill.sources.corpus import file_key

PROBE_BYTES = 64 << 10
RANGE_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
FILE = "path string, length bigint, file_key string, start bigint"

Read = Callable[[int, int], bytes]


def corpus_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, file_key, start``: the files of a corpus and where each begins; no content is read."""
    paths = snapshot_paths(spark, path)
    if not paths:
        return spark.createDataFrame([], FILE)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select(
        "path", "length", file_key(F.col("path")).alias("file_key"))
    files = materialize(found.filter("length > 0"), "files")
    return files.join(prefix_offsets(files.select("file_key", "length"), ["file_key"], "length", "start").drop("length"), "file_key")


def _reader(path: str) -> Read:
    """Positioned reads of a file named by a Hadoop path."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if path.startswith("/"):
        system, name = fs.LocalFileSystem(), path
    elif scheme == "file":
        system, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    opened = system.open_input_file(name)
    return lambda at, n: opened.read_at(n, at)


def first_delimiter(read: Read, lo: int, hi: int, delimiter: bytes, probe: int = PROBE_BYTES) -> tuple[int | None, int]:
    """Where the first delimiter that begins in ``[lo, hi)`` stands (or None), and how many bytes were read."""
    held, at, seen, stop = b"", lo, 0, hi + len(delimiter) - 1
    while at < stop:
        data = read(at, min(probe, stop - at))
        if not data:
            break
        seen += len(data)
        held += data
        found = held.find(delimiter)
        if found >= 0:
            return at + len(data) - len(held) + found, seen
        at += len(data)
        held = held[len(held) - len(delimiter) + 1:] if len(held) >= len(delimiter) else held
    return None, seen


def _spread(pieces: DataFrame, tasks: int) -> DataFrame:
    return pieces.repartition(max(1, min(tasks, 100_000)), "path", "lo")


def seek_boundaries(
    spark: SparkSession, path: str, num_chunks: int, *, delimiter: str = EOT, probe: int = PROBE_BYTES
) -> tuple[list[int], int]:
    """``(bounds, bytes read)``: the sorted distinct boundaries that ``chunk_boundaries`` finds by a scan.

    A guess whose chunk holds no delimiter has the boundary of the next guess, so each
    guess is searched in its own chunk only.  A chunk of many files is searched in
    rounds of 1, 2, 4, ... files, until a delimiter turns up; at most about twice
    the bytes before it are read.  At most ``num_chunks + 1`` numbers reach the driver.
    A guess inside a delimiter goes on to the next one; no files give ``[0]``.
    """
    if num_chunks < 1:
        raise ValueError("num_chunks must be positive")
    if not delimiter:
        raise ValueError("a delimiter has at least one character")
    files = materialize(corpus_files(spark, path), "file-starts")
    size = int(files.agg(F.sum("length")).first()[0] or 0)
    step = max(size // num_chunks, 1)
    marker = delimiter.encode("utf-8")
    end = F.col("start") + F.col("length")
    number = [F.least(F.floor(at / step), F.lit(num_chunks - 1)).cast("bigint") for at in (F.col("start"), end - 1)]
    pieces = files.select("path", "length", "start", F.explode(F.sequence(*number)).alias("chunk")).filter("chunk > 0").select(
        "chunk", "path", "length", "start",
        (F.greatest(F.col("start"), F.col("chunk") * step) - F.col("start")).alias("lo"),
        (F.least(end, F.when(F.col("chunk") < num_chunks - 1, (F.col("chunk") + 1) * step).otherwise(size)) - F.col("start")).alias("hi"))
    pieces = materialize(pieces.selectExpr("*", "row_number() over (partition by chunk order by start) as place"), "pieces")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                pos, seen = first_delimiter(_reader(r.path), r.lo, r.hi, marker, probe)
                out.append((r.chunk, None if pos is None else r.start + pos, seen))
            yield pd.DataFrame(out, columns=["chunk", "pos", "seen"]).astype({"pos": "Int64"})

    found, read, low = {}, 0, 1
    most = int(pieces.agg(F.max("place")).first()[0] or 0)
    while low <= most:
        due = pieces.filter(F.col("place").between(low, 2 * low - 1))
        if found:
            done = F.from_json(F.lit(str(sorted(found))), "array<bigint>")
            due = due.filter(~F.array_contains(done, F.col("chunk")))
        hits = _spread(due, num_chunks * low).mapInPandas(search, "chunk bigint, pos bigint, seen bigint")
        for r in hits.groupBy("chunk").agg(F.min("pos").alias("pos"), F.sum("seen").alias("seen")).collect():
            read += r.seen
            if r.pos is not None:
                found[r.chunk] = r.pos
        low *= 2
    bounds, ahead = {0, size}, size
    for chunk in range(num_chunks - 1, 0, -1):
        ahead = found.get(chunk, ahead)
        bounds.add(ahead)
    return sorted(bounds), read


def range_segments(read: Read, lo: int, hi: int, length: int, delimiter: bytes, probe: int) -> Iterator[tuple[int, bytes, bool]]:
    """``(start, bytes, ended)`` of the segments of a file that begin in ``[lo, hi)``; the last one is read to its end."""
    width, at = len(delimiter), 0
    if lo:
        before, _ = first_delimiter(read, max(0, lo - width), max(0, hi - width), delimiter, probe)
        if before is None:
            return
        at = before + width
    held, begin, ahead, searched = bytearray(), at, at, 0  # held: file[begin:ahead], searched up to a delimiter's width
    while begin < min(hi, length):
        found = held.find(delimiter, searched)
        if found >= 0:
            yield begin, bytes(held[:found]), True
            del held[:found + width]
            begin, searched = begin + found + width, 0
            continue
        searched = max(0, len(held) - width + 1)
        data = read(ahead, min(probe, length - ahead)) if ahead < length else b""
        if not data:
            yield begin, bytes(held), False
            return
        held += data
        ahead += len(data)


def byte_segments(
    spark: SparkSession, path: str, *, delimiter: str = EOT, range_bytes: int = RANGE_BYTES, probe: int = 1 << 20
) -> DataFrame:
    """``file_key, start, value, ended, file_start``: every segment's raw bytes and the byte of its file where it begins.

    ``ended`` tells whether a delimiter follows; what follows a file's last delimiter is a
    segment if it holds bytes.  ``file_start + start`` is the place in the whole corpus.
    A task holds one segment and about one probe.  The delimiter must not overlap
    itself (as ``::`` does in ``:::``), else the cuts would depend on the ranges.
    """
    marker = delimiter.encode("utf-8")
    if not marker or any(marker.startswith(marker[i:]) for i in range(1, len(marker))):
        raise ValueError("the delimiter is empty or overlaps itself")
    files = corpus_files(spark, path)
    spans = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / range_bytes).cast("bigint"))
    ranges = materialize(files.select("file_key", "path", "length", F.col("start").alias("file_start"), F.explode(spans).alias("n")).select(
        "file_key", "path", "length", "file_start", (F.col("n") * range_bytes).alias("lo"),
        F.least("length", (F.col("n") + 1) * range_bytes).alias("hi")), "ranges")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["file_key", "start", "value", "ended", "file_start"]
        out, held = [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                for start, value, ended in range_segments(_reader(r.path), r.lo, r.hi, r.length, marker, probe):
                    out.append((r.file_key, start, value, ended, r.file_start))
                    held += len(value)
                    if held >= BATCH_BYTES or len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=columns)
                        out, held = [], 0
        yield pd.DataFrame(out, columns=columns)

    return _spread(ranges, ranges.count()).mapInPandas(
        cut, "file_key string, start bigint, value binary, ended boolean, file_start bigint")


def positioned_corpus(
    spark: SparkSession, path: str, *, delimiter: str = EOT, errors: str = "replace", keep_empty: bool = False,
    strip: bool = True, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``file_key, start, text, end_byte``: the documents of ``read_corpus`` under keys of true positions.

    ``(file_key, start)`` orders documents as in the files; ``end_byte`` is the place of the
    document's end, where its delimiter begins, in the whole corpus.
    """
    text = F.regexp_replace(utf8_decode(F.col("value"), errors), "\r\n?", "\n")
    end = F.col("file_start") + F.col("start") + F.octet_length("value")
    rows = byte_segments(spark, path, delimiter=delimiter, range_bytes=range_bytes).select(
        "file_key", "start", (strip_ws(text) if strip else text).alias("text"), end.alias("end_byte"))
    return rows if keep_empty else rows.filter(F.length("text") > 0)
