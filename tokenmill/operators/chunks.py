"""Byte-aligned chunking of a corpus file laid out by the corpus writer.

The file is virtual: document ``d`` (in order) occupies ``octet_length(text)``
bytes followed by the 17-byte separator ``\\n\\n<|endoftext|>\\n\\n``; a
delimiter starts 2 bytes after each text (plus any delimiter inside a text).
Offsets come from the distributed prefix sum.

Boundaries follow the reference rule with the straddle fixed: ``n`` uniform
guesses ``i * max(size // n, 1)`` each move to the first delimiter start at or
after the guess (EOF if none); 0 and the size are kept; sorted, distinct.
The "next ≥" lookup is a grouped minimum per guess bucket (``pos div
chunk_size``), so it is one partial aggregate over delimiters plus ≤ n+2 rows
on the driver — no non-equi join.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.constants import DOC_SUFFIX, EOT
from tokenmill.functions.text import utf8_decode
from tokenmill.operators.ordered import prefix_offsets

SEP_BYTES = len(DOC_SUFFIX.encode("utf-8"))
DELIM_AT = len("\n\n")
HEAD_BYTES_PER_CHAR = 4


def file_layout(docs: DataFrame, order_cols: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Writer layout: ``order_cols..., text, nbytes, sep, delim_at, start``.

    Every document is followed by the 17-byte separator whose delimiter starts
    2 bytes in.
    """
    sized = docs.select(
        *order_cols,
        F.col(text_col).alias("text"),
        F.octet_length(text_col).cast("bigint").alias("nbytes"),
        F.lit(SEP_BYTES).cast("bigint").alias("sep"),
        F.lit(DELIM_AT).cast("bigint").alias("delim_at"),
    )
    return _place(sized, order_cols)


def _place(sized: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    offs = prefix_offsets(
        sized.select(*order_cols, (F.col("nbytes") + F.col("sep")).alias("unit")), order_cols, "unit", "start"
    )
    return sized.join(offs.drop("unit"), list(order_cols))


def raw_file_layout(spark, path: str, delimiter: str = EOT) -> DataFrame:
    """Layout of delimiter-separated files, one behind the other: segments as they are.

    Each segment is followed by the delimiter, but for the last one of a file
    that does not itself end with the delimiter (as its length tells).
    """
    from tokenmill.sources.corpus import ORDER_COLS, file_key, segments, with_sequence

    raw = segments(spark, path, delimiter).select(
        file_key(F.col("_metadata.file_path")).alias("file_key"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("text"),
    )
    seq = with_sequence(raw, ORDER_COLS, "doc_seq")
    dlen = len(delimiter.encode("utf-8"))
    files = seq.groupBy("file_key").agg(
        F.max("doc_seq").alias("last"), (F.sum(F.octet_length("text") + dlen) > F.max("file_size")).alias("open"))
    open_ends = files.filter("open").select(F.col("last").alias("doc_seq"), F.lit(True).alias("open"))
    sized = seq.join(open_ends, "doc_seq", "left").select(
        "doc_seq",
        "text",
        F.octet_length("text").cast("bigint").alias("nbytes"),
        F.when(F.col("open"), F.lit(0)).otherwise(F.lit(dlen)).cast("bigint").alias("sep"),
        F.lit(0).cast("bigint").alias("delim_at"),
    )
    return _place(sized, ["doc_seq"]).withColumn("sep_text", F.lit(delimiter))


def delimiter_offsets(layout: DataFrame, order_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``pos``: byte offset of every delimiter start in the virtual file.

    The texts of a raw file were cut at its delimiter, so none is inside them;
    a text of the writer's layout may hold the document marker.
    """
    after_text = layout.filter(F.col("sep") > 0).select((F.col("start") + F.col("nbytes") + F.col("delim_at")).alias("pos"))
    if "sep_text" in layout.columns:
        return after_text
    quoted = "\\Q" + EOT + "\\E"
    inner = layout.filter(F.col("text").contains(EOT)).select(
        *order_cols, "start", F.posexplode(F.split("text", quoted, -1)).alias("j", "part")
    )
    w = Window.partitionBy(*order_cols).orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    eot_len = len(EOT.encode("utf-8"))
    inner = inner.withColumn("_run", F.sum(F.octet_length("part") + eot_len).over(w))
    inner = inner.withColumn("_last", F.max("j").over(Window.partitionBy(*order_cols)))
    in_text = inner.filter(F.col("j") < F.col("_last")).select((F.col("start") + F.col("_run") - eot_len).alias("pos"))
    return after_text.unionByName(in_text)


def file_size(layout: DataFrame) -> int:
    return int(layout.agg(F.sum(F.col("nbytes") + F.col("sep"))).collect()[0][0] or 0)


def chunk_boundaries(layout: DataFrame, num_chunks: int, order_cols: Sequence[str] = ("doc_id",)) -> list[int]:
    """Sorted distinct boundary offsets (a list of at most ``num_chunks + 1`` ints)."""
    size = file_size(layout)
    step = max(size // num_chunks, 1)
    delims = delimiter_offsets(layout, order_cols)
    per_bucket = {
        int(r["b"]): int(r["m"])
        for r in delims.groupBy(F.floor(F.col("pos") / step).cast("bigint").alias("b")).agg(F.min("pos").alias("m")).collect()
    }
    firsts = sorted(per_bucket.values())  # the first delimiter of each bucket, and guesses are where buckets begin
    inner = [firsts[at] if (at := bisect.bisect_left(firsts, i * step)) < len(firsts) else size for i in range(1, num_chunks)]
    return sorted({0, *inner, size})


def _chunk_of(pos: Column, bounds: list[int]) -> Column:
    """Number of inner boundaries at or below ``pos``: a binary search in the constant list."""
    inner = bounds[1:-1]
    if not inner:
        return F.lit(0).cast("bigint")
    values = F.lit(inner).cast("array<bigint>")
    steps = F.lit([1 << k for k in reversed(range(len(inner).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(inner)) & (F.get(values, at + step - 1) <= pos), at + step).otherwise(at))
    return found.cast("bigint")


def _text_pieces(layout: DataFrame, bounds: list[int]) -> DataFrame:
    """Each document's text cut at the chunk boundaries: ``chunk_id, lo, hi, start, text``."""
    end = F.col("start") + F.col("nbytes")
    pieces = layout.filter(F.col("nbytes") > 0).select(
        "start", "nbytes", "text",
        F.explode(F.sequence(_chunk_of(F.col("start"), bounds), _chunk_of(end - 1, bounds))).alias("chunk_id"),
    )
    b = F.array(*[F.lit(x).cast("bigint") for x in bounds])
    lo = F.greatest(F.col("start"), F.element_at(b, (F.col("chunk_id") + 1).cast("int")))
    hi = F.least(end, F.element_at(b, (F.col("chunk_id") + 2).cast("int")))
    return pieces.select("chunk_id", lo.alias("lo"), hi.alias("hi"), "start", "text")


def corpus_chunks(layout: DataFrame, bounds: list[int]) -> DataFrame:
    """``chunk_id, start_byte, end_byte, length, chars``: chunks tile ``[0, size)``.

    Chunk text is decoded with ``errors="ignore"``; separators are ASCII, so
    chars = bytes − (bytes − chars) of the text pieces inside the chunk.
    """
    spark = layout.sparkSession
    pieces = _text_pieces(layout, bounds)
    sub = F.substring(F.col("text").cast("binary"), (F.col("lo") - F.col("start") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    extra = pieces.groupBy("chunk_id").agg(
        F.sum((F.col("hi") - F.col("lo")) - F.length(utf8_decode(sub, "ignore"))).cast("bigint").alias("_extra")
    )
    rows = [(i, bounds[i], bounds[i + 1]) for i in range(len(bounds) - 1)]
    frame = spark.createDataFrame(rows, "chunk_id bigint, start_byte bigint, end_byte bigint")
    return frame.join(F.broadcast(extra), "chunk_id", "left").select(
        "chunk_id",
        "start_byte",
        "end_byte",
        (F.col("end_byte") - F.col("start_byte")).alias("length"),
        (F.col("end_byte") - F.col("start_byte") - F.coalesce("_extra", F.lit(0))).cast("bigint").alias("chars"),
    )


def chunk_preview(layout: DataFrame, bounds: list[int], preview_chars: int = 200) -> DataFrame:
    """``chunk_id, preview``: first ``preview_chars`` characters, newlines shown as ``\\n``.

    The pieces inside each chunk's first ``4 * preview_chars`` bytes are read
    first (a UTF-8 character has at most 4 bytes).  Bytes that are not UTF-8
    yield no character; while some chunk then has too few, eight times as many
    bytes are read, up to whole chunks.
    """
    head, longest = HEAD_BYTES_PER_CHAR * preview_chars, max(b - a for a, b in zip(bounds, bounds[1:]))
    while True:
        shown = _preview(layout, bounds, preview_chars, head)
        if head >= longest or shown.filter((F.col("n") < preview_chars) & (F.col("read") >= head)).isEmpty():
            return shown.select("chunk_id", "preview")
        head *= 8


def _preview(layout: DataFrame, bounds: list[int], preview_chars: int, head: int) -> DataFrame:
    b = F.array(*[F.lit(x).cast("bigint") for x in bounds])
    sep_text = F.col("sep_text") if "sep_text" in layout.columns else F.lit(DOC_SUFFIX)
    sep = F.when(F.col("sep") > 0, sep_text).otherwise(F.lit("")).cast("binary")
    u_lo = F.col("start")
    u_hi = F.col("start") + F.col("nbytes") + F.col("sep")

    def w_hi(c: Column) -> Column:
        return F.least(F.element_at(b, (c + 1).cast("int")) + head, F.element_at(b, (c + 2).cast("int")))

    # Chunks a unit (text + separator) overlaps, kept only where the unit
    # reaches into that chunk's head window; everything else is filtered out.
    span = F.sequence(_chunk_of(u_lo, bounds), _chunk_of(u_hi - 1, bounds))
    heads = F.filter(span, lambda c: u_lo < w_hi(c))
    units = layout.filter(u_hi > u_lo).select(
        u_lo.alias("u_lo"), F.concat(F.col("text").cast("binary"), sep).alias("bytes"), F.explode(heads).alias("chunk_id")
    )
    lo = F.greatest(F.col("u_lo"), F.element_at(b, (F.col("chunk_id") + 1).cast("int")))
    hi = F.least(F.col("u_lo") + F.octet_length("bytes"), w_hi(F.col("chunk_id")))
    parts = units.select(
        "chunk_id",
        lo.alias("lo"),
        F.substring("bytes", (lo - F.col("u_lo") + 1).cast("int"), (hi - lo).cast("int")).alias("b"),
    )
    grouped = parts.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("lo", "b"))).alias("_p"))
    raw = F.aggregate("_p", F.encode(F.lit(""), "UTF-8"), lambda a, x: F.concat(a, x["b"]))
    text = utf8_decode(raw, "ignore")
    shown = grouped.select("chunk_id", F.octet_length(raw).alias("read"), F.substring(text, 1, preview_chars).alias("t"))
    return shown.select("chunk_id", "read", F.length("t").alias("n"), F.replace("t", F.lit("\n"), F.lit("\\n")).alias("preview"))


def chunk_pieces(layout: DataFrame, bounds: list[int]) -> DataFrame:
    """``chunk_id, lo, bytes``: every byte of the file, cut at the boundaries.

    One row per (unit, chunk) overlap; nothing is grouped, so a chunk's text
    never has to fit in one task.  Ordering by ``lo`` and concatenating the
    bytes of a chunk gives exactly ``file[start:end]``.
    """
    sep_text = F.col("sep_text") if "sep_text" in layout.columns else F.lit(DOC_SUFFIX)
    sep = F.when(F.col("sep") > 0, sep_text).otherwise(F.lit("")).cast("binary")
    u_lo = F.col("start")
    u_hi = F.col("start") + F.col("nbytes") + F.col("sep")
    b = F.array(*[F.lit(x).cast("bigint") for x in bounds])
    units = layout.filter(u_hi > u_lo).select(
        u_lo.alias("u_lo"),
        F.concat(F.col("text").cast("binary"), sep).alias("bytes"),
        F.explode(F.sequence(_chunk_of(u_lo, bounds), _chunk_of(u_hi - 1, bounds))).alias("chunk_id"),
    )
    lo = F.greatest(F.col("u_lo"), F.element_at(b, (F.col("chunk_id") + 1).cast("int")))
    hi = F.least(F.col("u_lo") + F.octet_length("bytes"), F.element_at(b, (F.col("chunk_id") + 2).cast("int")))
    return units.select(
        "chunk_id", lo.alias("lo"), F.substring("bytes", (lo - F.col("u_lo") + 1).cast("int"), (hi - lo).cast("int")).alias("bytes")
    )
