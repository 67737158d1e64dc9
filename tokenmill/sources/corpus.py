"""EOT-delimited corpus files: the text source and sink.

A corpus is a directory (or file) of UTF-8 text where every document is
followed by ``\\n\\n<|endoftext|>\\n\\n``.  Spark's text source splits records on
the multi-character delimiter itself, across file splits, so a large corpus is
read in parallel without ever holding a file in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import DOC_SUFFIX, EOT
from tokenmill.functions.text import strip_ws, utf8_decode
from tokenmill.operators.ordered import global_rank
from tokenmill.session import materialize
from tokenmill.sources.commits import commit_run, drop_replaced, next_run, run_path, snapshot_paths

ORDER_COLS = ("file_key", "block_start", "row_id")


def file_key(path: Column) -> Column:
    """A file's place in the corpus as a sortable text: the digits of run and part numbers filled up."""
    padded = F.regexp_replace(path, r"/run-(\d+)/", "/run-000000000000000$1/")
    padded = F.regexp_replace(padded, r"/run-0*(\d{16})/", "/run-$1/")
    padded = F.regexp_replace(padded, r"/part-(\d+)", "/part-000000000000000$1")
    return F.regexp_replace(padded, r"/part-0*(\d{16})", "/part-$1")


def segments(spark: SparkSession, path: str, delimiter: str = EOT) -> DataFrame:
    """The corpus' files, cut at the delimiter: ``value`` and Spark's ``_metadata``."""
    paths = snapshot_paths(spark, path)
    reader = spark.read.option("lineSep", delimiter).option("recursiveFileLookup", "true")
    if paths:
        return reader.text(paths)
    meta = "struct<file_path: string, file_size: bigint, file_block_start: bigint>"
    return spark.createDataFrame([], f"value string, _metadata {meta}")


def read_corpus(
    spark: SparkSession,
    path: str,
    *,
    delimiter: str = EOT,
    errors: str = "replace",
    keep_empty: bool = False,
    strip: bool = True,
) -> DataFrame:
    """One row per document: ``file_key, block_start, row_id, text``.

    ``(file_key, block_start, row_id)`` orders documents as they appear in
    the files, and files by run and part number.  Text-mode newline handling (``\\r\\n`` and ``\\r`` → ``\\n``) and
    the UTF-8 error policy are applied; documents are stripped and empty ones
    dropped unless ``keep_empty``.  Of a folder that ``write_corpus`` made, the
    runs of its last committed snapshot are read.
    """
    raw = segments(spark, path, delimiter)
    df = raw.select(
        file_key(F.col("_metadata.file_path")).alias("file_key"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").cast("binary").alias("_raw"),
    )
    text = F.regexp_replace(utf8_decode(F.col("_raw"), errors), "\r\n?", "\n")
    if strip:
        text = strip_ws(text)
    df = df.select(*ORDER_COLS, text.alias("text"))
    if not keep_empty:
        df = df.filter(F.length("text") > 0)
    return df


def with_sequence(df: DataFrame, order_cols: Sequence[str] = ORDER_COLS, out_col: str = "doc_seq") -> DataFrame:
    """Add a dense 0-based document number in file order (distributed rank).

    The rows are written once, with their keys, before they are ranked: a row's
    key depends on how its file was split, and two scans may split differently.
    """
    rows = materialize(df, "corpus-rows")
    ranks = global_rank(rows, order_cols, out_col)
    return rows.join(ranks, list(order_cols))


def write_corpus(
    df: DataFrame,
    path: str,
    *,
    order_cols: Sequence[str] | None = None,
    text_col: str = "text",
    mode: str = "overwrite",
    dry_run: bool = False,
) -> DataFrame:
    """Write ``text + "\n\n<|endoftext|>\n\n"`` per document; return a report.

    Each call writes a folder ``run-NNNNNN`` of its own and commits it with a row of
    the log (see ``commits``): readers see the corpus without the run or with
    all of it.  ``mode="append"`` adds the run, ``"overwrite"`` makes it the whole
    corpus and then removes the runs that it replaced.  A writer that dies leaves
    the last snapshot as it was.  With ``order_cols`` a run is range-sorted.  Readers
    order by run, then part number, so documents come back in the order in which
    they were written.  A dry run writes nothing.  The one-row report, gathered
    while writing, has ``docs`` and ``bytes``.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"a corpus is written by overwrite or append, not {mode}")
    spark = df.sparkSession
    suffix = len(DOC_SUFFIX.encode("utf-8"))
    out = df.select(F.col(text_col).alias("value"), *[c for c in order_cols or [] if c != "value"])
    counts = [F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(F.octet_length("value") + suffix), F.lit(0)).cast("bigint").alias("bytes")]
    if dry_run:
        return out.agg(*counts)
    if order_cols:
        out = out.orderBy(*order_cols)
    run = next_run(spark, path)
    seen = Observation()
    out.observe(seen, *counts).select("value").write.mode("error").option("lineSep", DOC_SUFFIX).text(run_path(path, run))
    report = spark.createDataFrame([(seen.get["docs"], seen.get["bytes"])], "docs bigint, bytes bigint")
    commit_run(spark, path, run, mode, report)
    if mode == "overwrite":
        drop_replaced(spark, path)
    return report


def clean_corpus(spark: SparkSession, source: str, target: str | None = None, *, dry_run: bool = False) -> DataFrame:
    """Read a corpus, drop later copies of equal documents (in file order), write it; return the report.

    The report has ``docs_read``, ``docs_written``, ``duplicates`` and
    ``bytes_written``; a dry run only counts.  In place (no ``target``) the old
    texts stay the corpus until the new ones are committed.
    """
    from tokenmill.operators.dedupe import dedupe_exact

    docs = materialize(with_sequence(read_corpus(spark, source)).select("doc_seq", "text"), "corpus-clean")
    kept = dedupe_exact(docs, ["doc_seq"])
    report = write_corpus(kept, target or source, order_cols=["doc_seq"], dry_run=dry_run)
    read = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return report.select(F.lit(read).cast("bigint").alias("docs_read"), F.col("docs").alias("docs_written"),
                         (F.lit(read) - F.col("docs")).cast("bigint").alias("duplicates"), F.col("bytes").alias("bytes_written"))


__all__ = ["read_corpus", "write_corpus", "clean_corpus", "with_sequence", "file_key", "ORDER_COLS"]
