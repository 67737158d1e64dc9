"""Fingerprint index of a corpus: appended runs are deduplicated without reading old texts.

Beside the corpus' runs lies ``_fps``: for each run the SHA-256 fingerprints of its
documents, 32 bytes each, range-partitioned and sorted, so a search for some of them
skips most row groups.  A run's fingerprints count once a row of ``_fps_log`` names it.  An index that lacks a committed run, because its
writer died in between or the run was written by other means, reads the texts of just
that run first; runs that an overwrite replaced are left out with the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions.text import fingerprint
from tokenmill.operators.clean import clean_documents
from tokenmill.operators.dedupe import dedupe_exact
from tokenmill.session import delete_scratch, path_exists, scratch_path
from tokenmill.sources.commits import committed_runs, run_path
from tokenmill.sources.corpus import read_corpus, write_corpus

INDEX, INDEX_LOG = "_fps", "_fps_log"  # hidden from readers of the texts


def indexed_runs(spark: SparkSession, path: str) -> set[int]:
    log = f"{path.rstrip('/')}/{INDEX_LOG}"
    return {r["run"] for r in spark.read.schema("run int").parquet(log).collect()} if path_exists(spark, log) else set()


def index_run(fps: DataFrame, path: str, run: int) -> None:
    """Add the fingerprints (``fp``, hex) of a committed run."""
    spark, base = fps.sparkSession, path.rstrip("/")
    rows = fps.select(F.unhex("fp").alias("fp"))
    rows.repartitionByRange("fp").sortWithinPartitions("fp").write.mode("overwrite").parquet(f"{base}/{INDEX}/run-{run:06d}")
    spark.createDataFrame([(run,)], "run int").coalesce(1).write.mode("append").parquet(f"{base}/{INDEX_LOG}")


def update_index(spark: SparkSession, path: str) -> list[int]:
    """Index the committed runs that the index lacks; their numbers."""
    missing = sorted(set(committed_runs(spark, path) or []) - indexed_runs(spark, path))
    for run in missing:
        index_run(read_corpus(spark, run_path(path, run)).select(fingerprint(F.col("text")).alias("fp")), path, run)
    return missing


def seen_fingerprints(spark: SparkSession, path: str) -> DataFrame | None:
    """``fp`` (hex) of all documents of the snapshot, from the index; None for a corpus without documents."""
    runs = sorted(set(committed_runs(spark, path) or []) & indexed_runs(spark, path))
    if not runs:
        return None
    fps = spark.read.schema("fp binary").parquet(*[f"{path.rstrip('/')}/{INDEX}/run-{run:06d}" for run in runs])
    return fps.select(F.lower(F.hex("fp")).alias("fp"))


def new_documents(new: DataFrame, path: str, order_cols: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The rows of ``new`` that a deduplicated append would write, with ``fp``; the index has to be up to date."""
    batch = dedupe_exact(clean_documents(new, text_col), order_cols, text_col)
    seen = seen_fingerprints(new.sparkSession, path)
    return batch if seen is None else batch.join(seen, "fp", "left_anti").select(*batch.columns)


def append_deduped(new: DataFrame, path: str, order_cols: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Append the documents whose fingerprint the corpus does not have; the report of the write.

    Of equal documents the first by ``order_cols`` is written.  The run is committed
    before it is indexed, so whatever step a writer dies in, the corpus is whole and
    the next call completes the index.  Writers take turns.
    """
    spark = new.sparkSession
    update_index(spark, path)
    scratch = scratch_path(spark, "append-deduped")
    new_documents(new, path, order_cols, text_col).write.parquet(scratch)
    kept = spark.read.parquet(scratch)
    before = set(committed_runs(spark, path) or [])
    report = write_corpus(kept, path, order_cols=order_cols, text_col=text_col, mode="append")
    for run in set(committed_runs(spark, path)) - before:
        index_run(kept.select("fp"), path, run)
    delete_scratch(spark, scratch)
    return report
