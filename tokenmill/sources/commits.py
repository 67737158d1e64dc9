"""Snapshots of a corpus folder: a log of committed runs.

Every write makes a folder ``run-NNNNNN`` of its own and ends with one row in the
log ``_runs``.  A row is a file of its own that appears by a single rename, so a run
counts wholly or not at all, whatever step its writer dies in.  The snapshot is every
committed run from the last overwriting one on, by number.  Folders without a row
(a run in progress, or one whose writer died) and runs that an overwrite replaced
belong to no snapshot; :func:`vacuum_corpus` removes them.

A folder without a log is a corpus of plain files and read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.session import path_exists

LOG = "_runs"  # hidden from readers of the texts
LOG_SCHEMA = "docs bigint, bytes bigint, run int, op string"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    log = f"{path.rstrip('/')}/{LOG}"
    return spark.read.schema(LOG_SCHEMA).parquet(log) if path_exists(spark, log) else None


def run_path(path: str, run: int) -> str:
    return f"{path.rstrip('/')}/run-{run:06d}"


def committed_runs(spark: SparkSession, path: str) -> list[int] | None:
    """Numbers of the snapshot's runs in order; None where there is no log."""
    log = _log(spark, path)
    if log is None:
        return None
    base = F.max(F.when(F.col("op") == "overwrite", F.col("run")))
    base = log.agg(F.coalesce(base, F.lit(-1))).first()[0]
    return [r["run"] for r in log.filter(F.col("run") >= base).select("run").distinct().orderBy("run").collect()]


def snapshot_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the corpus now: those of the snapshot, or the folder itself where there is no log."""
    runs = committed_runs(spark, path)
    return [path] if runs is None else [run_path(path, run) for run in runs]


def next_run(spark: SparkSession, path: str) -> int:
    """A number behind all committed runs whose folder is not taken."""
    log = _log(spark, path)
    last = log.agg(F.max("run")).first()[0] if log is not None else None
    run = 0 if last is None else int(last) + 1
    while path_exists(spark, run_path(path, run)):  # of a writer at work, or one that died
        run += 1
    return run


def commit_run(spark: SparkSession, path: str, run: int, op: str, report: DataFrame) -> None:
    """Publish a run; ``report`` has its ``docs`` and ``bytes``."""
    row = report.withColumn("run", F.lit(run)).withColumn("op", F.lit(op))
    row.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{LOG}")


def _run_folders(spark: SparkSession, path: str) -> dict[int, str]:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)
    names = [f.getPath() for f in found if f.isDirectory()]
    return {int(m[1]): p.toString() for p in names if (m := re.fullmatch(r"run-(\d+)", p.getName()))}


def _remove(spark: SparkSession, folder: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def drop_replaced(spark: SparkSession, path: str) -> list[int]:
    """Remove the folders of committed runs that an overwrite replaced; their numbers."""
    log = _log(spark, path)
    if log is None:
        return []
    logged = {r["run"] for r in log.select("run").collect()} - set(committed_runs(spark, path))
    gone = {run: folder for run, folder in _run_folders(spark, path).items() if run in logged}
    for folder in gone.values():
        _remove(spark, folder)
    return sorted(gone)


def vacuum_corpus(spark: SparkSession, path: str) -> list[int]:
    """Remove every run folder outside of the snapshot; their numbers.  No writer may be at work."""
    runs = committed_runs(spark, path)
    if runs is None:
        return []
    gone = {run: folder for run, folder in _run_folders(spark, path).items() if run not in runs}
    for folder in gone.values():
        _remove(spark, folder)
    return sorted(gone)
