"""Session and scratch-space helpers.

Library code never picks a machine-local folder on its own: lineage cuts and
scratch tables go under the cluster's shared ``spark.checkpoint.dir``.  Only
when that setting is absent *and* the master is local (tests, laptops) do we
create a temporary folder and register it.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tokenmill") -> SparkSession:
    """A local session configured the way tests and the bench run."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.python.worker.reuse", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    importable_in_workers(spark)
    return spark


def importable_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    The folder goes to the workers' PYTHONPATH; a cluster without that folder
    gets the package by ``--py-files`` as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or an already registered directory).  A
    temporary folder is used only for local masters where nothing is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a JVM context
        sc = None
    if sc is not None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is None:
            return conf_dir
        sc.setCheckpointDir(conf_dir)
        return sc._jsc.sc().getCheckpointDir().get()
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="tokenmill-ckpt-", dir="/tmp")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", path)
        return path
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def num_partitions(df: DataFrame) -> int | None:
    """Partitions of a plain scan; for a plan with exchanges this would run its stages."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001
        return None


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    except Exception:  # noqa: BLE001 - no JVM handle: probe with a read
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:  # noqa: BLE001
            return False


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table of our own; without a JVM handle it is left to the folder's owner."""
    if not path.startswith(checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError("only scratch tables are removed")
    try:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    except Exception:  # noqa: BLE001
        return
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This cuts lineage (a retry re-reads the written files instead of replaying
    the whole plan) and survives executor loss, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def free_memory() -> None:
    """Give memory that this process has freed back to the system.

    Spark keeps Python workers for later tasks, and numpy's and Arrow's allocators
    keep what a task has freed, so idle workers would weigh on the executor
    while it does other work.  Called where a task or a large group ends.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; at its end the memory that it freed is given back."""
    def task(batches):
        yield from run(batches)
        free_memory()
    return task


def freeing_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` over one group; then the memory that it freed is given back."""
    def group(table):
        out = run(table)
        free_memory()
        return out
    return group
