"""Parquet table sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators.ordered import key_at_rank
from tokenmill.session import default_parallelism, num_partitions


def spread(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Hash-spread a scan that yields fewer partitions than the cluster has cores.

    A Parquet file written as one row group is one input split; regex and
    encode work on it would run in a single task.  Large inputs already have
    many splits, so at scale this is a no-op and adds no shuffle.
    """
    want = default_parallelism(df.sparkSession)
    have = num_partitions(df)
    if have is None or have >= want:
        return df
    return df.repartition(want, *[F.col(k) for k in keys]) if keys else df.repartition(want)


def read_table(
    spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None, *, spread_keys: Sequence[str] | None = None
) -> DataFrame:
    """``{base}/{name}.parquet`` with optional projection (pruned at the scan)."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return spread(df, spread_keys) if spread_keys else df


def read_documents(
    spark: SparkSession,
    base: str,
    table: str = "documents",
    columns: Sequence[str] = ("doc_id", "text"),
    where: str | None = None,
) -> DataFrame:
    """A split of a row dataset: project the needed columns, filter the split."""
    df = read_table(spark, base, table)
    if where:
        df = df.filter(where)
    return spread(df.select(*columns), [columns[0]])


def skip_rows(df: DataFrame, n: int, order_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Resume: drop the first ``n`` rows in source order (negative n → 0).

    ``order_cols`` must be a total order.  The key of rank ``n - 1`` is found
    with a distributed rank (one value reaches the driver), then the data is
    only filtered on ``key > that key``: no join and no shuffle of the rows,
    and for a single key column the predicate is pushed into the scan.
    """
    n = max(0, int(n))
    if n == 0:
        return df
    at = key_at_rank(df, order_cols, n - 1)
    if at is None:
        return df.filter(F.lit(False))
    if len(order_cols) == 1:
        return df.filter(F.col(order_cols[0]) > F.lit(at[0]))
    left = F.struct(*[F.col(c) for c in order_cols])
    right = F.struct(*[F.lit(v).alias(c) for c, v in zip(order_cols, at)])
    return df.filter(left > right)
