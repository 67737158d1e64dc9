"""Ordered prefix sums without funnelling everything into one partition.

``Window.orderBy`` with no ``partitionBy`` moves every row into a single task.
Instead:

1. range-partition the narrow ``(key, value)`` projection into N buckets
   (``spark.sql.shuffle.partitions``, coalesced by AQE for small inputs, more
   where these would be too large) and
   record each row's bucket; write that to the shared checkpoint folder so the
   bucket assignment is fixed (a retry reads files, it does not re-sample);
2. total per bucket (N rows to the driver — bounded by N, not by the data);
3. running sum inside each bucket plus the bucket's base offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.session import materialize

ROWS_PER_BUCKET = 20_000_000  # rows of a range that one task sorts


def prefix_offsets(
    df: DataFrame,
    key_cols: Sequence[str],
    value_col: str,
    out_col: str = "offset",
    *,
    buckets: int | None = None,
) -> DataFrame:
    """``key_cols..., value, offset`` with ``offset`` = exclusive prefix sum of ``value``.

    ``key_cols`` must be a total order (unique per row).
    """
    keys = [F.col(c) for c in key_cols]
    narrow = df.select(*keys, F.col(value_col).cast("bigint").alias(value_col))
    staged, totals = _bucketed(narrow, keys, F.sum(value_col), buckets)
    base, rows = 0, []
    for r in sorted(totals, key=lambda r: r["_bucket"]):
        rows.append((int(r["_bucket"]), base))
        base += int(r["_total"] or 0)
    spark = df.sparkSession
    bases = spark.createDataFrame(rows or [(0, 0)], "_bucket int, _base bigint")
    w = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum(value_col).over(w)
    return (
        staged.join(F.broadcast(bases), "_bucket")
        .select(*keys, F.col(value_col), (F.col("_base") + running - F.col(value_col)).alias(out_col))
    )


def _bucketed(narrow: DataFrame, keys: Sequence[Column], total: Column, buckets: int | None) -> tuple[DataFrame, list]:
    """``narrow``, written in key ranges (``_bucket``), and a row per range: ``_bucket``, ``_total``, ``_rows``.

    Without an explicit count AQE may coalesce *adjacent* range partitions,
    which keeps buckets contiguous in key order and avoids thousands of tiny
    buckets for small inputs.  If the session's partitions make buckets that are
    too large to sort, the written rows are dealt out again, by their number.
    """
    def deal(df: DataFrame, n: int | None) -> tuple[DataFrame, list]:
        ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
        staged = materialize(ranged.withColumn("_bucket", F.spark_partition_id()), "prefix")
        return staged, staged.groupBy("_bucket").agg(total.alias("_total"), F.count(F.lit(1)).alias("_rows")).collect()

    staged, totals = deal(narrow, buckets)
    if buckets is None and any(r["_rows"] > ROWS_PER_BUCKET for r in totals):
        staged, totals = deal(staged.drop("_bucket"), 2 * sum(r["_rows"] for r in totals) // ROWS_PER_BUCKET + 1)
    return staged, totals


def global_rank(df: DataFrame, key_cols: Sequence[str], out_col: str = "rank", *, buckets: int | None = None) -> DataFrame:
    """``key_cols..., rank`` with 0-based rank in key order (distributed)."""
    ones = df.select(*[F.col(c) for c in key_cols], F.lit(1).alias("_one"))
    return prefix_offsets(ones, key_cols, "_one", out_col, buckets=buckets).drop("_one")


def key_at_rank(df: DataFrame, key_cols: Sequence[str], rank: int, *, buckets: int | None = None):
    """The key tuple at 0-based ``rank`` in key order, or None past the end.

    Bucket totals locate the bucket holding ``rank``; a row number inside
    that one bucket finds the key.  Only one value reaches the driver.
    """
    keys = [F.col(c) for c in key_cols]
    narrow = df.select(*keys)
    staged, found = _bucketed(narrow, keys, F.count(F.lit(1)), buckets)
    totals = sorted((int(r["_bucket"]), int(r["_total"])) for r in found)
    base = 0
    for bucket, count in totals:
        if rank < base + count:
            w = Window.partitionBy("_bucket").orderBy(*keys)
            hit = (
                staged.filter(F.col("_bucket") == bucket)
                .withColumn("_rn", F.row_number().over(w) - 1)
                .filter(F.col("_rn") == rank - base)
                .select(*keys)
                .collect()
            )
            return tuple(hit[0])
        base += count
    return None
