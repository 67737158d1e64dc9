"""Softmax and nucleus cut of scores in long form: one row for each (group, item, score).

The array form holds a group in one row.  Here a group may have any number of
rows, a third of the table included.  Sums of a group are partial aggregates.
They come back to the rows by an ordinary join, but for groups of ``hot_rows`` and
more: of these there are at most rows / ``hot_rows``, and they are broadcast, so
their rows stay where they are.

The cut has two levels.  A histogram of each group's mass over ``BINS`` classes of
probability (16 to a factor of two) keeps or drops whole classes; only the class
in which the mass passes ``p`` is put in order, in ranges that also cut through a
group, to find the exact place.

A null group is a group like any other; rows with a null score are left out.
Items are unique in a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.constants import MIN_TEMPERATURE, TOP_P_EPS
from tokenmill.session import materialize

HOT_ROWS = 1 << 22
BINS = 1024
BINS_PER_HALVING = 16


def _with_group_values(rows: DataFrame, values: DataFrame, hot_rows: int) -> DataFrame:
    """``rows`` with their group's ``values`` (``_g``, ``_n`` rows and more)."""
    hot = F.broadcast(values.filter(F.col("_n") >= hot_rows))
    ours = rows.join(hot, "_g")
    others = rows.join(hot.select("_g"), "_g", "left_anti").join(values.filter(F.col("_n") < hot_rows), "_g")
    return ours.unionByName(others).drop("_n")


def softmax_long(df: DataFrame, group: str, item: str, score: str, temperature: float = 1.0, out_col: str = "prob",
                 *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``group, item, prob``: the softmax of each group's scores, ``T = max(T, 1e-6)``."""
    t = max(float(temperature), MIN_TEMPERATURE)
    scaled = F.col(score).cast("double") / F.lit(t)
    rows = materialize(df.select(F.struct(F.col(group).alias("group")).alias("_g"), F.col(item).alias("_item"), scaled.alias("_s"))
                       .filter("_s is not null"), "scores")
    top = materialize(rows.groupBy("_g").agg(F.max("_s").alias("_top"), F.count("*").alias("_n")), "score-tops")
    exps = materialize(_with_group_values(rows, top, hot_rows).select("_g", "_item", F.exp(F.col("_s") - F.col("_top")).alias("_e")),
                       "score-exps")
    total = materialize(exps.groupBy("_g").agg(F.sum("_e").alias("_sum"), F.count("*").alias("_n")), "score-totals")
    return _with_group_values(exps, total, hot_rows).select(
        F.col("_g.group").alias(group), F.col("_item").alias(item), (F.col("_e") / F.col("_sum")).alias(out_col))


def _bin(prob: Column) -> Column:
    """Class of a probability: the larger, the lower."""
    depth = F.floor(-F.log2(prob) * BINS_PER_HALVING)
    return F.when(prob > 0, F.least(F.greatest(depth, F.lit(0)), F.lit(BINS - 1))).otherwise(BINS - 1).cast("int")


def top_p_long(probs: DataFrame, group: str, item: str, prob: str, p: float, out_col: str = "prob",
               *, hot_rows: int = HOT_ROWS, buckets: int | None = None) -> DataFrame:
    """``group, item, prob``: items whose exclusive cumulative mass is at most ``p``, renormalised.

    The order is that of the array form: falling probability, then rising item.  ``buckets``
    sets the number of ranges of the rows to be put in order (the session's partitions).
    """
    rows = probs.select(F.struct(F.col(group).alias("group")).alias("_g"), F.col(item).alias("_item"), F.col(prob).alias("_q"))
    rows = materialize(rows.filter("_q is not null").withColumn("_bin", _bin(F.col("_q"))), "nucleus-rows")
    falling = Window.partitionBy("_g").orderBy("_bin")
    before = F.coalesce(F.sum("_mass").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    upto = F.sum("_mass").over(falling.rowsBetween(Window.unboundedPreceding, 0))
    limit = F.lit(float(p))
    classes = rows.groupBy("_g", "_bin").agg(F.sum("_q").alias("_mass"), F.count("*").alias("_rows"))
    cuts = materialize(
        classes.withColumn("_before", before).withColumn("_upto", upto).groupBy("_g").agg(
            F.coalesce(F.max(F.when(F.col("_upto") <= limit, F.col("_bin"))), F.lit(-1)).alias("_whole"),
            F.coalesce(F.max(F.when(F.col("_upto") <= limit, F.col("_upto"))), F.lit(0.0)).alias("_base"),
            F.coalesce(F.max(F.when(F.col("_before") <= limit, F.col("_bin"))), F.lit(-1)).alias("_reach"),
            F.sum("_rows").alias("_n")), "nucleus-cuts")
    near = materialize(_with_group_values(rows, cuts, hot_rows).filter("_bin <= _reach"), "nucleus-near")
    edge = near.filter("_bin > _whole").select("_g", "_item", "_q", "_base", (-F.col("_q")).alias("_neg"))
    order = [F.col("_g"), F.col("_neg"), F.col("_item")]
    ranged = edge.repartitionByRange(buckets, *order) if buckets else edge.repartitionByRange(*order)
    edge = materialize(ranged.withColumn("_bucket", F.spark_partition_id()), "nucleus-edge")
    earlier = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = edge.groupBy("_g", "_bucket").agg(F.sum("_q").alias("_mass")).select(
        "_g", "_bucket", F.coalesce(F.sum("_mass").over(earlier), F.lit(0.0)).alias("_ahead"))
    inside = Window.partitionBy("_g", "_bucket").orderBy("_neg", "_item").rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum("_q").over(inside), F.lit(0.0))
    held = edge.withColumn("_run", run).join(ahead, ["_g", "_bucket"]).filter(F.col("_base") + F.col("_ahead") + F.col("_run") <= limit)
    kept = materialize(near.filter("_bin <= _whole").select("_g", "_item", "_q").unionByName(held.select("_g", "_item", "_q")),
                       "nucleus-kept")
    mass = materialize(kept.groupBy("_g").agg(F.sum("_q").alias("_mass"), F.count("*").alias("_n")), "nucleus-mass")
    return _with_group_values(kept, mass, hot_rows).select(
        F.col("_g.group").alias(group), F.col("_item").alias(item), (F.col("_q") / (F.col("_mass") + F.lit(TOP_P_EPS))).alias(out_col))
