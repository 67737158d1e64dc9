"""Operators over scored rows: softmax, nucleus cut, seeded and greedy choice, loss.

Scores arrive in array form (``logits array<double>`` per row, one row per
position).  Every operator is row-local — higher-order functions over the
array — so nothing shuffles and a row's cost is O(V log V) at most.  The
nucleus cut needs an exclusive prefix sum over sorted probabilities; since the
kept items form a prefix of that order, one ``aggregate`` counts how many to
keep instead of materialising the running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.constants import MIN_TEMPERATURE, TOP_P_EPS
from tokenmill.functions.ids import let


NEG_INF = float("-inf")


def softmax_col(logits: Column, temperature: float = 1.0) -> Column:
    """Temperature softmax of an array, ``T = max(T, 1e-6)``.

    The max and the total are lambda variables of ``aggregate`` finishers, so
    each is computed once per row (a projected column referenced inside a
    lambda would be re-evaluated per element).
    """
    t = max(float(temperature), MIN_TEMPERATURE)
    scaled = F.transform(logits, lambda x: x.cast("double") / F.lit(t))
    return F.aggregate(
        scaled,
        F.lit(NEG_INF),
        lambda a, x: F.greatest(a, x),
        lambda m: F.aggregate(
            F.transform(scaled, lambda x: F.exp(x - m)),
            F.lit(0.0),
            lambda a, x: a + x,
            lambda tot: F.transform(scaled, lambda x: F.exp(x - m) / tot),
        ),
    )


def softmax(df: DataFrame, logits_col: str, out_col: str = "probs", temperature: float = 1.0) -> DataFrame:
    return df.withColumn(out_col, softmax_col(F.col(logits_col), temperature))


def top_p_col(probs: Column, p: float) -> Column:
    """Nucleus cut: keep items whose *exclusive* cumulative mass is ≤ p, renormalised.

    ``array<struct<item:int, p:double>>`` in descending-probability order
    (ties: lower item first).  The item that crosses the threshold is kept, so
    at least one item remains.  The kept items are a prefix of the sorted
    order, so one ``aggregate`` counts them; no running-sum array is built.
    """
    srt = F.array_sort(F.transform(probs, lambda q, i: F.struct((-q).alias("neg"), i.alias("item"), q.alias("p"))))
    init = F.struct(F.lit(0.0).alias("run"), F.lit(0).alias("n"))

    def step(acc, x):
        return F.struct(
            (acc["run"] + x["p"]).alias("run"),
            (acc["n"] + F.when(acc["run"] <= F.lit(float(p)), 1).otherwise(0)).alias("n"),
        )

    def finish(acc):
        return let(
            F.slice(srt, 1, acc["n"]),
            lambda kept: F.aggregate(
                kept,
                F.lit(0.0),
                lambda a, x: a + x["p"],
                lambda mass: F.transform(
                    kept, lambda x: F.struct(x["item"].alias("item"), (x["p"] / (mass + F.lit(TOP_P_EPS))).alias("p"))
                ),
            ),
        )

    return let(srt, lambda s: F.aggregate(s, init, step, finish))


def top_p(df: DataFrame, probs_col: str, p: float, out_col: str = "dist") -> DataFrame:
    return df.withColumn(out_col, top_p_col(F.col(probs_col), p))


def md5_uniform(seed: int, key: Column) -> Column:
    """Reproducible uniform draw in [0, 1) per key: 15 hex digits of md5("seed:key")."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("double") / F.lit(float(16**15))


def weighted_choice(dist: Column, u: Column) -> Column:
    """First item whose cumulative mass exceeds ``u`` (last item if rounding leaves none)."""
    init = F.struct(F.lit(0.0).alias("run"), F.lit(-1).alias("pick"))
    res = F.aggregate(
        dist,
        init,
        lambda acc, x: F.struct(
            (acc["run"] + x["p"]).alias("run"),
            F.when((acc["pick"] < 0) & (acc["run"] + x["p"] > u), x["item"]).otherwise(acc["pick"]).alias("pick"),
        ),
    )["pick"]
    return F.when(res >= 0, res).otherwise(F.element_at(dist, -1)["item"])


def greedy_choice(logits: Column) -> Column:
    """Arg-max index (first one on ties)."""
    best = F.array_max(F.transform(logits, lambda x, i: F.struct(x.cast("double").alias("s"), (-i).alias("neg"))))
    return -best["neg"]


def cross_entropy_col(logits: Column, target: Column) -> Column:
    """``logsumexp(logits) - logits[target]`` (target is 0-based)."""
    xs = F.transform(logits, lambda x: x.cast("double"))
    return F.aggregate(
        xs,
        F.lit(NEG_INF),
        lambda a, x: F.greatest(a, x),
        lambda m: F.log(F.aggregate(xs, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
        + m
        - F.element_at(xs, (target + 1).cast("int")),
    )


def cross_entropy(df: DataFrame, logits_col: str, target_col: str, out_col: str = "ce") -> DataFrame:
    return df.withColumn(out_col, cross_entropy_col(F.col(logits_col), F.col(target_col)))


def eval_loss(df: DataFrame, logits_col: str, target_col: str, batch_col: str) -> DataFrame:
    """Mean cross-entropy within each batch, then the mean of batch means (0.0 if none)."""
    return mean_of_batches(cross_entropy(df, logits_col, target_col, "_ce"), "_ce", batch_col)


def mean_of_batches(df: DataFrame, loss_col: str, batch_col: str) -> DataFrame:
    """``loss, n_batches`` from the losses of single rows."""
    per_batch = df.groupBy(batch_col).agg(F.avg(loss_col).alias("_m"))
    return per_batch.agg(
        F.coalesce(F.avg("_m"), F.lit(0.0)).alias("loss"),
        F.count(F.lit(1)).alias("n_batches"),
    )
