"""Scored-row operators."""

import math

from pyspark.sql import functions as F

from tokenmill.operators import scores as S


def test_nucleus_is_exclusive_prefix(spark):
    df = spark.createDataFrame([([0.5, 0.3, 0.2],)], "probs array<double>")
    dist = S.top_p(df, "probs", 0.5).collect()[0].dist
    assert [d.item for d in dist] == [0, 1]
    assert abs(sum(d.p for d in dist) - 1.0) < 1e-9
    one = S.top_p(df, "probs", 0.0).collect()[0].dist
    assert [d.item for d in one] == [0]


def test_softmax_matches_python(spark):
    logits = [1.0, 2.0, -1.0, 0.5]
    df = spark.createDataFrame([(logits,)], "logits array<double>")
    got = S.softmax(df, "logits", "p", 0.7).collect()[0].p
    m = max(x / 0.7 for x in logits)
    ex = [math.exp(x / 0.7 - m) for x in logits]
    assert all(abs(a - e / sum(ex)) < 1e-12 for a, e in zip(got, ex))


def test_temperature_floor(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "logits array<double>")
    got = S.softmax(df, "logits", "p", 0.0).collect()[0].p
    assert got == [0.0, 1.0]


def test_greedy_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "logits array<double>")
    assert df.select(S.greedy_choice(F.col("logits")).alias("c")).collect()[0].c == 1


def test_weighted_choice_follows_cumulative_mass(spark):
    df = spark.createDataFrame([([0.5, 0.3, 0.2],)], "probs array<double>")
    d = S.top_p(df, "probs", 1.0)
    picks = [d.select(S.weighted_choice(F.col("dist"), F.lit(u)).alias("c")).collect()[0].c for u in (0.1, 0.6, 0.95)]
    assert picks == [0, 1, 2]


def test_eval_loss(spark):
    rows = [(0, [0.0, 0.0], 0), (0, [0.0, 0.0], 1), (1, [math.log(3.0), 0.0], 0)]
    df = spark.createDataFrame(rows, "b long, logits array<double>, t int")
    out = S.eval_loss(df, "logits", "t", "b").collect()[0]
    want = (math.log(2) + -math.log(3 / 4)) / 2
    assert abs(out.loss - want) < 1e-12 and out.n_batches == 2
    empty = S.eval_loss(df.limit(0), "logits", "t", "b").collect()[0]
    assert empty.loss == 0.0
