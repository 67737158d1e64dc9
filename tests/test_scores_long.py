"""The long form of scores against plain Python and the array form."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import scores as S
from tokenmill.operators import scores_long as L


def _plain(groups, temperature, p):
    out = {}
    for g, scores in groups.items():
        top = max(s / temperature for s in scores)
        exps = [math.exp(s / temperature - top) for s in scores]
        order = sorted((-e / sum(exps), i) for i, e in enumerate(exps))
        run, kept = 0.0, []
        for neg, i in order:
            if run <= p:
                kept.append((i, -neg))
            run -= neg
        mass = sum(q for _, q in kept)
        out |= {(g, i): q / (mass + 1e-12) for i, q in kept}
    return out


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(8)
    made = {g: [rng.gauss(0, 3) for _ in range(rng.randrange(1, 30))] for g in range(25)}
    made[100] = [rng.gauss(0, 2) for _ in range(3000)]
    made[101] = [1.0] * 1001  # all alike: one class, cut by the item
    made[102] = [0.0, -2000.0, 3.0, 3.0]  # one probability is zero
    made[None] = [1.0, 2.0, 3.0]
    return made


@pytest.mark.parametrize(("p", "hot", "buckets"), [(0.9, 500, 16), (0.33, 1 << 22, None), (0.0, 2, 3), (1.5, 1, 5)])
def test_cut_equals_a_plain_version(spark, groups, p, hot, buckets):
    rows = [(g, i, s) for g, scores in groups.items() for i, s in enumerate(scores)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([*rows, (7, 1000, None)], "g long, item int, score double").repartition(6)
    probs = L.softmax_long(df, "g", "item", "score", 0.7, hot_rows=hot)
    assert probs.columns == ["g", "item", "prob"] and probs.count() == len(rows)
    got = {(r.g, r.item): r.prob for r in L.top_p_long(probs, "g", "item", "prob", p, hot_rows=hot, buckets=buckets).collect()}
    want = _plain(groups, 0.7, p)
    assert set(got) == set(want)
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-300) for k in want)


def test_cut_equals_the_array_form(spark):
    df = spark.range(40).select(F.col("id").alias("g"), F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: F.sin(
        i * (F.col("id") + 1)) * 4).alias("logits"))
    array = S.top_p(S.softmax(df, "logits", "probs", 0.8), "probs", 0.85).select("g", F.explode("dist").alias("d"))
    want = {(r.g, r.d.item): r.d.p for r in array.collect()}
    long = df.select("g", F.posexplode("logits").alias("item", "score"))
    got = L.top_p_long(L.softmax_long(long, "g", "item", "score", 0.8), "g", "item", "prob", 0.85, "share")
    got = {(r.g, r.item): r.share for r in got.collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, item int, score double")
    assert L.top_p_long(L.softmax_long(none, "g", "item", "score"), "g", "item", "prob", 0.9).collect() == []
