"""Distributed prefix sums across several range buckets."""

from pyspark.sql import functions as F

from tokenmill.operators.ordered import global_rank, prefix_offsets


def test_prefix_offsets_across_buckets(spark):
    df = spark.range(0, 5000, 7).select(
        (F.col("id") * 13 % 5000).alias("k"), ((F.col("id") % 11) + 1).alias("v")
    ).dropDuplicates(["k"])
    rows = sorted((r.k, r.v) for r in df.collect())
    for buckets in (None, 1, 7):
        got = {r.k: r.offset for r in prefix_offsets(df, ["k"], "v", buckets=buckets).collect()}
        run = 0
        for k, v in rows:
            assert got[k] == run
            run += v


def test_global_rank_composite_key(spark):
    df = spark.createDataFrame([(a, b) for a in range(5) for b in range(40)], "a int, b int").repartition(4)
    got = {(r.a, r.b): r.rank for r in global_rank(df, ["a", "b"], buckets=6).collect()}
    assert [got[k] for k in sorted(got)] == list(range(200))


def test_skip_rows_filters_past_the_nth_key(spark):
    from tokenmill.sources.tables import skip_rows

    df = spark.createDataFrame([(a, b, f"t{a}-{b}") for a in range(6) for b in range(30)], "a int, b int, t string")
    for n in (0, 1, 37, 179, 180, 500):
        got = sorted((r.a, r.b) for r in skip_rows(df.repartition(5), n, ["a", "b"]).collect())
        assert got == sorted((a, b) for a in range(6) for b in range(30))[max(n, 0):]
    single = spark.range(100).withColumnRenamed("id", "doc_id")
    assert sorted(r.doc_id for r in skip_rows(single, 40).collect()) == list(range(40, 100))


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    from tokenmill.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 50)
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "id % 5 AS v")
    rows = ordered.prefix_offsets(df, ["k"], "v", "o").orderBy("k").collect()
    run = 0
    for r in rows:
        assert r.o == run
        run += r.v
    assert ordered.key_at_rank(df, ["k"], 321) == (321,)
