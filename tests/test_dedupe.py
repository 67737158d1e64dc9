"""Survivors of exact deduplication: smallest key, one row, also with ties and null keys."""

from pyspark.sql import functions as F

from tokenmill.operators import dedupe as D


def test_one_survivor_with_ties_and_null_keys(spark):
    rows = [(3, "a b"), (1, " a  b"), (1, "a b "), (None, "c"), (5, "c"), (None, "c "), (7, "hot"), *[(10 + i, "hot") for i in range(500)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for threshold in ("10485760", "-1"):  # with and without automatic broadcasts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = D.dedupe_exact(df, ["doc_id"]).collect()
        assert sorted((r.doc_id or 0, r.text.split()) for r in got) == [(0, ["c"]), (1, ["a", "b"]), (7, ["hot"])]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), (F.col("id") % 7).cast("string")).alias("text"))
    plan = D.dedupe_exact(df, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 3  # fingerprints, their keys, and the rows; the last step uses the rows' partitioning


def test_ingest_report_in_one_pass(spark):
    df = spark.createDataFrame([(1, " a"), (2, "a "), (3, None), (4, " \t"), (5, "bé")], "doc_id long, text string")
    r = D.ingest_report(df).first()
    assert r.asDict() == {"rows_read": 5, "non_empty": 3, "blank": 2, "duplicates": 1, "output_bytes": 1 + 17 + 3 + 17}
    assert D.ingest_report(df, dedupe=False).first().asDict() == {"rows_read": 5, "non_empty": 3, "blank": 2, "duplicates": 0, "output_bytes": 1 + 17 + 1 + 17 + 3 + 17}
    assert D.ingest_report(df.limit(0)).first().rows_read == 0
