import random
import zlib
from collections import defaultdict

from llm_cases import SF_SMALL, clashing_docs, edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as E
from tokenmill.llm import sharding as S
from tokenmill.llm.ranges import among, with_range


def check_shards(rows, n_shards, largest):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    sizes = [sum(r.size for r in shards.get(s, [])) for s in range(n_shards)]
    assert set(shards) <= set(range(n_shards))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert max(sizes) - min(sizes) <= 2 * largest


def test_with_range_counts_bounds_at_or_below_the_key(spark):
    bounds = [(0, 5), (3, 1), (3, 4), (9, 9)]
    df = spark.createDataFrame([(a, b) for a in (-1, 0, 3, 9, 10) for b in (0, 1, 4, 5, 9)], "a long, b long")
    for r in with_range(df, [F.col("a"), F.col("b")], bounds, "range").collect():
        assert r["range"] == sum(b <= (r.a, r.b) for b in bounds)
    words = with_range(spark.createDataFrame([("m",), ("a",), ("z",)], "w string"), [F.col("w")], [("b",), ("n",)], "range")
    assert {r.w: r["range"] for r in words.collect()} == {"a": 0, "m": 1, "z": 2}


def test_query_places_every_document(spark):
    rows = E.queries()["op1_sharding"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    check_shards(rows, 24, max(r.size for r in rows))


def test_a_group_of_copies_is_cut_by_id_and_reruns_agree(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 30))
                                  .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    one, two = (S.shard_documents(df, 7).collect() for _ in range(2))
    assert {(r.doc_id, r.shard, r.slot) for r in one} == {(r.doc_id, r.shard, r.slot) for r in two}
    check_shards(one, 7, max(r.size for r in one))
    shards_of = defaultdict(set)
    for r in one:
        shards_of[r.text].add(r.shard)
    assert sum(len(s) > 1 for t, s in shards_of.items() if not t.startswith("hot")) == 0


def test_shard_ends_follow_the_sizes_exactly_at_many_ranges(spark):
    rng = random.Random(3)
    sizes = [int(rng.lognormvariate(5, 1.2)) + 1 for _ in range(4000)]
    df = spark.createDataFrame([(i, f"{i} ".ljust(n, "x")) for i, n in enumerate(sizes)], "doc_id long, text string")
    keys = df.select(F.xxhash64("text").alias("h"), F.xxhash64("doc_id").alias("g"), F.lit(0).cast("long").alias("c"),
                     S.text_size(F.col("text")).alias("size"))
    rows = sorted((r.h, r.g, r.c, r.size) for r in keys.collect())
    total, n_shards = sum(s for *_, s in rows), 24
    bounds = [r[:3] for r in rows[10::10]]
    expected, upto, middles = [], 0, []
    for *key, s in rows:
        upto += s
        middles.append((2 * upto - s, tuple(key)))
    for shard in range(1, n_shards):
        expected.append(next(k for m, k in middles if m > 2 * (total * shard // n_shards)))
    size, _ = S._measure(keys, bounds)
    assert S._shard_ends(keys, bounds, size, n_shards) == expected
    placed = defaultdict(int)
    for r in S.shard_documents(df, n_shards).collect():
        placed[r.shard] += r.size
    assert len(placed) == n_shards and max(placed.values()) - min(placed.values()) <= max(s for *_, s in rows)


def test_among_finds_exactly_the_chosen_keys(spark):
    df = spark.createDataFrame([(a, b) for a in (-1, 0, 3, 9) for b in (0, 1, 5)] + [(None, 1)], "a long, b long")
    for chosen in ([], [(0, 5)], [(-1, 0), (0, 1), (9, 5)]):
        held = among(df, [F.col("a"), F.col("b")], chosen, "held").filter("held").drop("held").collect()
        assert sorted(tuple(r) for r in held) == sorted(chosen)


def check_rows_kept(df, rows, columns):
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in rows))) == sorted(
        map(repr, (tuple(r[c] for c in columns) for r in df.collect())))


def test_copies_of_one_row_are_cut(spark):
    copies = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("again " * 30).alias("text"),
                                      F.col("id").alias("extra"))
    others = spark.range(2000).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("text "), F.repeat(
        F.lit("x"), (F.col("id") % 90).cast("int")), F.col("id").cast("string")).alias("text"), F.col("id").alias("extra"))
    few = others.filter("extra % 3 = 0")  # some keys of two rows, most of which no shard end meets
    df = copies.union(others).union(few).repartition(5)
    rows = S.shard_documents(df, 24).collect()
    check_rows_kept(df, rows, ["doc_id", "text", "extra"])
    assert {r.shard for r in rows} == set(range(24))
    check_shards(rows, 24, max(r.size for r in rows) / 2)


def test_rows_without_id_or_text_and_rows_all_alike_are_cut(spark):
    null = F.lit(None)
    empty = spark.range(3000).select(null.cast("long").alias("doc_id"), null.cast("string").alias("text"))
    some = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"))
    no_ids = spark.range(900).select(null.cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 9).alias("text"))
    alike = spark.range(997).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    for df, shards in ((empty.union(some), 24), (no_ids, 24), (alike, 5), (alike.limit(3), 7)):
        rows = S.shard_documents(df, shards).collect()
        check_rows_kept(df, rows, ["doc_id", "text"])
        check_shards(rows, shards, max(r.size for r in rows) / 2)


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    rows = S.shard_documents(edge_docs, 3).collect()
    assert len(rows) == edge_docs.count()
    assert {r.size for r in rows if not r.text} == {8}
    check_shards(rows, 3, max(r.size for r in rows))
    named = S.shard_documents(clashing_docs, 3)
    assert sorted(c for c in named.columns if c.lower() in ("size", "shard", "slot")) == ["shard", "size", "slot"]
    assert named.filter("size >= 8").count() == edge_docs.count() and "a.b" in named.columns
    assert S.shard_documents(no_docs, 3).count() == 0
