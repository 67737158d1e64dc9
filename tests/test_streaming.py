"""Structured Streaming runs with availableNow triggers."""

import os

from pyspark.sql import functions as F

from tokenmill.operators import bpe as B
from tokenmill.sources import corpus as IO
from tokenmill.streaming import ops as ST


def test_resume_only_emits_new_documents(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    df = spark.createDataFrame([(0, "a b"), (1, "a  b"), (2, "c")], "doc_id long, text string")
    IO.write_corpus(df.filter("doc_id < 2"), src, order_cols=["doc_id"])
    stream = ST.stream_dedupe(ST.stream_clean(ST.stream_corpus(spark, src)))
    ST.run_available_now(stream, sink, ck)
    assert spark.read.parquet(sink).count() == 1  # "a b" and "a  b" share a fingerprint
    IO.write_corpus(df.filter("doc_id = 2").union(df.filter("doc_id = 0")), src, order_cols=["doc_id"], mode="append")
    ST.run_available_now(stream, sink, ck)
    out = sorted(r.text for r in spark.read.parquet(sink).collect())
    # only "c" is new: the re-sent "a b" is still in the dedupe state
    assert out == ["a b", "c"] or out == ["a  b", "c"]


def test_a_stream_on_an_existing_corpus_emits_only_new_documents(spark, tmp_dir):
    from tokenmill.sources import fingerprints as FP

    old, src, sink, ck = (f"{tmp_dir}/{name}" for name in ("old", "in", "out", "ck"))
    df = spark.createDataFrame([(0, "a b"), (1, "c"), (2, "a  b"), (3, "d"), (4, "d "), (5, "e")], "doc_id long, text string")
    FP.append_deduped(df.filter("doc_id < 2"), old)
    IO.write_corpus(df.filter("doc_id in (1, 2, 3)"), src, order_cols=["doc_id"])
    stream = ST.stream_dedupe(ST.stream_clean(ST.stream_corpus(spark, src)), known=FP.seen_fingerprints(spark, old))
    ST.run_available_now(stream, sink, ck)
    assert [r.text for r in spark.read.parquet(sink).collect()] == ["d"]
    IO.write_corpus(df.filter("doc_id in (0, 4, 5)"), src, order_cols=["doc_id"], mode="append")
    ST.run_available_now(stream, sink, ck)
    assert sorted(r.text for r in spark.read.parquet(sink).collect()) == ["d", "e"]


def test_local_duplicates_are_dropped_in_bounded_copies(monkeypatch):
    import pyarrow as pa

    class Frame:
        schema = None

        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(ST, "LOCAL_ROWS", 3)
    whole = pa.record_batch({"fp": [f"f{i}" for i in range(8)], "text": ["t"] * 8})
    twice = pa.record_batch({"fp": ["a", "b", "a", "c", None, "d", None, "b", "e"], "text": [f"t{i}" for i in range(9)]})
    out = list(ST.drop_local_duplicates(Frame(), "fp")(iter([whole, twice, twice.slice(0, 0)])))
    assert out[0] is whole  # nothing to drop, nothing copied
    assert [b.num_rows for b in out[1:]] == [3, 3, 0]
    assert [t for b in out[1:] for t in b["text"].to_pylist()] == ["t0", "t1", "t3", "t4", "t5", "t8"]


def test_freed_memory_goes_back_to_the_system():
    """In a process of its own: small blocks below a live one, as allocators keep them."""
    import subprocess
    import sys

    code = """
import re
from tokenmill.session import freeing
import numpy as np
def held(): return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
kept = []
def run(batches):
    for n in batches:
        many = [np.ones(10_000) for _ in range(n)]
        kept.append(np.ones(100))
        yield held()
peak = max(freeing(run)(iter([2_000])))
assert held() < peak - 100, (held(), peak)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_bounded_batches(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    df = spark.range(6).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc "), F.col("id").cast("string")).alias("text"))
    IO.write_corpus(df.repartition(3), src)
    progress = ST.run_available_now(ST.stream_clean(ST.stream_corpus(spark, src, max_files_per_trigger=1)), sink, ck)
    assert progress["batches"] == 3
    assert spark.read.parquet(sink).count() == 6


def test_local_duplicates_dropped_before_shuffle(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"cold{i}") for i in range(30)], "doc_id long, fp string")
    out = ST.drop_local_duplicates(df.coalesce(1), "fp").collect()
    assert sorted(r.fp for r in out) == sorted({r.fp for r in df.collect()})
    assert [r.doc_id for r in out if r.fp == "hot"] == [1]


def test_bounded_state_dedupe(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    df = spark.createDataFrame([(0, "a b"), (1, "a  b"), (2, "c")], "doc_id long, text string")
    IO.write_corpus(df, src, order_cols=["doc_id"])
    stream = ST.stream_dedupe(ST.stream_clean(ST.stream_corpus(spark, src)), ttl="1 hour")
    ST.run_available_now(stream, sink, ck)
    out = spark.read.parquet(sink)
    assert out.count() == 2 and sorted(r.fp for r in out.collect()) == sorted({r.fp for r in out.collect()})


def test_stream_encode_strips_keeps_empties_and_tails(spark):
    model = B.BpeModel(merges=[(97, 98)], vocab_size=258, eot_id=257)
    rows = [(0, " ab ", False), (1, "", False), (2, None, None), (3, " b", True), (4, " ", True)]
    df = spark.createDataFrame(rows, "i int, text string, tail boolean")
    got = {r.i: list(r.ids) for r in ST.stream_encode(df, model, tail_col="tail").collect()}
    assert got == {0: [256, 257], 1: [257], 2: [257], 3: [98]}


def test_local_duplicates_per_batch(spark):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(500)], "i long, k string").coalesce(1)
    kept = ST.drop_local_duplicates(df, "k").collect()
    assert {r.i for r in kept} >= set(range(7)) and len(kept) <= 7 * 1 + 7
