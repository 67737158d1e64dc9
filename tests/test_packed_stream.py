"""Packed streams: windows, batches and cache blocks cut from them without a shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmill.functions.fused import map_batches
from tokenmill.operators import packed_stream as P
from tokenmill.operators import windows as W
from tokenmill.sources import token_cache as TC

IDS = "doc_id long, ids array<int>"


@pytest.fixture
def small(monkeypatch):
    """Many rows, tasks and batches from few tokens."""
    for name, value in (("ROW_TOKENS", 37), ("HELD_SAMPLES", 400), ("LEAST_SAMPLES", 100), ("HELD_BYTES", 8000), ("BATCH_WINDOWS", 16),
                        ("DRAWN_AT_ONCE", 64), ("TASK_BLOCK_TOKENS", 300)):
        monkeypatch.setattr(P, name, value)
    monkeypatch.setattr(W, "BROADCAST_WINDOW_ROWS", 10)


def _docs(spark, flat, size=50):
    rows = [(i, flat[i * size:(i + 1) * size]) for i in range(-(-len(flat) // size))]
    return spark.createDataFrame(rows, IDS).repartition(5)


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_packed_ids_are_the_ids():
    rng = np.random.default_rng(1)
    for ids in ([], [5], [256] * 3, [0, 255, 256, 70_000, 2**31 - 1] * 4, [-1, 3], rng.integers(0, 256, 999), [*rng.integers(0, 256, 999), 256, 70_000]):
        a = np.array(ids, np.int32)
        assert P.unpack_ids(P.pack_ids(a)).tolist() == a.tolist()
    assert len(P.pack_ids(np.array([7] * 1000 + [256], np.int32))) < 1020


def test_rows_are_read_by_position(spark, small):
    flat = [(i * i) % 70_001 for i in range(1003)]
    stream = P.pack_documents(_docs(spark, flat), ["doc_id"])
    assert stream.n_tokens == 1003 and stream.top == max(flat) and stream.n.max() == 37 and len(stream.n) > 25
    for begin, end in ((0, 1003), (36, 38), (500, 777), (1002, 1003)):
        got = [(lo, ids.tolist()) for lo, ids in stream.rows(begin, end)]
        assert got[0][0] <= begin and got[-1][0] + len(got[-1][1]) >= end
        assert all(ids == flat[lo:lo + len(ids)] for lo, ids in got)
        assert all(a + len(x) == b for (a, x), (b, _) in zip(got, got[1:], strict=False))


def test_f1_f3_many_windows_are_not_shuffled(spark, small, monkeypatch):
    flat = [(i * i) % 70_001 for i in range(1500)]
    for size, n in ((50, None), (50, 4000), (3, None)):
        if size == 3:  # rows shorter than a window
            monkeypatch.setattr(P, "ROW_TOKENS", 7)
            assert P.pack_documents(_docs(spark, flat, size), ["doc_id"]).n.max() == 7
        ex, k = W.training_examples(_docs(spark, flat, size), ["doc_id"], 16, n, block_size=64)
        assert "Exchange" not in _plan(ex)
        rows = ex.collect()
        assert k == (n or 1500 - 17) and sorted(r.sample_id for r in rows) == list(range(k))
        assert all(r.x == flat[r.start:r.start + 16] and r.y == flat[r.start + 1:r.start + 17] for r in rows)
        starts = {r.sample_id: r.start for r in W.sample_windows(spark, 1500, 16, n).collect()}
        assert starts == {r.sample_id: r.start for r in rows}
        sums = W.window_checksums(ex)
        assert _plan(sums).count("MapInArrow") == _plan(ex).count("MapInArrow")  # x and y don't leave the worker
        got = {r.sample_id: (r.start, r.x_sum, r.x_wsum, r.y_wsum) for r in sums.collect()}
        assert got == {r.sample_id: (r.start, sum(r.x), sum(i * v for i, v in enumerate(r.x, 1)), sum(i * v for i, v in enumerate(r.y, 1))) for r in rows}
    with pytest.raises(ValueError):
        W.training_examples(_docs(spark, flat[:33]), ["doc_id"], 32)


def test_f1_batch_sums_are_made_before_the_shuffle(spark, monkeypatch):
    from conftest import SF_SMALL
    from tokenmill.plans import queries as Q

    want = sorted(map(tuple, Q.q_batch_examples(spark, SF_SMALL).collect()))
    monkeypatch.setattr(W, "BROADCAST_WINDOW_ROWS", 10)
    found = Q.q_batch_examples(spark, SF_SMALL)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 1000
    assert "REPARTITION_BY_COL" not in _plan(found)


def test_f4_batches_are_packed_without_a_shuffle(spark, small):
    flat = [(i * i) % 70_001 for i in range(1500)]
    ex, k = W.training_examples(_docs(spark, flat), ["doc_id"], 16)
    rows = {r.sample_id: r for r in ex.collect()}
    for size in (1, 32, 700, 5000):
        for drop_last in (True, False):
            packed = W.packed_batches(ex, size, k, drop_last=drop_last)
            want = [range(i, min(i + size, k)) for i in range(0, k, size) if not drop_last or i + size <= k]
            got = sorted(packed.collect())
            assert [r.batch_id for r in got] == list(range(len(want)))
            assert all(r.x == [rows[s].x for s in w] and r.y == [rows[s].y for s in w] for r, w in zip(got, want, strict=True))
            if want:
                assert "Exchange" not in _plan(packed)
                sums = {r.batch_id: r for r in W.packed_checksums(packed, 16).collect()}
                assert all(sums[r.batch_id].x_wsum == sum(i * sum(x) for i, x in enumerate(r.x, 1)) for r in got)
                assert all(sums[r.batch_id].y_wsum == sum(i * sum(y[:15]) for i, y in enumerate(r.y, 1)) for r in got)
    cut = ex.filter("sample_id <> 5")  # no longer the windows that were cut
    with pytest.raises(Exception, match="missing or repeated"):
        W.packed_batches(cut, 10, k).collect()


def test_f2_f5_caches_are_written_and_cut_without_a_shuffle(spark, small, tmp_dir):
    flat = [(i * i) % 70_001 for i in range(1500)]
    for part_blocks, halo in ((2, 0), (4, 20), (1 << 15, 0)):
        blocks = W.token_blocks(_docs(spark, flat), ["doc_id"], block_size=32, halo=halo)
        assert "Exchange" not in _plan(blocks)
        assert {r.block_id: r.ids for r in blocks.collect()} == {b: flat[32 * b:32 * b + 32 + halo] for b in range(47)}
        path = f"{tmp_dir}/c{part_blocks}"
        TC.write_token_cache(blocks, path, source_path="x", source_size_bytes=1, vocab_size=70_002, eot_token_id=70_001, block_size=32,
                             halo=halo, part_blocks=part_blocks)
        read, meta = TC.read_token_cache(spark, path)
        assert meta["n_tokens"] == 1500 and {r.block_id: r.ids for r in read.collect()} == {b: flat[32 * b:32 * b + 32 + halo] for b in range(47)}
        files = [f.split("part=")[1].split("/")[0] for f in read.inputFiles()]
        assert part_blocks > 4 or len(files) == len(set(files)) == -(-47 // part_blocks)
        ex, k = TC.cached_examples(spark, path, 16)
        assert "Exchange" not in _plan(ex)
        rows = ex.collect()
        assert sorted(r.sample_id for r in rows) == list(range(k))
        assert all(r.x == flat[r.start:r.start + 16] and r.y == flat[r.start + 1:r.start + 17] for r in rows)
    assert P.pack_blocks(read.filter("block_id <> 3"), 32, 1500) is None
    assert P.pack_blocks(read.union(read.filter("block_id = 3")), 32, 1500) is None
    assert P.pack_blocks(read.filter("block_id < 46"), 32, 1500) is None


def test_repeated_and_null_keys_give_the_rows_of_the_joins(spark, small, monkeypatch):
    flat = [(i * 7) % 251 for i in range(1500)]
    docs = _docs(spark, flat)
    odd = [docs.union(docs.filter("doc_id = 3")), docs.withColumn("doc_id", F.expr("nullif(doc_id, 29)")), docs.withColumn("ids", F.expr("if(doc_id = 29, null, ids)"))]
    assert [P.pack_documents(d, ["doc_id"]) for d in odd] == [None, None, None]
    assert P.pack_documents(docs.withColumn("doc_id", F.col("doc_id").cast("double")), ["doc_id"]) is None
    assert P.pack_documents(docs.withColumn("two", F.col("doc_id") % 2), ["two", "doc_id"]).n_tokens == 1500
    blocks = W.token_blocks(odd[0], ["doc_id"], block_size=64, halo=16)
    sums = W.window_checksums(W.training_examples(odd[0], ["doc_id"], 16, block_size=64)[0])
    monkeypatch.setattr(W, "pack_documents", lambda *a: None)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, W.token_blocks(odd[0], ["doc_id"], block_size=64, halo=16).collect()))
    want = W.window_checksums(W.training_examples(odd[0], ["doc_id"], 16, block_size=64)[0])
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, want.collect()))


def test_steps_run_in_one_pass(spark):
    def add(batches):
        for b in batches:
            yield b.set_column(0, "id", P.pc.add(b.column(0), 1))

    once = map_batches(spark.range(5), add, "id long")
    both = map_batches(once, add, "id long")
    assert sorted(r.id for r in both.collect()) == [2, 3, 4, 5, 6] and _plan(both).count("MapInArrow") == _plan(once).count("MapInArrow")
    assert sorted(r.id for r in map_batches(once.filter("id > 2"), add, "id long").collect()) == [4, 5, 6]
