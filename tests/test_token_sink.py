"""The cache that a stream writes equals the batch job's, whatever the stream went through."""

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import bpe as B
from tokenmill.plans.tokenizer_jobs import corpus_token_cache
from tokenmill.sources import corpus as IO
from tokenmill.streaming import token_sink as TS

MODEL = B.BpeModel(merges=[(97, 98), (256, 99), (32, 97)], vocab_size=260, eot_id=259)


def _write(spark, path, texts, mode="append"):
    IO.write_corpus(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), path, mode=mode)


def _blocks(df):
    rows = [(r.block_id, list(r.ids)) for r in df.collect()]
    assert len({b for b, _ in rows}) == len(rows)
    return sorted(rows)


def _batch_job(spark, tmp_dir, block_size):
    return _blocks(corpus_token_cache(spark, f"{tmp_dir}/in", MODEL, f"{tmp_dir}/batch", block_size=block_size))


def _run(spark, tmp_dir, block_size):
    return TS.stream_token_cache(spark, f"{tmp_dir}/in", MODEL, f"{tmp_dir}/cache", f"{tmp_dir}/ck", block_size=block_size)


class Died(Exception):
    pass


def test_restarts_replays_and_crashes_leave_each_token_once(spark, tmp_dir, monkeypatch):
    size, runs = 7, [["abc abc", "", "b"], ["x" * 30, "abab"], ["c"], ["abc " * 9, "é"]]
    _write(spark, f"{tmp_dir}/in", runs[0])
    _run(spark, tmp_dir, size)
    assert _blocks(TS.read_stream_cache(spark, f"{tmp_dir}/cache")[0]) == _batch_job(spark, tmp_dir, size)

    # a replayed batch: the row is there, though the stream did not get to record it
    sink = TS.TokenSink(spark, f"{tmp_dir}/cache", MODEL, f"{tmp_dir}/ck", size)
    again = spark.createDataFrame([("run-0/part-0", 0, "other")], "file_path string, block_start long, value string")
    sink(again, 0)

    # dies between its blocks and its row: nothing of the batch counts, and the next run does it again
    _write(spark, f"{tmp_dir}/in", runs[1])
    create = type(spark).createDataFrame
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda self, data, schema=None, *a, **k: (_ for _ in ()).throw(Died()) if schema == TS.LEDGER else create(self, data, schema, *a, **k))
        with pytest.raises(Exception, match="Died"):
            _run(spark, tmp_dir, size)
    assert TS.last_row(spark, f"{tmp_dir}/cache")["batch_id"] == 0
    for texts in (None, runs[2], runs[3]):
        if texts:
            _write(spark, f"{tmp_dir}/in", texts)
        meta = _run(spark, tmp_dir, size)
        blocks, _ = TS.read_stream_cache(spark, f"{tmp_dir}/cache")
        got = _blocks(blocks)
        assert got == _batch_job(spark, tmp_dir, size)
        assert meta["n_tokens"] == sum(len(ids) for _, ids in got)
    assert _run(spark, tmp_dir, size)["batch_id"] == meta["batch_id"]  # nothing new


def test_the_cache_knows_its_stream_and_tokenizer(spark, tmp_dir):
    with pytest.raises(ValueError):
        TS.read_stream_cache(spark, f"{tmp_dir}/cache")
    _write(spark, f"{tmp_dir}/in", ["", "a"])
    assert _run(spark, tmp_dir, 8)["n_tokens"] == 3
    for change in ({"block_size": 9}, {"model": B.BpeModel(merges=[(97, 98)], vocab_size=260, eot_id=259)}, {"checkpoint_path": f"{tmp_dir}/other"}):
        args = {"model": MODEL, "checkpoint_path": f"{tmp_dir}/ck", "block_size": 8, **change}
        with pytest.raises(ValueError, match="another stream"):
            TS.TokenSink(spark, f"{tmp_dir}/cache", **args)


def test_open_ends_and_several_files_in_a_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"ab<|endoftext|>\r\n<|endoftext|> c")
    (folder / "b.txt").write_bytes(b"<|endoftext|>abc\n\n<|endoftext|>\n\n")
    _run(spark, str(tmp_path), 100)
    blocks, _ = TS.read_stream_cache(spark, f"{tmp_path}/cache")
    assert _blocks(blocks) == [(0, [256, 259, 259, 99, 259, 259, 257, 259])]
    assert blocks.select(F.size("ids")).first()[0] == 8
