"""A corpus is in one state or the other, whatever step a writer dies in."""

import glob

import pytest

from tokenmill.operators import chunks as K
from tokenmill.sources import commits as CM
from tokenmill.sources import corpus as IO
from tokenmill.sources.token_cache import source_size


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _texts(spark, path):
    return [r.text for r in IO.with_sequence(IO.read_corpus(spark, path)).orderBy("doc_seq").collect()]


class Died(Exception):
    pass


def _dies(*_args, **_kw):
    raise Died


STEPS = ["next_run", "commit_run", "drop_replaced"]


@pytest.mark.parametrize("mode", ["overwrite", "append"])
@pytest.mark.parametrize("step", STEPS)
def test_a_writer_that_dies(spark, tmp_dir, monkeypatch, mode, step):
    path = f"{tmp_dir}/c"
    IO.write_corpus(_docs(spark, "a", "b"), path, order_cols=["doc_id"])
    IO.write_corpus(_docs(spark, "c"), path, order_cols=["doc_id"], mode="append")
    old, new = ["a", "b", "c"], ["x", "y"] if mode == "overwrite" else ["a", "b", "c", "x", "y"]
    size = source_size(spark, path)
    with monkeypatch.context() as m:
        m.setattr(IO, step, _dies)
        if step != "drop_replaced" or mode == "overwrite":
            with pytest.raises(Died):
                IO.write_corpus(_docs(spark, "x", "y"), path, order_cols=["doc_id"], mode=mode)
    committed = step == "drop_replaced"
    if not committed:
        assert _texts(spark, path) == old and source_size(spark, path) == size
        assert K.raw_file_layout(spark, path).count() >= 3
        IO.write_corpus(_docs(spark, "x", "y"), path, order_cols=["doc_id"], mode=mode)  # runs again beside what is left
    elif mode == "append":
        IO.write_corpus(_docs(spark, "x", "y"), path, order_cols=["doc_id"], mode=mode)
    assert _texts(spark, path) == new
    CM.vacuum_corpus(spark, path)
    assert _texts(spark, path) == new
    assert len(glob.glob(f"{path}/run-*")) == len(CM.committed_runs(spark, path))


def test_a_job_that_fails_while_writing(spark, tmp_dir):
    from pyspark.sql import functions as F

    path = f"{tmp_dir}/c"
    IO.write_corpus(_docs(spark, "a"), path)
    bad = _docs(spark, "x", "y").repartition(2).withColumn("text", F.when(F.col("doc_id") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="lost"):
            IO.write_corpus(bad, path, mode=mode)
        assert _texts(spark, path) == ["a"]


def test_cleaning_in_place_keeps_the_old_texts_until_the_new_are_committed(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/c"
    IO.write_corpus(_docs(spark, "b", "a", " b", "c"), path, order_cols=["doc_id"])
    before = _texts(spark, path)
    with monkeypatch.context() as m:
        m.setattr(IO, "commit_run", _dies)
        with pytest.raises(Died):
            IO.clean_corpus(spark, path)
    assert _texts(spark, path) == before
    IO.clean_corpus(spark, path)
    assert _texts(spark, path) == ["b", "a", "c"]
    assert CM.vacuum_corpus(spark, path) != []


def test_an_append_that_began_before_an_overwrite(spark, tmp_dir):
    """Runs take effect in the order of their numbers, whichever commits first."""
    path = f"{tmp_dir}/c"
    IO.write_corpus(_docs(spark, "a"), path)
    late = CM.next_run(spark, path)
    _docs(spark, "late").select("text").write.option("lineSep", "\n\n<|endoftext|>\n\n").text(CM.run_path(path, late))
    IO.write_corpus(_docs(spark, "x"), path)
    report = spark.createDataFrame([(1, 21)], "docs bigint, bytes bigint")
    CM.commit_run(spark, path, late, "append", report)
    assert _texts(spark, path) == ["x"]
    IO.write_corpus(_docs(spark, "y"), path, mode="append")
    assert _texts(spark, path) == ["x", "y"]


def test_empty_and_plain_corpora(spark, tmp_path):
    path = str(tmp_path / "c")
    IO.write_corpus(_docs(spark, "a").limit(0), path)
    assert _texts(spark, path) == [] and CM.committed_runs(spark, path) == [0]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "x.txt").write_text("one<|endoftext|>two")
    assert CM.committed_runs(spark, str(plain)) is None and _texts(spark, str(plain)) == ["one", "two"]
    assert CM.vacuum_corpus(spark, str(plain)) == []
    with pytest.raises(ValueError):
        IO.write_corpus(_docs(spark, "a"), path, mode="ignore")
