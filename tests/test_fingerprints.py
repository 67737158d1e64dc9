"""Deduplicated appends through the fingerprint index."""

import pytest

from tokenmill.sources import corpus as IO
from tokenmill.sources import fingerprints as FP


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _texts(spark, path):
    return [r.text for r in IO.with_sequence(IO.read_corpus(spark, path)).orderBy("doc_seq").collect()]


def test_appends_add_only_what_is_new(spark, tmp_dir):
    path = f"{tmp_dir}/c"
    assert FP.append_deduped(_docs(spark, "b", "a", " b", None, "c c"), path).first().docs == 3
    assert FP.append_deduped(_docs(spark, "c  c", "d", "a", "d"), path).first().docs == 1
    assert FP.append_deduped(_docs(spark, "a", "d "), path).first().docs == 0
    assert _texts(spark, path) == ["b", "a", "c c", "d"]
    assert FP.update_index(spark, path) == []
    assert FP.seen_fingerprints(spark, path).count() == 4


def test_an_append_reads_no_old_texts(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/c"
    FP.append_deduped(_docs(spark, "a", "b"), path)
    FP.append_deduped(_docs(spark, "c"), path)
    plan = FP.new_documents(_docs(spark, "a", "x"), path)
    files = [f for f in plan.inputFiles() if path in f]
    assert files and all("/_fps/" in f for f in files)
    assert [r.text for r in plan.collect()] == ["x"]
    monkeypatch.setattr(FP, "read_corpus", lambda *a, **k: pytest.fail("old texts were read"))
    FP.append_deduped(_docs(spark, "a", "x"), path)


def test_an_index_behind_its_corpus_catches_up(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/c"
    IO.write_corpus(_docs(spark, "a", "b"), path, order_cols=["doc_id"])  # by other means
    with monkeypatch.context() as m:
        m.setattr(FP, "index_run", lambda fps, p, run: (_ for _ in ()).throw(KeyError("died")))
        with pytest.raises(KeyError):
            FP.append_deduped(_docs(spark, "x"), path)
    assert _texts(spark, path) == ["a", "b"]
    assert FP.append_deduped(_docs(spark, "b", "c"), path).first().docs == 1
    step = FP.index_run
    with monkeypatch.context() as m:  # dies after the run is committed, before it is indexed
        m.setattr(FP, "index_run", lambda fps, p, run: (_ for _ in ()).throw(KeyError("died")))
        with pytest.raises(KeyError):
            FP.append_deduped(_docs(spark, "d"), path)
    assert step is FP.index_run
    assert FP.append_deduped(_docs(spark, "d", "e"), path).first().docs == 1
    assert _texts(spark, path) == ["a", "b", "c", "d", "e"]
    IO.write_corpus(_docs(spark, "z"), path)  # replaced runs no longer count
    assert FP.append_deduped(_docs(spark, "a", "z"), path).first().docs == 1
    assert _texts(spark, path) == ["z", "a"]
