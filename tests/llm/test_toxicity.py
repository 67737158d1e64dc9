import zlib

import pyarrow as pa
import pytest
from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401

import __spark_entry__ as E
from tokenmill.llm import toxicity as X
from tokenmill.llm import toxicity_features as XF
from tokenmill.llm import words as W

INSULTS = ["blarg", "fnord", "grumpf", "snark", "twerp"]


def corpus(n):
    rows, labels = [], []
    for i in range(n):
        body = [f"word{(i * 7 + j * j) % 300}" for j in range(30 + i % 50)]
        toxic = i % 4 == 0
        if toxic:
            for j in range(3):
                body[(i + 11 * j) % len(body)] = INSULTS[(i // 4 + j) % len(INSULTS)]
        rows.append((i, " ".join(body), "s"))
        if i % 10 != 9:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus(1500)
    labels = spark.createDataFrame([*labels, (3, None), (None, 1), (999999, 1)], "doc_id long, toxic int")
    return X.score_toxicity(make_docs(spark, rows), labels).collect(), rows


def test_held_out_accuracy_and_folds(scored):
    got, rows = scored
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_never_read(spark, scored):
    rows, labels = corpus(1500)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    again = X.score_toxicity(make_docs(spark, rows), spark.createDataFrame(turned, "doc_id long, toxic int")).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in scored[0]}


def test_query_on_whole_tables(spark):
    rows = E.queries()["op4_toxicity"](spark, SF_SMALL).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    known = [r for r in rows if r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in known) >= 0.85 * len(known)


def test_features_of_marks_and_look_alikes():
    lexicon = XF.Lexicon({"word": W.np.sort(W.words(pa.array(["fnord blarg"])).hashes), "stem4": W.np.empty(0, W.U64), "stem5": W.np.empty(0, W.U64)})
    x = XF.features(pa.array(["you fnord", "F.N.0.R.D", "A LOUD!!! blarg", None, "", "plain text here"]), lexicon)
    at = {name: i for i, name in enumerate(XF.FEATURES)}
    assert x.shape == (6, len(XF.FEATURES)) and W.np.isfinite(x).all()
    assert x[0, at["near_you"]] > 0 and x[2, at["near_you"]] == 0
    assert x[1, at["undone"]] == 1 and x[1, at["word"]] == 0
    assert x[2, at["shouts"]] > 0 and x[2, at["capital_words"]] > 0
    assert (x[3] == x[4]).all() and x[3].sum() == 0


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (7, 0), (12, 0), (None, 1)], "doc_id long, toxic int")
    for docs in (edge_docs, clashing_docs):
        rows = X.score_toxicity(docs, labels).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = X.drop_toxic(clashing_docs, labels)
    assert kept.columns == clashing_docs.columns
    assert X.score_toxicity(no_docs, labels).count() == 0
    same = {r.score for r in X.score_toxicity(edge_docs, labels.limit(0)).collect()}
    assert same == {0.5}
