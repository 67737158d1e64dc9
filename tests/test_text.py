"""Whitespace classes, cleaning, fingerprints and the GPT-2 pretokenizer."""

import regex
from pyspark.sql import functions as F

from tokenmill.constants import GPT2_PATTERN_PY
from tokenmill.functions.text import fingerprint, normalize_ws, pretokens, strip_ws
from tokenmill.operators.clean import clean_documents, split_on_eot
from tokenmill.operators.dedupe import dedupe_exact, ingest_report
from tokenmill.sources.tables import read_documents
from conftest import SF_SMALL

PY = regex.compile(GPT2_PATTERN_PY)


def _one(spark, values, col_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r[0] for r in df.orderBy("doc_id").select(col_fn(F.col("text"))).collect()]


def test_strip_matches_python(spark):
    values = ["  a b \n", "\x1c x \x1f", "\xa0y ", "​z", "\x85w\x85", " \t\r\n"]
    assert _one(spark, values, strip_ws) == [v.strip() for v in values]


def test_normalize_matches_python(spark):
    import re

    values = ["a  b", " a b\n", "a\tb", "a\xa0b", "a\x1cb", "x \n\t y"]
    got = _one(spark, values, normalize_ws)
    assert got == [re.sub(r"\s+", " ", v.strip()) for v in values]


def test_whitespace_variants_share_fingerprint_first_survives(spark):
    rows = ["a  b", " a b\n", "a\tb", "a\xa0b", "a\x1cb"]
    df = clean_documents(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    out = dedupe_exact(df).collect()
    assert len(out) == 1
    assert out[0]["doc_id"] == 0 and out[0]["text"] == "a  b"


def test_case_is_not_folded(spark):
    fps = _one(spark, ["A b", "a b"], fingerprint)
    assert fps[0] != fps[1]


def test_clean_drops_null_and_blank(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, " \n "), (3, " x ")], "doc_id long, text string")
    assert [(r.doc_id, r.text) for r in clean_documents(df).collect()] == [(3, "x")]
    rep = ingest_report(df).collect()[0]
    assert (rep.rows_read, rep.non_empty, rep.blank, rep.duplicates) == (4, 1, 3, 0)
    assert rep.output_bytes == 1 + 17


def test_split_on_eot_counts_segments(spark):
    df = spark.createDataFrame([(0, "x<|endoftext|><|endoftext|>y<|endoftext|>")], "doc_id long, text string")
    segs = [r.text for r in split_on_eot(df).orderBy("seg").collect()]
    assert segs == ["x", "y"]


def test_pretokenize_fixtures(spark):
    cases = {
        "a  b": ["a", " ", " b"],
        "a \n b ": ["a", " \n", " b", " "],
        "I'll don't 'S": ["I", "'ll", " don", "'t", " '", "S"],
    }
    got = _one(spark, list(cases), pretokens)
    assert got == list(cases.values())
    assert got == [PY.findall(t) for t in cases]


def test_pretokenize_equals_regex_module_on_documents(spark):
    docs = read_documents(spark, SF_SMALL)
    rows = docs.select("text", pretokens(F.col("text")).alias("p")).collect()
    for r in rows:
        assert r.p == [p for p in PY.findall(r.text) if p]


def test_python_mode_equals_jvm_mode(spark):
    from tokenmill.operators.pretokenize import pretokenize

    docs = read_documents(spark, SF_SMALL)
    a = pretokenize(docs, mode="jvm").collect()
    b = pretokenize(docs, mode="python").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
