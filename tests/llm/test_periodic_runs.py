import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import CLASHES, SF_SMALL, edge_rows
from pyspark.sql import functions as F

from tokenmill.llm import periodic_runs as P
from tokenmill.llm import queries as Q
from tokenmill.llm import words as W


def brute(ws, shortest=12):
    """All runs of a list of words: for each period, the stretches whose words are that far from an equal one."""
    n, found = len(ws), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= 2 * q:
                found.setdefault((i, j + q), q)  # smaller periods come first
            i = j + 1 if j == i else j
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= max(shortest, 2 * q)), key=lambda r: (r[0], r[2]))


def planted(doc_id, ws):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, runs_of=brute):
    ws = planted(doc_id, [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())])
    runs = runs_of(ws)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = (lambda x: hashlib.sha256(x.encode()).hexdigest())
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(ws) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=14), st.integers(1, 6), st.lists(st.integers(0, 4), max_size=5)), max_size=4), st.sampled_from([2, 12]),
       st.sampled_from([5, 1 << 21]))
def test_runs_of_several_documents(parts, shortest, expand):
    docs = [core * times + tail for core, times, tail in parts]
    bounds = np.cumsum([0, *map(len, docs)]).astype(np.int64)
    hashes = W.mix(np.array([x for d in docs for x in d], dtype=np.uint64) + np.uint64(9))
    before, P.EXPAND = P.EXPAND, expand
    try:
        got = sorted(zip(*(x.tolist() for x in P.find_runs(hashes, bounds, shortest)), strict=True))
    finally:
        P.EXPAND = before
    assert got == sorted((s + int(bounds[i]), n, q) for i, d in enumerate(docs) for s, n, q in brute(d, shortest))


def test_suffix_array_is_sorted_and_its_lcp_right():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 3, 400).astype(np.uint64)
    bounds = np.array([0, 150, 150, 399, 400])
    sa = P.SuffixArray(W.mix(ids + np.uint64(1)), bounds)
    end = np.repeat(bounds[1:], np.diff(bounds))
    assert sorted(sa.order.tolist()) == list(range(400)) and (sa.rank[sa.order] == np.arange(400)).all()
    for k in range(1, 400):
        i, j = int(sa.order[k - 1]), int(sa.order[k])
        same = 0
        while end[i] == end[j] and i + same < end[i] and j + same < end[j] and ids[i + same] == ids[j + same]:
            same += 1
        assert sa.lcp[k] == same
    for i, j in [(20, 140), (200, 390), (3, 4)]:
        n = int(sa.rotate(np.array([i]), np.array([j]))[0])
        assert all(ids[i - k - 1] == ids[j - k - 1] for k in range(n))


def made(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.withColumns({c: F.lit("x") for c in [*CLASHES, "runs", "collapsed", "start"]}).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, Q.op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)


def test_edges(spark, tmp_path):
    rows = [(i, t) for i, t, _ in edge_rows() if i != 12]
    rows += [(100 + i, "a b c " * i) for i in range(40)] + [(200, "the " * 11), (201, "the\t" * 12), (202, "The the " * 6), (203, "x " * 3000 + "y"),
                                                           (204, "  p\nq  r\r" * 9 + "p q r p z")] + [(300, "same same " * 20)] * 3
    assert made(spark, tmp_path, rows) == sorted((expected(*r) for r in rows), key=repr)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(60_000)) + " u v w x y z" * 30_000
    r = P.periodic_runs(spark.createDataFrame([(1, text)], "id int, text string")).first()
    assert [tuple(x) for x in r.runs] == [(60_000, 180_000, 6)] and r.n_words == 240_000
    assert r.collapsed == " ".join(f"w{i}" for i in range(60_000)) + " u v w x y z" and r.text == text


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 30, 5)], "id int, Text string, runs int")
    out = P.periodic_runs(docs, "text")
    assert out.columns == ["id", "Text", "n_words", "runs", "collapsed"] and out.first().collapsed == "a"
    assert P.periodic_runs(docs.limit(0), "text").collect() == []


@pytest.mark.parametrize("table", [SF_SMALL])
def test_query_on_the_small_table(spark, table):
    rows = Q.op13_periodic_runs(spark, table).collect()
    docs = spark.read.parquet(f"{table}/documents.parquet").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted((expected(r.doc_id, r.text) for r in docs), key=repr)
    assert sum(r.n_runs > 0 for r in rows) > len(rows) // 20
