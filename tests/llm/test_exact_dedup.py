import hashlib
from collections import defaultdict

import pandas as pd
from llm_cases import clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from tokenmill.llm import exact_dedup as X


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def check(rows, given):
    groups = defaultdict(list)
    for i, text in given:
        groups[normal(text)].append(i)
    expected = []
    for i, text in given:
        own = groups[normal(text)]
        keep = max((x for x in own if x is not None), default=None)
        expected.append((i, keep, len(own), i == keep, hashlib.sha256(normal(text).encode()).digest()))
    order = (lambda r: (r[0] is None, r[0] or 0, r[4]))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in rows), key=order) == sorted(expected, key=order)


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    given = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check(X.exact_groups(edge_docs).collect(), given)
    check(X.exact_groups(clashing_docs).collect(), given)
    assert X.exact_groups(no_docs).count() == 0


def test_hot_digests_take_the_broadcast_path(spark):
    rows = [(i, "Hot" if i % 3 == 0 else "hot" if i % 3 == 1 and i % 2 else f"t{i % 400}", "s") for i in range(3000)]
    docs = make_docs(spark, rows)
    check(X.exact_groups(docs, counters=4).collect(), [(r[0], r[1]) for r in rows])
    keys = docs.select(F.sha2(F.lower("text"), 256).cast("binary").alias("digest")).repartition(5)
    assert X.frequent_digests(keys, 4).count() == 1
    assert {r.doc_id for r in X.dedup_exact(docs).collect()} == {r.doc_id for r in X.exact_groups(docs).filter("kept").collect()}


def test_one_row_of_each_text_stays(spark, edge_docs, clashing_docs, no_docs):
    for docs in (edge_docs, clashing_docs, no_docs):
        rows, given = X.dedup_exact(docs).collect(), docs.collect()
        assert {(r.doc_id, normal(r.text)) for r in rows} == {
            (max((g.doc_id for g in given if normal(g.text) == text and g.doc_id is not None), default=None), text)
            for text in {normal(g.text) for g in given}}
        assert len(rows) == len({normal(g.text) for g in given}) and all(r in given for r in rows)
    rows = [(None, "a", 1), (None, "b", 2), (5, "B", 3), (7, "c", 4), (7, "C", 5), (7, "c", 4), (None, "Ä X", 6), (None, "Ä x", 7),
            (8, None, 8), (9, "", 9), *[(1, "hot", i) for i in range(500)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    one, two = (sorted(map(repr, X.dedup_exact(docs.repartition(n)).collect())) for n in (3, 8))
    assert one == two and len(one) == 6
    kept = {(r.doc_id, normal(r.text)) for r in X.dedup_exact(docs, counters=4).collect()}
    assert kept == {(None, "a"), (5, "b"), (7, "c"), (None, "Ä x"), (9, ""), (1, "hot")}


def test_misra_gries_keeps_every_frequent_value():
    counts, seen = pd.Series(dtype="float64"), []
    for i in range(50):
        batch = pd.Series(["a"] * 40 + [f"{i}-{j}" for j in range(60)])
        seen += batch.tolist()
        counts = X.misra_gries(counts, batch.value_counts(), 9)
        assert len(counts) <= 9
    assert counts["a"] >= seen.count("a") - len(seen) / 10
