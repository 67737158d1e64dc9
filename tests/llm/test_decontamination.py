import hashlib
import random
import re


from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401
import __spark_entry__ as E
from tokenmill.llm import decontamination as D

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(FOLD))


def brute(docs, bench, window=13):
    windows = {}
    for item, text in bench:
        w = tokens(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = tokens(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found:
                    items |= found
                    hit.update(range(k, k + n))
        out.append((doc, len(w), len(hit), tuple(sorted(i for i in items if i is not None)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found(docs, bench, **options):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in D.find_contamination(docs, bench, **options).collect()), key=repr)


def test_query_on_whole_tables(spark):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = E.queries()["op7_benchmark_decontamination"](spark, SF_SMALL).collect()
    digest = (lambda items: hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest())
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=repr) == \
        sorted(((d, n, h, len(i), digest(i), c) for d, n, h, i, c in brute(docs, bench)), key=repr)


def test_short_items_ties_and_slices_of_the_test_side(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))) for _ in range(80)]
    bench = [(i, " ".join(rng.choice("abc") for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 8, 12, 13, 14, 20, 30, 30])]
    bench += [(50, None), (51, ""), (52, "..."), (None, "a b c a b"), (53, bench[8][1]), (8, "b b")]
    docs = make_docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    items = spark.createDataFrame(bench, "item_id long, text string")
    expected = brute(list(enumerate(texts)), bench)
    assert found(docs, items) == expected
    monkeypatch.setattr(D, "SLICE_BYTES", 40)  # several broadcasts, merged
    assert found(docs, items) == expected


def test_longest_match_and_place(spark):
    item = " ".join(f"q{i}" for i in range(40))
    text = "before that " + " ".join(f"q{i}" for i in range(5, 33)) + " after"
    docs = make_docs(spark, [(1, text, "s"), (2, "clean words", "s")])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    r = D.find_contamination(docs, bench).filter("doc_id = 1").first()
    assert r.longest.asDict() == {"words": 28, "position": 2, "item_id": 7, "item_position": 5}
    assert r.spans == [[2, 30]] and r.n_hit == 28
    assert [x.doc_id for x in D.decontaminate(docs, bench).collect()] == [2]


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    bench = spark.createDataFrame([(1, "two three FOUR"), (2, None), (3, "w w")], "item_id long, text string")
    given = [(r.doc_id, r.text) for r in edge_docs.collect()]
    expected = brute(given, [(1, "two three FOUR"), (3, "w w")])
    assert found(edge_docs, bench) == expected == found(clashing_docs, bench)
    assert found(no_docs, bench) == []
    assert not any(r[4] for r in found(edge_docs, bench.limit(0)))
    clean = D.decontaminate(clashing_docs, bench)
    assert clean.columns == clashing_docs.columns and clean.count() == sum(not r[4] for r in expected)
