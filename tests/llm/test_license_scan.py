import random
import re

from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401

import __spark_entry__ as E
from tokenmill.llm import license_scan as L

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(FOLD))


def shingles(words, k):
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(docs, templates, containment=0.8):
    """Documents that hold enough of a template in a stretch of its window's length."""
    sure, possible = set(), set()
    for license_id, text in templates:
        t = tokens(text)
        if not t:
            continue
        k = min(5, len(t))
        wanted, window = shingles(t, k), 8
        while window * 2 < 3 * len(t):
            window *= 2
        for i, text_ in docs:
            w = tokens(text_)
            best = {n: max((len(shingles(w[a:a + n], k) & wanted) / len(wanted) for a in range(max(1, len(w) - k + 1))), default=0)
                    for n in (len(t), window + k)}
            if best[len(t)] >= containment:
                sure.add((i, license_id))
            if best[window + k] >= containment:
                possible.add((i, license_id))
    return sure, possible


def test_query_finds_the_notices(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = E.queries()["op3_license_scan"](spark, SF_SMALL).collect()
    sure, possible = brute(docs, L.TEMPLATES)
    found = {(r.doc_id, r.license_id) for r in rows}
    assert sure and sure <= found <= possible


def test_edited_templates(spark):
    rng = random.Random(6)
    docs = []
    for i in range(120):
        license_id, text = rng.choice([t for t in L.TEMPLATES if len(t[1].split()) > 30])
        words = text.split()
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = "edited"
        filler = [f"f{rng.randrange(500)}" for _ in range(rng.randrange(0, 300))]
        at = rng.randrange(len(filler) + 1)
        docs.append((i, " ".join(filler[:at] + words + filler[at:]), "s"))
    sure, possible = brute([d[:2] for d in docs], L.TEMPLATES)
    rows = L.scan_licenses(make_docs(spark, docs)).collect()
    found = {(r.doc_id, r.license_id) for r in rows}
    assert sure <= found <= possible and sure
    assert all(0.8 <= r.containment <= 1 for r in rows)


def test_bands_reach_the_recall():
    templates = [t for t in (L._template(*x) for x in L.TEMPLATES) if t]
    bands = L.bands_for(templates, 0.8, 0.999999)
    for t in templates:
        shared = -(-4 * len(t.shingles) // 5)
        assert (1 - shared / (len(t.shingles) + t.window - shared)) ** bands <= 1.1e-6


def test_edges(spark, edge_docs, clashing_docs, no_docs, monkeypatch):
    templates = spark.createDataFrame([("w", "w w w w w w"), ("short", "SHORT"), ("none", None), ("blank", " . "), ("seven", "one two three four five six seven")],
                                      "license_id string, text string")
    expected = [(4, "seven"), (5, "seven"), (6, "seven"), (6, "seven"), (7, "short"), (8, "short"), (9, "short"), (10, "w"), (11, "w")]
    for docs in (edge_docs, clashing_docs):
        assert sorted((r.doc_id, r.license_id) for r in L.scan_licenses(docs, templates).collect()) == expected
    monkeypatch.setattr(L, "SLICE_BYTES", 16)  # templates in several slices, one document at a time
    assert sorted((r.doc_id, r.license_id) for r in L.scan_licenses(edge_docs.filter("length(text) < 100"), templates).collect()) == expected
    assert L.scan_licenses(no_docs).count() == 0 and L.scan_licenses(edge_docs, templates.limit(0)).count() == 0
