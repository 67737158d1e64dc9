import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401

import __spark_entry__ as E
from tokenmill.llm import lm_scoring as L
from tokenmill.llm.elias_fano import BigramTrie, EliasFano, quantise, restore

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(FOLD)), b"\n"]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def base_model(docs):
    counts = Counter(w for i, t in docs if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, n + 0.1 * (v + 1)


def check_base(rows, docs):
    counts, n, mass = base_model(docs)
    expected = sorted((i or -1, held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), n,
                       round(sum(math.log10((counts[w] + 0.1) / mass) for w in tokens(t)), 4)) for i, t in docs)
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == expected


def read(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def test_query_counts_exactly_and_beats_the_words_alone(spark):
    rows, docs = E.queries()["op5_lm_scoring"](spark, SF_SMALL).collect(), read(spark)
    check_base(rows, docs)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and all(r.score < 0 for r in rows)


def test_scores_are_those_of_the_smoothed_pairs(spark, monkeypatch):
    """One shard: absolute discounting with the shard's discount, checked pair by pair."""
    monkeypatch.setattr(L, "MAX_SHARDS", 1)
    docs = read(spark)
    rows = {r.doc_id: r for r in E.queries()["op5_lm_scoring"](spark, SF_SMALL).collect()}
    counts, _, mass = base_model(docs)
    pairs = Counter(p for i, t in docs if not held(i) for p in zip([b"", *tokens(t)], tokens(t), strict=False))
    after, kinds = Counter(), Counter()
    for (a, _), c in pairs.items():
        after[a] += c
        kinds[a] += 1
    once, twice = (sum(c == k for c in pairs.values()) for k in (1, 2))
    d = min(0.98, max(0.3, once / max(1, once + 2 * twice)))
    for i, t in docs:
        total = 0.0
        for a, b in zip([b"", *tokens(t)], tokens(t), strict=False):
            low = (float(L.count_at(L.level_of(np.array([counts[b]])))[0]) + 0.1) / mass
            total += math.log10(low if not after[a] else (max(pairs[a, b] - d, 0) + d * kinds[a] * low) / after[a])
        assert abs(rows[i].score - total) <= 5e-4 * len(tokens(t)) + 1e-3


def test_many_shards_and_parts_of_contexts_make_a_distribution(spark, monkeypatch):
    for name, value in (("PART", 40), ("PAIRS_PER_SHARD", 200), ("WORDS_PER_SHARD", 100), ("BLOCK_BYTES", 4000)):
        monkeypatch.setattr(L, name, value)
    docs = [(i, " ".join("abcdefgh"[(i * j + j * j) % 8] for j in range(60)), "s") for i in range(120)]
    probe = [(1000 + k, f"{a} {b}", "s") for k, (a, b) in enumerate((a, b) for a in "abch" for b in "abcdefgh")]
    probe = [p for p in probe if True]
    rows = {r.doc_id: r for r in L.score_documents(make_docs(spark, docs + probe)).collect()}
    check_base(rows.values(), [d[:2] for d in docs + probe])
    assert all(r.score < 0 for r in rows.values())


def test_shards_and_parts_do_not_change_scores(spark, monkeypatch):
    docs = make_docs(spark, [(i, " ".join(f"w{(i * i + j * j * j) % (7 + i % 90)}" for j in range(i % 70)), "s") for i in range(300)])
    scores = []
    for sizes in ({"MAX_SHARDS": 1}, {"MAX_SHARDS": 1 << 16}, {"PART": 40, "PAIRS_PER_SHARD": 200, "WORDS_PER_SHARD": 100, "BLOCK_BYTES": 4000}):
        for name, value in sizes.items():
            monkeypatch.setattr(L, name, value)
        scores.append({r.doc_id: r.score for r in L.score_documents(docs).collect()})
    one, *others = scores
    for other in others:
        assert all(abs(other[i] - s) <= 1e-5 * abs(s) + 1e-6 for i, s in one.items())


def test_probabilities_of_a_context_add_up_to_one():
    """Over all words, parts included, a pair shard's probabilities of a context sum to one."""
    rng = np.random.default_rng(5)
    words = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2))
    count = rng.integers(1, 50, 300)
    total_mass = float(count.sum() + 0.1 * 301)
    mass = np.bincount((words >> np.uint64(54)).astype(np.int64), weights=count + 0.1, minlength=L.BUCKETS)
    level = L.level_of(count)
    lower = (L.count_at(level) + 0.1) / total_mass
    mass_as_coded = np.bincount((words >> np.uint64(54)).astype(np.int64), weights=lower * total_mass, minlength=L.BUCKETS)
    assert abs(mass_as_coded.sum() / mass.sum() - 1) < 0.03
    for parts in (1, 4):
        times = rng.integers(0, 6, 300)
        succ = (words >> np.uint64(32)).astype(np.uint32)
        slot = (succ >> np.uint32(22)).astype(np.int64) * parts // L.BUCKETS
        total, after = 0.0, float(times.sum())
        for s in range(parts):
            g = np.flatnonzero(slot == s)
            order = g[np.argsort(succ[g])]
            train = {"contexts": np.array([77], np.uint64), "sizes": np.array([len(g)], np.uint32), "successors": succ[order],
                     "levels": level[order], "times": np.maximum(times[order], 1).astype(np.uint32), "held": np.array([0, 1], np.uint8),
                     "docs": np.concatenate([np.full(max(t, 1), 0 if t else 1, np.uint16) for t in times[order]]) if len(g) else np.empty(0, np.uint16),
                     "cut_up": np.array([0] if parts > 1 else [], np.uint32), "parts": np.array([parts] if parts > 1 else [], np.uint32),
                     "slots": np.array([s] if parts > 1 else [], np.uint32), "counts": np.array([after] if parts > 1 else [], np.int64)}
            shard = L.PairShard([train], mass_as_coded, mass_as_coded.sum() + 0.1)
            total += (10.0 ** shard.score(mass_as_coded.sum() + 0.1)).sum()
        unknown = 0.1 / (mass_as_coded.sum() + 0.1)
        assert abs(total - 1) < 0.02 + unknown


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 60), min_size=1, max_size=200), st.booleans())
def test_elias_fano_round_trip(numbers, small):
    values = np.sort(np.array([n >> 50 if small else n for n in numbers], np.uint64))
    ef = EliasFano.of(values)
    assert (ef.at(np.arange(len(values))) == values).all()
    asked = np.unique(np.concatenate([values, values + np.uint64(1)]))
    found = ef.find(asked, np.zeros(len(asked), int), np.full(len(asked), len(values)))
    assert ((found >= 0) == np.isin(asked, values)).all() and (values[found[found >= 0]] == asked[found >= 0]).all()


def test_trie_looks_up_successors_in_their_context():
    pairs = defaultdict(dict)
    rng = np.random.default_rng(8)
    for c, s in rng.integers(0, [40, 1000], (500, 2)).tolist():
        pairs[c * 7919][s] = -float(rng.random() * 9)
    contexts = sorted(pairs)
    flat = [(c, s) for c in contexts for s in sorted(pairs[c])]
    back = np.array([-0.5 - i / 100 for i in range(len(contexts))])
    trie = BigramTrie(np.array(contexts, np.uint64), np.array([len(pairs[c]) for c in contexts]), np.array([s for _, s in flat]),
                      np.array([pairs[c][s] for c, s in flat]), back)
    node = trie.nodes(np.array([*contexts, 5], np.uint64))
    assert node.tolist() == [*range(len(contexts)), -1]
    for i, c in enumerate(contexts):
        asked = np.arange(0, 1000, 3)
        got = trie.log10(np.full(len(asked), i), asked, np.full(len(asked), -2.0))
        for s, g in zip(asked.tolist(), got, strict=True):
            assert abs(g - pairs[c].get(s, back[i] - 2.0)) < 3e-4
    assert (restore(quantise(np.array([0.0, -20.0]))) == [0.0, -65535 / 4095]).all()


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    given_ = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for docs in (edge_docs, clashing_docs):
        rows = L.score_documents(docs).collect()
        check_base(rows, given_)
        assert all(r.score <= 0 for r in rows)
    assert L.score_documents(no_docs).count() == 0
    only_held = make_docs(spark, [(i, "a b", "s") for i in range(200) if held(i)])
    assert {(r.n_known, r.train_tokens, round(r.score, 6)) for r in L.score_documents(only_held).collect()} == {(0, 0, 0.0)}
