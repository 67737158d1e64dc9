import itertools
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as E
from tokenmill.llm import mixing as M


def words(text):
    return len((text or "").encode().translate(None, b"").split(None)) if text else 0


def check(rows, weights=(1, 2, 3)):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, free = sum(sizes.values()), set(order)
    target = dict.fromkeys(order, 0.0)
    left = float(total)
    while free:  # share, cut off, share again
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 3 * sizes[s]]
        target.update(share)
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    return {s: taken[s] - target[s] for s in order}


def test_query_meets_its_targets(spark):
    rows = E.queries()["op8_source_mixing"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts) and all(r.size == words(texts[r.doc_id].text) for r in rows)
    full = M.mix_sources(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    assert {(r.doc_id, r.taken) for r in full} == {(r.doc_id, r.taken) for r in rows}  # reruns agree
    off = check(full)
    for s, d in off.items():  # no choice of documents comes nearer
        own = [r for r in full if r.source == s]
        copies = min(r.copies for r in own if r.size)
        options = {0}
        for r in own:
            options |= {o + r.size for o in options}
        target = own[0].target
        assert abs(d) <= min(abs(copies * own[0].source_size + o - target) for o in options) + 0.51


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 200), st.sampled_from([1, 7, 1 << 16]))
def test_fit_budget_is_as_close_as_the_documents_allow(counts, budget, exact):
    lengths, n = np.array(sorted(counts), dtype=np.int64), np.array([counts[k] for k in sorted(counts)], dtype=np.int64)
    take = M.fit_budget(lengths, n, budget, exact)
    assert (take >= 0).all() and (take <= n).all()
    got = int((lengths * take).sum())
    if budget < int((lengths * n).sum()) and exact > 1000:
        # the documents that the proportional part leaves over: no choice of them comes closer
        share = np.array([int(c) * budget // int((lengths * n).sum()) for c in n])
        options = itertools.product(*[range(int(c - s) + 1) for c, s in zip(n, share, strict=True)])
        assert abs(got - budget) == min(abs(int((lengths * (share + np.array(o))).sum()) - budget) for o in options)


def test_copies_and_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(M, "SALTS", 7)
    docs = make_docs(spark, [(i, "same words here", "hot") for i in range(900)] + [(i, "x " * (i % 9), f"s{i % 4}") for i in range(1000, 1400)])
    off = check(M.mix_sources(docs).collect())
    assert all(abs(d) <= 8 for d in off.values())


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    off = check(M.mix_sources(edge_docs).collect())
    assert set(off) == {"a", "b", "c", None}
    mixed = M.mixed_documents(clashing_docs)
    assert mixed.columns == clashing_docs.columns
    assert mixed.count() == sum(r.copies for r in M.mix_sources(edge_docs).collect())
    assert M.mix_sources(no_docs).count() == 0 == M.mixed_documents(no_docs).count()


def bands(lengths, counts, take):
    """Share of the documents taken in each of ten bands of lengths with equally many documents."""
    at = np.minimum(9, (np.cumsum(counts) - counts) * 10 // counts.sum())
    return np.array([take[at == b].sum() / counts[at == b].sum() for b in range(10)])


@pytest.mark.parametrize("share", [0.3, 0.456, 0.54, 0.9])
def test_share_is_flat_over_lengths_and_the_choice_differs_by_seed(share):
    sizes = np.random.default_rng(1).lognormal(6.3, 1.1, 20_000).astype(np.int64) + 1
    lengths, counts = np.unique(sizes, return_counts=True)
    budget, chosen = int(share * sizes.sum()), []
    for seed in (1, 2, 3):
        take = M.fit_budget(lengths, counts, budget, seed=seed)
        assert int((lengths * take).sum()) == budget
        assert np.abs(bands(lengths, counts, take) - share).max() < 0.03
        rare = counts == 1  # a length of one document is taken as often as others
        assert abs(take[rare].mean() - share) < 0.06
        chosen.append(take)
    assert all((a != b).mean() > 0.1 for a, b in itertools.combinations(chosen, 2))


def test_share_is_flat_in_small_sources():
    rng, out = np.random.default_rng(3), []
    for seed in range(60):
        lengths, counts = np.unique(rng.lognormal(6, 1, 120).astype(np.int64) + 1, return_counts=True)
        out.append(bands(lengths, counts, M.fit_budget(lengths, counts, int(0.4 * (lengths * counts).sum()), seed=seed)))
    assert np.abs(np.mean(out, axis=0) - 0.4).max() < 0.08


def test_reruns_agree_on_rows_that_share_their_ids(spark):
    rows = [(None if i % 2 else 7, f"{'word ' * (i % 5 + 1)}{i}", ["a", "b", None][i % 3]) for i in range(1500)]
    docs = make_docs(spark, rows).withColumn("extra", F.sha2("text", 256))
    one = M.mixed_documents(docs.repartition(3)).collect()
    two = M.mixed_documents(docs.repartition(8, "extra").sortWithinPartitions(F.desc("text"))).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
    other = M.mixed_documents(docs, seed=24).collect()
    assert sorted(map(tuple, one), key=repr) != sorted(map(tuple, other), key=repr)


def test_the_pipeline_stage_is_fair_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = M.mix_sources(docs, max_repeats=3).collect()
    for source in {r.source for r in rows}:
        own = sorted((r for r in rows if r.source == source and r.size), key=lambda r: r.size)
        least = min(r.copies for r in own)
        half = len(own) // 2
        more = [np.mean([r.copies > least for r in part]) for part in (own[:half], own[half:])] if half > 5 else [0, 0]
        assert abs(more[0] - more[1]) < 0.6
