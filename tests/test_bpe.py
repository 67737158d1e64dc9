"""BPE training: fixtures, batching exactness, size checks."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenmill.operators import bpe as B
from tokenmill.operators import pretokenize as P
from tokenmill.operators.clean import clean_documents
from tokenmill.sources.tables import read_documents
from bpe_oracle import train
from conftest import SF_SMALL


def _wf(spark, words):
    """word_freq rows from ``[(word, freq), ...]`` in first-seen order."""
    rows = [(w, f, i, 0) for i, (w, f) in enumerate(words)]
    return spark.createDataFrame(rows, "pretoken string, freq long, first_doc long, first_pos long")


def test_presence_counting(spark):
    stats = B.word_pair_stats(B.word_table(_wf(spark, [("aaaa", 3), ("ab", 2)]))).collect()
    counts = {(B.char_id(r.pair[0]), B.char_id(r.pair[1])): r.cnt for r in stats}
    assert counts[(97, 97)] == 3 and counts[(97, 98)] == 2


def test_overlap_merge(spark):
    m = B.bpe_train(_wf(spark, [("aaa", 1)]), 258)
    assert m.merges == [(97, 97)]
    df = spark.createDataFrame([("aaa",)], "w string")
    from pyspark.sql import functions as F

    from tokenmill.functions.ids import code_units_to_ids

    out = df.select(code_units_to_ids(B.merge_word(F.col("w"), 97, 97, 256)).alias("ids")).collect()[0].ids
    assert out == [256, 97]


def test_tie_goes_to_first_seen(spark):
    m = B.bpe_train(_wf(spark, [("ab", 1), ("cd", 1)]), 258)
    assert m.merges == [(97, 98)]


def test_early_stop(spark):
    m = B.bpe_train(_wf(spark, [("ab", 1)]), 300)
    assert m.merges == [(97, 98)]
    assert 257 not in m.id_bytes and 298 not in m.id_bytes
    assert m.id_bytes[299] == b"<|endoftext|>"
    assert m.id_bytes[256] == b"ab"


def test_bad_sizes(spark):
    with pytest.raises(ValueError):
        B.bpe_train(_wf(spark, [("ab", 1)]), 257)
    with pytest.raises(ValueError):
        B.bpe_train(_wf(spark, [("ab", 1)]), 300, eot_id=100)


def test_batched_equals_sequential_on_documents(spark):
    wf = P.pretoken_counts(clean_documents(read_documents(spark, SF_SMALL)))
    model = B.bpe_train(wf, 256 + 60 + 1)
    rows = sorted(wf.collect(), key=lambda r: (r.first_doc, r.first_pos))
    ref = train([(tuple(r.pretoken.encode()), r.freq) for r in rows], 60)
    assert model.merges == ref
    assert model.rounds < 60
    for r, (a, b) in enumerate(model.merges):
        assert model.id_bytes[256 + r] == model.id_bytes[a] + model.id_bytes[b]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcab ", min_size=1, max_size=7), st.integers(1, 4)), min_size=1, max_size=12))
def test_batched_equals_sequential_random(spark, words):
    seen, uniq = set(), []
    for w, f in words:
        if w not in seen:
            seen.add(w)
            uniq.append((w, f))
    model = B.bpe_train(_wf(spark, uniq), 256 + 12 + 1, fetch_k=4)
    ref = train([(tuple(w.encode()), f) for w, f in uniq], 12)
    assert model.merges == ref


def test_choose_batch_rules():
    # self pair at the head is merged alone
    assert B.choose_batch([(1, 1, 9), (2, 3, 8)], False, 10) == [(1, 1, 9)]
    # (3,4) conflicts with (2,3): its count bounds the batch
    ranked = [(1, 2, 10), (5, 6, 9), (2, 7, 8), (8, 9, 7)]
    assert B.choose_batch(ranked, True, 10) == [(1, 2, 10), (5, 6, 9)]
    # nothing conflicts and the list is complete: all members kept
    assert B.choose_batch([(1, 2, 5), (3, 4, 5)], True, 10) == [(1, 2, 5), (3, 4, 5)]
    # truncated list: the last fetched count bounds the rest
    assert B.choose_batch([(1, 2, 5), (3, 4, 4), (5, 6, 4)], False, 10) == [(1, 2, 5)]


def test_dense_rank_key_path(spark):
    words = [("ab", 2), ("bc", 2), ("abc", 1), ("cab", 3)]
    rows = [(w, f, (1 << 60) * i, 5) for i, (w, f) in enumerate(words)]
    wf = spark.createDataFrame(rows, "pretoken string, freq long, first_doc long, first_pos long")
    table, bits = B.ranked_word_table(wf)
    assert bits is not None  # packed through the dense rank, not the struct fallback
    model = B.bpe_train(wf, 256 + 6 + 1)
    ref = train([(tuple(w.encode()), f) for w, f in words], 6)
    assert model.merges == ref


def test_resume_from_state_dir(spark, tmp_path):
    wf = P.pretoken_counts(clean_documents(read_documents(spark, SF_SMALL)))
    state = str(tmp_path / "state")
    first = B.bpe_train(wf, 256 + 12 + 1, state_dir=state)
    resumed = B.bpe_train(wf, 256 + 30 + 1, state_dir=state)
    once = B.bpe_train(wf, 256 + 30 + 1)
    assert first.merges == once.merges[:12]
    assert resumed.merges == once.merges
    assert resumed.rounds > first.rounds


def test_state_belongs_to_its_words(spark, tmp_dir):
    one, two = _wf(spark, [("abab", 3), ("ba", 1)]), _wf(spark, [("xyxy", 3)])
    first = B.bpe_train(one, 258, state_dir=f"{tmp_dir}/state")
    assert B.bpe_train(one, 259, state_dir=f"{tmp_dir}/state").merges[:1] == first.merges
    with pytest.raises(ValueError, match="other words"):
        B.bpe_train(two, 258, state_dir=f"{tmp_dir}/state")


def test_scratch_tables_are_removed(spark):
    import glob

    from tokenmill.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/bpe-words-*"))
    B.bpe_train(_wf(spark, [("abcabd", 3), ("bcd", 2), ("abab", 1)]), 262)
    assert set(glob.glob(f"{folder}/bpe-words-*")) == before


def test_many_merges_in_one_round(spark):
    """More independent pairs than one plan replaces; equal to one merge at a time."""
    words = [(chr(0x21 + i) + chr(0x21 + i + 1), 1000 - i) for i in range(0, 90, 2)]
    words += [(chr(0xC0 + i) + "~", 500 - i) for i in range(30)]
    model = B.bpe_train(_wf(spark, words), 256 + 100 + 1)
    assert model.merges == train([(tuple(w.encode()), f) for w, f in words], 100)


def test_rank_keys_with_shared_first_places(spark):
    """Places too wide to pack, two words at one place: each word is counted once."""
    rows = [("abab", 3, 2 ** 61, 2 ** 40), ("cdcd", 3, 2 ** 61, 2 ** 40), ("ab", 1, -(2 ** 61), 0)]
    wf = spark.createDataFrame(rows, "pretoken string, freq long, first_doc long, first_pos long")
    table, bits = B.ranked_word_table(wf)
    assert bits is not None and table.count() == 3
    assert B.bpe_train(wf, 260).merges == [(97, 98), (256, 256), (99, 100)]


def test_pairs_are_counted_once_and_a_dry_head_is_fetched_again(spark, monkeypatch):
    wf = P.pretoken_counts(clean_documents(read_documents(spark, SF_SMALL))).cache()
    rows = sorted(wf.collect(), key=lambda r: (r.first_doc, r.first_pos))
    ref = train([(tuple(r.pretoken.encode()), r.freq) for r in rows], 150)
    recount, counted = B.PairHead.recount, []
    monkeypatch.setattr(B.PairHead, "recount", lambda self: (counted.append(1), recount(self))[1])
    assert B.bpe_train(wf, 256 + 150 + 1).merges == ref
    assert len(counted) == 1
    assert B.bpe_train(wf, 256 + 150 + 1, fetch_k=12).merges == ref  # a head that runs dry, floors that rise
    assert len(counted) > 3


def test_many_ties(spark, monkeypatch):
    """Ties inside words, between them, and first words that lose their pair; few are looked up at once."""
    words = [(w, 1 + i % 2) for i, w in enumerate(["abcdefab", "xabc", "cdef", "efefcd", "abxy", "yxyxab", "qrst", "tsrq", "rstabc", "zzzz", "zzz"])]
    ref = train([(tuple(w.encode()), f) for w, f in words], 25)
    for looked_up in (B.LOOKED_UP, 0):
        monkeypatch.setattr(B, "LOOKED_UP", looked_up)
        assert B.bpe_train(_wf(spark, words), 256 + 25 + 1).merges == ref


def test_a_tied_walk_ends_before_the_first_conflict():
    tied = [(1, 2, 0), (3, 4, 1), (5, 6, 2), (2, 7, 2), (8, 9, 3)]
    assert B.tied_batch(tied, True, 10) == [(1, 2), (3, 4)]  # (5, 6) begins in the word in which the conflict does
    assert B.tied_batch(tied[:3], False, 10) == [(1, 2), (3, 4)]
    assert B.tied_batch(tied[:3], True, 2) == [(1, 2), (3, 4)]
    assert B.tied_batch([(1, 1, 0), (3, 4, 1)], True, 10) == [(1, 1)]
    assert B.conflict_count([(1, 2, 9), (3, 4, 8), (2, 5, 7), (6, 6, 7)]) == 7
    assert B.conflict_count([(1, 2, 9), (3, 4, 8)]) is None
