import re

import numpy as np
import pyarrow as pa
import pytest

from tokenmill.llm import words as W

TEXTS = ["a  b\tc", None, "", "   ", "Über die Straße", "x" * 700_000, "ab " * 300_000, "a" * W.PIECE + " b", "tail", "HEAD tail\x0b\x85x", "日本語 テスト"]


def python_words(text, pattern):
    fold = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    return re.findall(pattern, (text or "").encode().translate(fold))


@pytest.mark.parametrize(("separators", "pattern"), [(W.SPACE, rb"[^\x20\x09-\x0D]+"), (W.NON_WORD, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(separators, pattern):
    w = W.words(pa.array(TEXTS, pa.string()), separators)
    seen = {}
    for i, text in enumerate(TEXTS):
        expected = python_words(text, pattern)
        own = range(w.bounds[i], w.bounds[i + 1])
        assert [w.word(j) for j in own] == expected
        for j, word in zip(own, expected, strict=True):
            assert seen.setdefault(word, w.hashes[j]) == w.hashes[j]
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns_and_case():
    column = pa.array(TEXTS, pa.string())
    whole, part = W.words(column), W.words(column.slice(4, 3))
    assert (whole.hashes[whole.bounds[4]:whole.bounds[7]] == part.hashes).all()
    kept = W.words(pa.array(["Ab ab"]), fold_case=False)
    assert kept.hashes[0] != kept.hashes[1]


def test_sequence_hashes_depend_on_words_and_order_only():
    w = W.words(pa.array(["a b c d e f", "x a b c d e", "e d c b a"]))
    for n in (1, 2, 3, 5):
        h, whole = W.sequence_hashes(w.hashes, w.bounds, n)
        runs = {}
        for i in np.flatnonzero(whole):
            runs.setdefault(tuple(w.word(j) for j in range(i, i + n)), set()).add(int(h[i]))
        assert all(len(v) == 1 for v in runs.values())
        assert len({next(iter(v)) for v in runs.values()}) == len(runs)
        assert whole.sum() == sum(max(0, c - n + 1) for c in w.counts)
