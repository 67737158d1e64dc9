"""Dense text features of the toxicity model, computed on whole texts with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tokenmill.llm import words as W

NEAR = 6  # words
KINDS = ("word", "stem4", "stem5")

#: Second-person words of the corpus languages.
SECOND_PERSON = ("you your yours yourself u ur ye du dich dir dein deine deiner ihr euch euer sie tu te ton ta tes toi vous votre vos "
                 "tú ti tu tus usted ustedes vosotros os su sus").split()
#: Look-alikes and the letters they stand for.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}

_PLAIN = W.LOWER.copy()
for _mark, _letter in LOOK_ALIKES.items():
    _PLAIN[ord(_mark)] = ord(_letter)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[[ord("!"), ord("?")]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True

FEATURES = ("words", *KINDS, "word_count", "stem4_count", "stem5_count", "near_you", "second_person", "undone", "undone_count",
            "capitals", "capital_words", "marks", "shouts", "marked_words", "mixed_words", "drawn_out")


@dataclass
class Lexicon:
    """Sorted hashes of the entries of each kind."""

    entries: dict[str, np.ndarray]


def _stem(w: W.Words, letters: int) -> np.ndarray:
    """The first ``letters`` bytes of each word, as a number; 0 for words that are not longer."""
    out = np.zeros(len(w.starts), np.uint64)
    longer = w.ends - w.starts > letters
    for i in range(letters):
        out[longer] = out[longer] * np.uint64(256) + W.LOWER[w.data[w.starts[longer] + i]]
    return out


def entry_keys(w: W.Words) -> dict[str, np.ndarray]:
    return {"word": w.hashes, "stem4": _stem(w, 4), "stem5": _stem(w, 5)}


def _in(sorted_values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_values, keys), len(sorted_values) - 1)
    return sorted_values[at] == keys


def _running(values: np.ndarray) -> np.ndarray:
    """Running counts from 0 on; a slice of texts has far fewer than 2**31 bytes."""
    run = np.zeros(len(values) + 1, np.int32 if len(values) < 1 << 31 else np.int64)
    np.cumsum(values, dtype=run.dtype, out=run[1:])
    return run


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = _running(values)
    return (run[bounds[1:]] - run[bounds[:-1]]).astype(float)


_YOU = np.sort(W.words(pa.array([" ".join(SECOND_PERSON)])).hashes)


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """(texts, FEATURES) of a column of whole texts."""
    w = W.words(column, W.NON_WORD)
    n = np.maximum(w.counts, 1).astype(float)
    hits = {kind: _in(lexicon.entries[kind], keys) for kind, keys in entry_keys(w).items()}
    any_hit = hits["word"] | hits["stem5"]
    you = _in(_YOU, w.hashes)
    near = np.zeros(len(you), bool)
    at, owner = np.flatnonzero(you), w.owner()
    for d in range(-NEAR, NEAR + 1):
        there = at + d
        ok = (there >= 0) & (there < len(you))
        there, here = there[ok], at[ok]
        near[there[owner[there] == owner[here]]] = True
    data, offsets = w.data, w.text_offsets
    letters = np.maximum(_sums(_LETTER[data], offsets), 1)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    # words by white space, look-alikes undone and marks at the ends left out
    plain_data = _PLAIN[data]
    spaced = W.words(column, W.SPACE)
    marks, alpha, capital = _running(_MARK[data] | _DIGIT[data]), _running(_LETTER[data]), _running(_UPPER[data])
    long_enough = spaced.ends - spaced.starts >= 3
    inner_marks = np.zeros(len(spaced.starts), bool)
    s, e = spaced.starts[long_enough], spaced.ends[long_enough]
    inner_marks[long_enough] = (marks[e - 1] - marks[s + 1] > 0) & (alpha[e] - alpha[s] >= 2)
    marked_word = (marks[spaced.ends] > marks[spaced.starts]) & (alpha[spaced.ends] > alpha[spaced.starts])
    undone = np.zeros(len(spaced.starts), bool)
    odd = np.flatnonzero(marked_word)
    if len(odd):
        texts = [plain_data[a:b].tobytes().strip(b".,;:?\"'()[]{}<>-_*#~") for a, b in zip(spaced.starts[odd], spaced.ends[odd], strict=True)]
        once = W.words(pa.array([t.translate(None, b".,;:?\"'()[]{}<>-_*#~/\\&^%=`") for t in texts], pa.binary()), W.SPACE)
        hash_of = np.zeros(len(odd), np.uint64)
        hash_of[once.counts == 1] = once.hashes[once.bounds[:-1][once.counts == 1]]
        plainly = np.zeros(len(odd), bool)  # those that a hit as written already counts
        run = _running(hits["word"])
        a, b = np.searchsorted(w.starts, spaced.starts[odd]), np.searchsorted(w.starts, spaced.ends[odd])
        plainly[:] = run[b] > run[a]
        undone[odd] = _in(lexicon.entries["word"], hash_of) & ~plainly
    repeat = np.zeros(len(data), bool)
    repeat[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]
    shouting = (capital[spaced.ends] - capital[spaced.starts] >= 3) & (capital[spaced.ends] - capital[spaced.starts] == alpha[spaced.ends] - alpha[spaced.starts])
    spaced_n = np.maximum(spaced.counts, 1).astype(float)
    counts = {kind: _sums(hit, w.bounds) for kind, hit in hits.items()}
    columns = [np.log1p(w.counts), *(counts[k] / n for k in KINDS), *(np.minimum(counts[k], 20) for k in KINDS),
               _sums(any_hit & near, w.bounds) / n, _sums(you, w.bounds) / n, _sums(undone, spaced.bounds) / spaced_n,
               np.minimum(_sums(undone, spaced.bounds), 20), _sums(_UPPER[data], offsets) / letters, _sums(shouting, spaced.bounds) / spaced_n,
               _sums(_MARK[data], offsets) / size, _sums(_SHOUT[data], offsets) / size, _sums(marked_word, spaced.bounds) / spaced_n,
               _sums(inner_marks, spaced.bounds) / spaced_n, _sums(repeat, offsets) / size]
    return np.stack(columns, 1)
