"""Words of whole texts as numpy arrays, straight from an Arrow string column.

Every operator here that looks at words works on bytes: a word is a maximal run
of bytes outside a separator class, ``A-Z`` lower-cased.  All separators are
ASCII, so runs never cut a UTF-8 character.  A word is identified by a 64-bit
polynomial hash, finished with a mixing step; two different words share it with
a chance of about 2**-64.  Texts are walked in pieces of some hundred kilobytes,
so the memory needed is that of the words found, whatever a text's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
U64 = np.uint64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True  # [\x20\x09-\x0D]
NON_WORD = np.zeros(256, dtype=bool)
NON_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True  # [\x00-\x2F\x3A-\x60\x7B-\x7F]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER_BYTES = LOWER.tobytes()

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, PIECE + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: hash, byte range in ``data``, and where each text's words begin."""

    hashes: np.ndarray  # uint64, one per word
    starts: np.ndarray  # int64 byte offsets into data
    ends: np.ndarray
    bounds: np.ndarray  # int64, len(texts) + 1; words of text i are [bounds[i], bounds[i+1])
    data: np.ndarray  # the original bytes
    text_offsets: np.ndarray  # int64, len(texts) + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes().translate(LOWER_BYTES)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null has no bytes."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"") \
        if column.null_count else column
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _piece_cuts(data: np.ndarray, separators: np.ndarray) -> list[int]:
    """Ends of pieces of at most PIECE bytes, cut after a separator where there is one."""
    cuts, at = [], 0
    while len(data) - at > PIECE:
        window = separators[data[at:at + PIECE]]
        last = len(window) - 1 - int(np.argmax(window[::-1])) if window.any() else -1
        at += last + 1 if last >= 0 else PIECE
        cuts.append(at)
    return [*cuts, len(data)]


def words(column: pa.Array, separators: np.ndarray = SPACE, fold_case: bool = True) -> Words:
    """Tokenise a whole Arrow column of texts; without ``fold_case`` words that differ in case differ."""
    data, offsets = text_bytes(column)
    starts_all, ends_all, hash_all = [], [], []
    at = 0
    edge = np.unique(offsets)
    for end in _piece_cuts(data, separators):
        piece = LOWER[data[at:end]] if fold_case else data[at:end]
        n = len(piece)
        if not n:
            continue
        inside = ~separators[piece]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        lo, hi = np.searchsorted(edge, [at, end], side="left")
        here = edge[lo:hi] - at  # a text that begins here begins a word
        first[here] |= inside[here]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUES[piece] * _POW[:n], out=sums[1:])
        h = (sums[e] - sums[s]) * _INV[s]
        new_text = lo < hi and edge[lo] == at
        if len(s) and s[0] == 0 and not new_text and ends_all and ends_all[-1][-1] == at:
            # the last word of the piece before goes on here: append the parts' hashes
            length = int(ends_all[-1][-1] - starts_all[-1][-1])
            shift = U64(pow(_BASE, length, 1 << 64))
            hash_all[-1][-1:] += h[:1] * shift
            ends_all[-1][-1] = at + e[0]
            s, e, h = s[1:], e[1:], h[1:]
        if len(s):
            starts_all.append(s + at)
            ends_all.append(e + at)
            hash_all.append(h)
        at = end
    join = (lambda xs, t: np.concatenate(xs) if xs else np.empty(0, t))
    starts, ends, hashes = join(starts_all, np.int64), join(ends_all, np.int64), join(hash_all, U64)
    hashes = mix(hashes + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets).astype(np.int64), data, offsets)


def _from(x: np.ndarray, k: int) -> np.ndarray:
    """``x`` from its k-th element on, filled up with zeros."""
    out = np.zeros_like(x)
    if k < len(x):
        out[:len(x) - k] = x[k:]
    return out


def sequence_hashes(hashes: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``length`` consecutive words from each word on, and which of these stay inside their text.

    Runs of 1, 2, 4, ... words are hashed by doubling and joined by the bits of ``length``.
    """
    power, out, done, run = mix(hashes + U64(0x51_7C_C1_B7_27_22_0A_95)), None, 0, 1
    while True:
        if length & run:
            out = power if out is None else mix(out * U64(0x9FB21C651E98DF25) + _from(power, done))
            done += run
        if run * 2 > length:
            break
        power = mix(power * U64(0xA24BAED4963EE407) + _from(power, run))
        run *= 2
    end = np.repeat(bounds[1:], np.diff(bounds))
    return out + U64(length), np.arange(len(hashes)) + length <= end


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 4 << 20, max_rows: int = 4096):
    """Cut a batch into runs of rows holding about ``max_bytes`` of text (always at least one row)."""
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = text_bytes(column)
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        end = min(max(end, at + 1), at + max_rows, n)
        yield batch.slice(at, end - at)
        at = end
