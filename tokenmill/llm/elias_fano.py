"""Elias-Fano sequences and a two-level n-gram trie over them, as numpy arrays.

A monotone sequence of n numbers below u keeps the low ``log2(u / n)`` bits of
each as they are and the rest as a unary bit vector of about 2n bits.  A level
is a handful of flat arrays, written to a file and mapped back.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_POPCOUNT = _BITS.sum(1).astype(np.uint8)
_NTH = np.zeros((256, 8), np.uint8)  # place of the k-th set bit of a byte
for _k in range(8):
    _NTH[:, _k] = np.argmax(np.cumsum(_BITS, 1) == _k + 1, 1)
_STRIDE = 8  # bytes of the bit vector per directory entry


@dataclass
class EliasFano:
    """``n`` non-decreasing numbers."""

    n: int
    low_bits: int
    low: np.ndarray  # uint64 words of packed low parts
    high: np.ndarray  # bytes of the unary bit vector
    directory: np.ndarray  # set bits before each group of _STRIDE bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high = np.zeros(((n + (top >> low_bits)) // (8 * _STRIDE) + 1) * _STRIDE, np.uint8)
        at = (values >> U64(low_bits)).astype(np.int64) + np.arange(n)
        np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
        low = np.zeros(n * low_bits // 64 + 2, U64)
        if low_bits:
            part = values & U64((1 << low_bits) - 1)
            bit = np.arange(n, dtype=np.int64) * low_bits
            word, shift = bit >> 6, (bit & 63).astype(U64)
            np.bitwise_or.at(low, word, part << shift)
            over = (bit & 63) + low_bits > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        ones = _POPCOUNT[high].reshape(-1, _STRIDE).sum(1, dtype=np.int64)
        return cls(n, low_bits, low, high, np.concatenate([[0], np.cumsum(ones)]))

    def at(self, i: np.ndarray) -> np.ndarray:
        """The numbers at positions ``i``."""
        group = np.searchsorted(self.directory, i, side="right") - 1
        left = i - self.directory[group]
        byte = group * _STRIDE
        live = np.ones(len(i), bool)
        for _ in range(_STRIDE - 1):  # the byte that holds the wanted bit
            have = _POPCOUNT[self.high[byte]]
            live &= left >= have
            left = left - np.where(live, have, 0)
            byte = byte + live
        place = byte * 8 + _NTH[self.high[byte], left]
        out = (place - i).astype(U64) << U64(self.low_bits)
        if self.low_bits:
            bit = i * self.low_bits
            word, shift = bit >> 6, (bit & 63).astype(U64)
            part = self.low[word] >> shift
            over = (bit & 63) + self.low_bits > 64
            part[over] |= self.low[word[over] + 1] << (U64(64) - shift[over])
            out |= part & U64((1 << self.low_bits) - 1)
        return out

    def find(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Position of each value inside its range [low, high) of the sequence, or -1."""
        a, b = low.astype(np.int64).copy(), high.astype(np.int64).copy()
        end = b.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            m = (a[live] + b[live]) >> 1
            up = self.at(m) < values[live]
            a[live[up]] = m[up] + 1
            b[live[~up]] = m[~up]
            live = live[a[live] < b[live]]
        out = np.full(len(values), -1, np.int64)
        inside = np.flatnonzero(a < end)
        same = self.at(a[inside]) == values[inside]
        out[inside[same]] = a[inside[same]]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.directory]


def map_levels(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays, written to a file in memory and mapped read-only from it; no folder is used."""
    out = []
    with os.fdopen(os.memfd_create("levels"), "w+b") as file:
        for a in arrays:
            file.seek(0, 2)
            begin = -(-file.tell() // 64) * 64
            file.seek(begin)
            file.write(a.tobytes() or b"\0")
            file.flush()
            out.append(np.memmap(file, a.dtype, "r", begin, a.shape) if a.size else a)
    return out


def quantise(log10: np.ndarray) -> np.ndarray:
    """16 bits for a log10 probability between -16 and 0."""
    return np.clip(np.rint(-log10 * 4095), 0, 65535).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) / -4095


class BigramTrie:
    """Contexts, monotone pointers to their successors, and quantised probabilities.

    A successor is stored relative to its context: the context's last number
    before it is added, so the whole level is one monotone sequence.
    """

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, successors: np.ndarray, log10: np.ndarray, back_off: np.ndarray) -> None:
        pointers = np.concatenate([[0], np.cumsum(counts)])
        last = successors[pointers[1:] - 1].astype(U64) if len(counts) else np.empty(0, U64)
        base = np.concatenate([[U64(0)], np.cumsum(last + U64(1), dtype=U64)])[:-1] if len(counts) else last
        levels = [EliasFano.of(contexts), EliasFano.of(pointers), EliasFano.of(successors.astype(U64) + np.repeat(base, counts))]
        mapped = map_levels([*(a for level in levels for a in level.arrays()), quantise(log10), quantise(back_off)])
        for i, level in enumerate(levels):
            level.low, level.high, level.directory = mapped[3 * i:3 * i + 3]
        self.contexts, self.pointers, self.successors = levels
        self.probability, self.back_off = mapped[9:]

    def nodes(self, contexts: np.ndarray) -> np.ndarray:
        """Place of each context, or -1."""
        return self.contexts.find(contexts, np.zeros(len(contexts), np.int64), np.full(len(contexts), self.contexts.n, np.int64))

    def log10(self, node: np.ndarray, successor: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 of successors after known contexts; unseen ones back off to ``lower``."""
        begin, end = self.pointers.at(node).astype(np.int64), self.pointers.at(node + 1).astype(np.int64)
        base = np.zeros(len(node), U64)
        after = begin > 0
        base[after] = self.successors.at(begin[after] - 1) + U64(1)
        at = self.successors.find(successor.astype(U64) + base, begin, end)
        out = restore(self.back_off[node]) + lower
        out[at >= 0] = restore(self.probability[at[at >= 0]])
        return out
