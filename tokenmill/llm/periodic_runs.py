"""Periodic runs of words by the branching-tandem test on enhanced suffix arrays.

A run is a maximal stretch of words with smallest period q and at least two
periods long.  Its last square (two equal halves of q words, ending where the run
ends) is a branching one: the suffixes at its two halves agree in exactly q words,
so some LCP interval of depth q holds both, in different children.

For every boundary of an LCP interval the suffixes of the smaller side are
looked at, n log n in all: is the suffix ``depth`` words further, or before, on the
other side, by its place in the inverse suffix array?  A hit is a square; it is
rotated to the left as far as the words repeat, and squares that come to cover the
same words are one run, of the smallest period among them.

All documents of a slice share one suffix array, in which suffixes of different
documents never agree.  It is built by prefix doubling that only sorts what is not
told apart yet; the ranks of each doubling are kept and answer the comparisons.  No
tree is built: intervals are found from the LCP array by pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import column, own_columns, schema_with

MIN_LENGTH = 12
SLICE_BYTES = 2 << 20
EXPAND = 1 << 21  # suffixes looked at together


class SuffixArray:
    """Suffixes of several documents: ``order``, its inverse ``rank``, ``lcp`` with the suffix before, ``levels``.

    ``levels[l][i]`` is equal for two suffixes of a document if they agree in their
    first ``2 ** l`` words, and for no others.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        n = len(hashes)
        counts = np.diff(bounds)
        owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        end = np.repeat(bounds[1:], counts)
        key = W.mix(hashes + owner * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        key = key[order]
        fresh = np.empty(n, bool)
        fresh[:1] = True
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        rank = np.full(n + 1, -1, np.int32 if n < 1 << 31 else np.int64)  # where the group of a suffix begins
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.lcp = np.full(n + 1, 0, np.int64)
        self.lcp[[0, -1]] = -1
        self.levels = []
        several = ~fresh
        several[:-1] |= ~fresh[1:]
        at, h = np.flatnonzero(several), 1
        while len(at):
            self.levels.append(rank.copy())
            suffix = order[at]
            old = rank[suffix].astype(np.int64)
            ahead = suffix + h
            key = old * (n + 1) + np.where(ahead < end[suffix], rank[np.minimum(ahead, n)], -1) + 1
            by = np.argsort(key)
            suffix, old, key = suffix[by], old[by], key[by]
            order[at] = suffix
            begins = np.empty(len(at), bool)
            begins[:1] = True
            np.not_equal(key[1:], key[:-1], out=begins[1:])
            cut = np.flatnonzero(begins[1:] & (old[1:] == old[:-1])) + 1
            self.lcp[at[cut]] = h + self._agree(suffix[cut - 1] + h, suffix[cut] + h)
            rank[suffix] = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
            several = ~begins
            several[:-1] |= ~begins[1:]
            at, h = at[several], h * 2
        self.order, self.rank = order, rank

    def _agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that suffixes have in common which the last level tells apart."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            ranks, step = self.levels[level], 1 << level
            same = (ranks[i] == ranks[j]) * step
            out += same
            i += same
            j += same
        return out

    def rotate(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` agree with those before ``j`` (i < j, suffixes of one document)."""
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            ranks, step = self.levels[level], 1 << level
            live = np.arange(len(i))
            while len(live):  # more than once only at the last level
                a, b = i[live] - out[live] - step, j[live] - out[live] - step
                live = live[(a >= 0) & (ranks[np.maximum(a, 0)] == ranks[np.maximum(b, 0)])]
                out[live] += step
        return out


def _nearest(lcp: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each boundary the nearest one on a side whose value is smaller (on the left: not larger)."""
    to = np.arange(len(lcp)) + step
    live = at
    while len(live):
        here, there = lcp[live], lcp[to[live]]
        live = live[there > here if step < 0 else there >= here]
        to[live] = to[to[live]]
    return to[at]


def find_squares(sa: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all branching squares, each found once."""
    lcp, n = sa.lcp, len(sa.order)
    at = np.flatnonzero(lcp > 0)
    low, high = _nearest(lcp, at, -1), _nearest(lcp, at, 1)  # left side [low, at), right side [at, high)
    left_smaller = at - low <= high - at
    small, small_end = np.where(left_smaller, low, at), np.where(left_smaller, at, high)
    other, other_end = np.where(left_smaller, at, low), np.where(left_smaller, high, at)
    size = small_end - small
    upto = np.cumsum(size)
    starts, periods, a = [], [], 0
    while a < len(at):
        done = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, done + EXPAND, side="right")))
        which = np.repeat(np.arange(a, b), size[a:b])
        i = sa.order[small[which] + np.arange(len(which)) - np.repeat(upto[a:b] - size[a:b] - done, size[a:b])]
        depth = lcp[at[which]]
        for sign in (1, -1):
            j = i + sign * depth
            r = sa.rank[np.where((j >= 0) & (j < n), j, n)]  # -1 beyond the ends: on no side
            hit = (r >= other[which]) & (r < other_end[which])
            starts.append(np.minimum(i, j)[hit])
            periods.append(depth[hit])
        a = b
    return np.concatenate(starts or [np.empty(0, np.int64)]), np.concatenate(periods or [np.empty(0, np.int64)])


def find_runs(hashes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; starts count through all documents."""
    sa = SuffixArray(hashes, bounds)
    start, period = find_squares(sa)
    end = start + 2 * period
    start = start - sa.rotate(start, start + period)
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    keep = np.ones(len(start), bool)  # of squares over the same words, the smallest period
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= end - start >= np.maximum(min_length, 2 * period)
    start, end, period = start[keep], end[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def collapse(w: W.Words, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts without what runs repeat: words joined by one space."""
    n = len(w.hashes)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.starts[kept]] += 1
    inside[w.ends[kept]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    doc = np.searchsorted(w.bounds, kept, side="right")
    later = kept[1:][doc[1:] == doc[:-1]]  # not the first of their text: the byte before is white space
    data = w.data.copy()
    data[w.starts[later] - 1] = 0x20
    inside[w.starts[later] - 1] = True
    sizes = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    return data[inside], sizes[w.text_offsets]


def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``.

    Words are runs of bytes other than ASCII white space, numbered from 0, and
    differ if their case does.  A run has at least ``min_length`` words and two
    periods; runs ascend by start, then period.  ``collapsed`` is the text without
    the words of a run after its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows and ties are rows like any others; texts are never cut; input
    columns named like an output are replaced; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    others = own_columns(docs, ("n_words", "runs", "collapsed", text_col))  # the text crosses to the tasks once
    given = docs.select(F.struct(*others, F.lit(0).alias("__none")).alias("__row"), column(text_col).cast("string").alias("__text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    out = schema_with(given, "__row", "__row", "__text string, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "__text", SLICE_BYTES):
                w = W.words(part.column(1), fold_case=False)
                start, length, period = find_runs(w.hashes, w.bounds, min_length)
                data, offsets = collapse(w, start, length, period)
                doc = np.searchsorted(w.bounds, start, side="right") - 1
                runs = pa.StructArray.from_arrays([pa.array(start - w.bounds[doc]), pa.array(length), pa.array(period)], fields=list(run))
                per_doc = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                texts = pa.LargeStringArray.from_buffers(part.num_rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(w.counts), pa.ListArray.from_arrays(pa.array(per_doc), runs), texts.cast(pa.string())], names=out.names)

    back = [(F.col("__text") if c.lower() == text_col.lower() else F.col("__row")[c]).alias(c) for c in kept]
    return given.mapInArrow(find, out).select(*back, "n_words", "runs", "collapsed")
