"""Benchmark decontamination with suffix arrays over the training texts.

The training texts are the shards: each slice of documents gets an array of its
suffixes (positions), sorted so that suffixes with equal beginnings are
neighbours.  The sort key of a suffix is the chain of hashes of its first 1, 2,
4, 8, ... words, which nests like a lexicographic order does, so binary search
works on it.  Only suffixes that begin with a word pair (or, for one-word
windows, a word) of some test text are entered; no other can hold a match.

Every test suffix is searched in every shard, first for its window (13 words,
or a whole shorter text), which gives all occurrences, and then for its longest
verbatim match, extended word by word from the neighbours.  The test side is
cut into slices of at most ``SLICE_WORDS`` words, one broadcast each, and the
documents pass through them one after the other; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import own_columns, schema_with
from tokenmill.session import freeing, materialize

WINDOW = 13
SLICE_BYTES = 16 << 20
SHARD_BYTES = 4 << 20


@dataclass
class TestSide:
    """The suffixes of a slice of test texts."""

    hashes: np.ndarray
    bounds: np.ndarray
    ids: list
    starts: np.ndarray  # a window of each kind begins here; of equal windows the first
    lengths: np.ndarray  # its words
    items: list[np.ndarray]  # the texts that hold it
    begins: np.ndarray  # sorted hashes of the first min(2, length) words of all windows


def test_side(ids: list, texts: list, window: int) -> TestSide:
    w = W.words(pa.array(texts, pa.string()), W.NON_WORD)
    counts, owner = w.counts, w.owner()
    length = np.minimum(window, counts)[owner]
    whole = np.arange(len(owner)) + length <= w.bounds[1:][owner]
    starts, key = np.flatnonzero(whole), np.zeros(len(owner), np.uint64)
    begins = []
    for n in np.unique(length[starts]):
        key[length == n] = W.sequence_hashes(w.hashes, w.bounds, int(n))[0][length == n]
        begins.append(W.sequence_hashes(w.hashes, w.bounds, min(2, int(n)))[0][starts[length[starts] == n]])
    order = starts[np.lexsort((key[starts], length[starts]))]
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (length[order][1:] != length[order][:-1])
    groups = np.split(owner[order], np.flatnonzero(new)[1:]) if len(order) else []
    return TestSide(w.hashes, w.bounds, ids, order[new], length[order[new]], [np.unique(g) for g in groups],
                    np.unique(np.concatenate(begins)) if begins else np.empty(0, np.uint64))


def _levels(window: int) -> list[int]:
    out = [1]
    while out[-1] * 2 <= window:
        out.append(out[-1] * 2)
    return out


def _chain(hashes: np.ndarray, bounds: np.ndarray, at: np.ndarray, levels: list[int]) -> list[np.ndarray]:
    """For each level, the hash of that many words from ``at`` on; 0 where the text is shorter."""
    out = []
    for n in levels:
        h, whole = W.sequence_hashes(hashes, bounds, n)
        h[~whole] = 0
        out.append(h[at])
    return out


def _narrow(keys: list[np.ndarray], wanted: list[np.ndarray], need: np.ndarray, levels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Range of the sorted suffixes that share the first ``need`` words' levels with each wanted chain."""
    low, high = np.zeros(len(need), np.int64), np.full(len(need), len(keys[0]), np.int64)
    for key, want, n in zip(keys, wanted, levels, strict=True):
        go = np.flatnonzero((need >= n) & (low < high))
        if not len(go):
            continue
        target = want[go]
        left, right = low[go].copy(), high[go].copy()
        for end, side in ((0, "left"), (1, "right")):  # vectorised binary search inside [low, high)
            a, b = left.copy(), right.copy()
            while (a < b).any():
                m = (a + b) >> 1
                seen = key[np.minimum(m, len(key) - 1)]
                up = (a < b) & ((seen < target) | ((seen == target) & (side == "right")))
                down = (a < b) & ~up
                a[up] = m[up] + 1
                b[down] = m[down]
            if end == 0:
                low[go] = a
            else:
                high[go] = a
    return low, high


@dataclass
class Hits:
    """Occurrences of test windows in a shard, and each test window's longest match."""

    position: np.ndarray
    window: np.ndarray  # index into TestSide.starts


def _same(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
          done: np.ndarray) -> np.ndarray:
    """Length of the common beginning of suffixes, of which ``done`` words are known to agree."""
    length = done.copy()
    live = np.arange(len(length))
    while len(live):
        i, j = at_a[live] + length[live], at_b[live] + length[live]
        more = (i < end_a[live]) & (j < end_b[live])
        more[more] = a[i[more]] == b[j[more]]
        live = live[more]
        length[live] += 1
    return length


def search(w: W.Words, test: TestSide) -> Hits:
    """All occurrences of the test side's windows in one shard of training texts."""
    nothing = Hits(np.empty(0, np.int64), np.empty(0, np.int64))
    if not len(w.hashes) or not len(test.starts):
        return nothing
    entered = np.zeros(len(w.hashes), bool)
    for n in {min(2, int(x)) for x in np.unique(test.lengths)}:
        h, whole = W.sequence_hashes(w.hashes, w.bounds, n)
        at = np.searchsorted(test.begins, h)
        at[at == len(test.begins)] = 0
        entered |= whole & (test.begins[at] == h)
    suffixes = np.flatnonzero(entered)
    if not len(suffixes):
        return nothing
    levels = _levels(int(test.lengths.max()))
    keys = _chain(w.hashes, w.bounds, suffixes, levels)
    order = np.lexsort(keys[::-1])
    suffixes, keys = suffixes[order], [k[order] for k in keys]
    wanted = _chain(test.hashes, test.bounds, test.starts, levels)
    low, high = _narrow(keys, wanted, test.lengths, levels)
    size = high - low
    found = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    position = suffixes[np.arange(len(found)) - begin[found] + low[found]]
    # the range agrees on a power of two of words; the window's rest is compared word by word
    ends, test_ends = np.repeat(w.bounds[1:], w.counts), np.repeat(test.bounds[1:], np.diff(test.bounds))
    start = test.starts[found]
    agree = _same(w.hashes, test.hashes, position, start, ends[position],
                  np.minimum(test_ends[start], start + test.lengths[found]), np.zeros(len(found), np.int64))
    full = agree >= test.lengths[found]
    return Hits(position[full], found[full])


def _scan(test: TestSide):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SHARD_BYTES):
                w = W.words(part.column(part.schema.get_field_index("text")), W.NON_WORD)
                hits = search(w, test)
                yield _answer(part, w, hits, test)
    return run


def _answer(part: pa.RecordBatch, w: W.Words, hits: Hits, test: TestSide) -> pa.RecordBatch:
    rows, owner = part.num_rows, w.owner()
    lengths = test.lengths[hits.window]
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(cover, hits.position, 1)
    np.add.at(cover, hits.position + lengths, -1)
    covered = np.cumsum(cover[:-1]) > 0
    before = part.column(part.schema.get_field_index("spans"))
    begin = covered & np.r_[True, ~covered[:-1]] if len(covered) else covered
    if len(covered):
        first = w.bounds[:-1][w.counts > 0]
        begin[first] = covered[first]
    s = np.flatnonzero(begin)
    e = s.copy()
    if len(s):
        stop = np.flatnonzero(covered & np.r_[~covered[1:] | begin[1:], True])
        e = stop[np.searchsorted(stop, s)] + 1
    doc = owner[s]
    spans = [b + x for b, x in zip(before.to_pylist(), _lists(doc, np.stack([s - w.bounds[doc], e - w.bounds[doc]], 1), rows), strict=True)]
    hit_docs = owner[hits.position]
    pairs = np.unique(np.stack([np.repeat(hit_docs, [len(test.items[i]) for i in hits.window]),
                                np.concatenate([test.items[i] for i in hits.window])], 1), axis=0) \
        if len(hits.window) else np.empty((0, 2), np.int64)
    items: list[list] = [[] for _ in range(rows)]
    for d, i in pairs.tolist():
        items[d].append(test.ids[i])
    old = part.column(part.schema.get_field_index("items")).to_pylist()
    items = [a + b for a, b in zip(old, items, strict=True)]
    best = part.column(part.schema.get_field_index("longest")).to_pylist()
    if len(hits.window):
        for d, found in _longest(w, owner, hits, test).items():
            if best[d] is None or found["words"] > best[d]["words"]:
                best[d] = found
    arrays = {"n_words": pa.array(w.counts, pa.int64()), "spans": pa.array(spans, part.schema.field("spans").type),
              "items": pa.array(items, part.schema.field("items").type), "longest": pa.array(best, part.schema.field("longest").type)}
    return pa.RecordBatch.from_arrays([arrays.get(f.name, part.column(i)) for i, f in enumerate(part.schema)], schema=part.schema)


def _lists(doc: np.ndarray, values: np.ndarray, rows: int) -> list[list]:
    cut = np.searchsorted(doc, np.arange(rows + 1))
    return [values[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)]


def _longest(w: W.Words, owner: np.ndarray, hits: Hits, test: TestSide) -> dict[int, dict]:
    """For each document its longest match and where it lies on both sides."""
    ends, test_ends = np.repeat(w.bounds[1:], w.counts), np.repeat(test.bounds[1:], np.diff(test.bounds))
    start, lengths = test.starts[hits.window], test.lengths[hits.window]
    agree = _same(w.hashes, test.hashes, hits.position, start, ends[hits.position], test_ends[start], lengths)
    doc = owner[hits.position]
    order = np.lexsort((start, hits.position, -agree, doc))
    first = order[np.r_[True, doc[order][1:] != doc[order][:-1]]]
    test_owner = np.repeat(np.arange(len(test.bounds) - 1), np.diff(test.bounds))
    return {int(doc[i]): {"words": int(agree[i]), "position": int(hits.position[i] - w.bounds[doc[i]]),
                          "item_id": test.ids[test_owner[start[i]]], "item_position": int(start[i] - test.bounds[test_owner[start[i]]])}
            for i in first}


def _test_slices(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[TestSide]:
    """The test texts in slices of about SLICE_BYTES, so that each is a bounded broadcast."""
    side = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    size = side.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // SLICE_BYTES + 1
    if n > 1:
        side = materialize(side.withColumn("part", F.pmod(F.xxhash64("text", "id"), F.lit(n))), "benchmark")
    for part in range(n):
        rows = (side.filter(F.col("part") == part) if n > 1 else side).select("id", "text").collect()
        yield test_side([r.id for r in rows], [r.text for r in rows], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       percent: int = 5, keep_text: bool = False) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items``, ``spans``, ``longest``, ``contaminated``.

    Words are runs of ASCII letters, digits and non-ASCII bytes, lower-cased.  A
    test text's windows are its runs of ``window`` words; a shorter text, if it
    has words, is one window.  ``n_hit`` counts the document's words inside any
    occurrence of a window, ``spans`` are these stretches [first, end), ``items``
    the sorted distinct ids of the test texts, ``longest`` the longest verbatim
    match with its place on both sides.  A document is contaminated if hit words
    are at least ``percent`` % of its words, and some.

    A null or empty text has no words and is clean; null test texts have no
    windows; null item ids are left out of ``items``; repeated rows are answered
    one by one; an empty table on either side gives clean rows or none.
    """
    item = benchmark.schema[item_col].dataType.simpleString()
    longest = f"struct<words: long, position: long, item_id: {item}, item_position: long>"
    schema = schema_with(docs, id_col, "id", f"text string, n_words long, spans array<array<long>>, items array<{item}>, longest {longest}")
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<array<bigint>>").alias("spans"), F.array().cast(f"array<{item}>").alias("items"),
                      F.lit(None).cast(longest).alias("longest"))
    for side in _test_slices(benchmark, item_col, item_text_col, window):
        out = out.mapInArrow(freeing(_scan(side)), schema)
    # several slices may have hit the same words: merge the stretches, then add them up
    merged = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                         lambda a, s: F.struct((a["n"] + F.greatest(s[1] - F.greatest(s[0], a["end"]), F.lit(0))).alias("n"),
                                               F.greatest(a["end"], s[1]).alias("end")), lambda a: a["n"])
    out = out.withColumn("n_hit", F.when(F.size("spans") == 0, F.lit(0).cast("long")).otherwise(merged))
    out = out.withColumn("items", F.sort_array(F.array_distinct(F.filter("items", lambda i: i.isNotNull()))))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent))
    return out.select(F.col("id").alias(id_col), *(["text"] if keep_text else []), "n_words", "n_hit", "items", "spans", "longest", "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without contaminated ones, all columns kept.

    A document is known by its whole row's text and id, so repeated ids with
    different texts are judged one by one.
    """
    row = F.struct(*own_columns(docs))
    tagged = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    judged = find_contamination(tagged, benchmark, "row", "text", **options)
    return judged.filter(~F.col("contaminated")).select("row.*")
