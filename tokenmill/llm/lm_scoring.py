"""Language-model scores from a sharded n-gram trie (Elias-Fano levels, order two).

Words are identified by 64-bit hashes.  The corpus is handled in blocks of
documents; a block and a shard exchange one packed row in each direction.

1. Every block sends its distinct words with their training counts to word
   shards, which answer each with the global count.  Counts are exact.
2. A block, now knowing its words' counts, sends its distinct word pairs to pair
   shards, with the documents they occur in.  A context belongs to one shard; a
   context of more than ``PART`` occurrences is cut into parts by its successors'
   hashes.
3. A pair shard counts its training pairs and tells how many it holds once and
   twice, and how many successors its part of each cut context has.  These are
   added up over all shards, so that neither shards nor parts change a score.
4. The shards, read again, smooth their pairs by absolute discounting with these
   totals into the word level, and build their tries: contexts, monotone pointers,
   context-relative successors, probabilities in 16 bits, all mapped from a
   file in memory that ends with the task.  Every distinct pair is then searched in the trie, and the shard
   returns one sum per document, which are added up per block.

The trie grows with the corpus and is never in one place.  Nothing is cut off:
all pairs of all training texts are in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import schema_with
from tokenmill.llm.elias_fano import BigramTrie, quantise, restore
from tokenmill.session import materialize

U64 = np.uint64
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 60_000
WORDS_PER_SHARD = 1 << 21
PAIRS_PER_SHARD = 1 << 20
MAX_SHARDS = 1 << 16
PART = 1 << 20  # occurrences of a context above which it is cut into parts
BUCKETS = 1024  # of successor hashes; parts are runs of buckets
PRIOR = 0.1
LEVELS = 12.0  # count levels per factor of two
BEGIN, END = U64(0x0B7E151628AED2A6), U64(0x6A09E667F3BCC908)


def _pack(**arrays: np.ndarray) -> bytes:
    """Named arrays as compressed Arrow bytes."""
    batch = pa.RecordBatch.from_arrays(
        [pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), pa.array(a)) for a in arrays.values()], names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data).read_all()
    return {name: table[name].chunk(0).values.to_numpy(zero_copy_only=False) for name in table.column_names}


def _ids(column: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_arrays([column], names=["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def level_of(count: np.ndarray) -> np.ndarray:
    """A count's logarithmic level, in 16 bits; 0 for words that were not seen."""
    return np.where(count > 0, np.rint(np.log2(np.maximum(count, 1)) * LEVELS) + 1, 0).astype(np.uint16)


def count_at(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, np.exp2((level.astype(np.float64) - 1) / LEVELS), 0.0)


class Block:
    """The token stream of some documents: words and one end each."""

    def __init__(self, number: int, part: pa.RecordBatch) -> None:
        w = W.words(part.column(1), W.SPACE)
        self.number, self.ids = number, part.column(0)
        self.held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
        self.lengths = w.counts + 1
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths)])
        tokens = np.empty(self.bounds[-1], U64)
        last = self.bounds[1:] - 1
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner], tokens[last] = w.hashes, END
        self.words, self.tokens = np.unique(tokens, return_inverse=True)
        self.trained = np.bincount(self.tokens, weights=np.repeat(~self.held, self.lengths), minlength=len(self.words)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        for part in W.slices(batch, "text", BLOCK_BYTES, BLOCK_ROWS):
            yield Block(number, part)
            number += 1


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (W.mix(hashes ^ U64(0xC2B2AE3D27D4EB4F)) % U64(shards)).astype(np.int64)


def _send_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            shard = _shard_of(block.words, shards)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            used = [s for s in range(shards) if cut[s] < cut[s + 1]]
            cells = [_pack(words=block.words[order[cut[s]:cut[s + 1]]], trained=block.trained[order[cut[s]:cut[s + 1]]]) for s in used]
            yield pa.RecordBatch.from_arrays([pa.array([block.number] * len(used), pa.int64()), pa.array(used, pa.int32()),
                                              pa.array(cells, pa.binary())], names=["block", "shard", "data"])
    return run


def _count_words(table: pa.Table) -> pa.Table:
    """Answers each block's words with their global counts; the shard's totals ride on its first row."""
    cells = [_unpack(x) for x in table["data"].to_pylist()]
    sizes = [len(c["words"]) for c in cells]
    words, each = np.unique(np.concatenate([c["words"] for c in cells]), return_inverse=True)
    total = np.bincount(each, weights=np.concatenate([c["trained"] for c in cells])).astype(np.int64)
    answer, cut = total[each], np.concatenate([[0], np.cumsum(sizes)])
    known = total > 0
    n = table.num_rows
    return pa.table({"block": table["block"], "shard": table["shard"],
                     "data": pa.array([_pack(counts=answer[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                     "tokens": pa.array([int(total.sum()) if i == 0 else 0 for i in range(n)], pa.int64()),
                     "types": pa.array([int(known.sum()) if i == 0 else 0 for i in range(n)], pa.int64())})


def _send_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        often = np.argsort(-np.bincount(block.tokens, minlength=len(block.words)), kind="stable")  # small numbers for frequent words
        rank = np.empty(len(often), np.uint32)
        rank[often] = np.arange(len(often), dtype=np.uint32)
        data = _pack(words=block.words, rank=rank, tokens=rank[block.tokens], lengths=block.lengths, held=block.held.astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([block.number]), pa.array([-1], pa.int32()), pa.array([data], pa.binary()),
                                          pa.array([_ids(block.ids)], pa.binary())], names=["block", "shard", "data", "ids"])


def parts_of(count: np.ndarray) -> np.ndarray:
    """Parts, a power of two, into which a context of that count is cut."""
    return np.minimum(1 << np.ceil(np.log2(np.maximum(count / PART, 1))).astype(np.int64), BUCKETS)


def _send_pairs(word_shards: int, pair_shards: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["shard", "data", "ids"]).to_pylist()
        own = next(r for r in rows if r["shard"] < 0)
        block, number = _unpack(own["data"]), table["block"][0].as_py()
        words, lengths, held = block["words"], block["lengths"], block["held"]
        shard = _shard_of(words, word_shards)
        count = np.zeros(len(words), np.int64)
        for r in rows:
            if r["shard"] >= 0:
                answer = _unpack(r["data"])["counts"]
                mine = np.flatnonzero(shard == r["shard"])
                if len(answer) != len(mine):
                    raise RuntimeError("the documents were read in another order the second time; write them to a table first")
                count[mine] = answer
        word_of = np.empty(len(words), np.int64)
        word_of[block["rank"]] = np.arange(len(words))
        tokens = word_of[block["tokens"]]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        base = np.add.reduceat(np.log10(count[tokens] + PRIOR), bounds[:-1]) if len(lengths) else np.empty(0)
        known = np.add.reduceat((count[tokens] > 0).astype(np.int64), bounds[:-1]) if len(lengths) else np.empty(0, np.int64)
        # pairs: a context number (the words, then the beginning of a text) and a successor
        context = np.concatenate([[0], tokens[:-1]])
        context[bounds[:-1]] = len(words)
        pair = context.astype(U64) << U64(32) | tokens.astype(U64)
        order = np.argsort(pair, kind="stable")
        run_ = pair[order]
        new = np.ones(len(run_), bool)
        new[1:] = run_[1:] != run_[:-1]
        first = np.flatnonzero(new)
        pair, times = run_[first], np.diff(np.append(first, len(run_)))
        ctx, succ = (pair >> U64(32)).astype(np.int64), (pair & U64(0xFFFFFFFF)).astype(np.int64)
        ctx_hash, ctx_count = np.append(words, BEGIN), np.append(count, count[np.searchsorted(words, END)])
        parts = parts_of(ctx_count)[ctx]
        succ32 = (words[succ] >> U64(32)).astype(np.uint32)
        slot = (succ32 >> np.uint32(22)).astype(np.int64) * parts // BUCKETS
        to = _shard_of(ctx_hash[ctx] + slot.astype(U64) * U64(0x9E3779B97F4A7C15), pair_shards)
        group = np.lexsort((succ32, slot, ctx, to))
        begin = np.cumsum(times) - times
        cut = np.searchsorted(to[group], np.arange(pair_shards + 1))
        docs, out, used = owner[order].astype(np.uint16), [], []
        for s in range(pair_shards):
            g = group[cut[s]:cut[s + 1]]
            if not len(g):
                continue
            c, p = ctx[g], slot[g]
            head = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (p[1:] != p[:-1])])
            n = times[g]
            at = np.arange(n.sum()) + np.repeat(begin[g] - np.cumsum(n) + n, n)
            split = parts[g][head]
            cut_up = np.flatnonzero(split > 1)
            out.append(_pack(
                contexts=ctx_hash[c[head]], sizes=np.diff(np.append(head, len(g))).astype(np.uint32), successors=succ32[g],
                levels=level_of(count[succ[g]]), times=n.astype(np.uint32), docs=docs[at], held=held,
                cut_up=cut_up.astype(np.uint32), parts=split[cut_up].astype(np.uint32), slots=p[head][cut_up].astype(np.uint32), counts=ctx_count[c[head]][cut_up]))
            used.append(s)
        meta = _pack(lengths=lengths, held=held, base=base, known=known)
        n = len(used)
        return pa.table({"block": pa.array([number] * (n + 1), pa.int64()), "shard": pa.array([*used, int(number % pair_shards)], pa.int32()),
                         "data": pa.array([*out, None], pa.binary()), "meta": pa.array([None] * n + [meta], pa.binary()),
                         "ids": pa.array([None] * n + [own["ids"]], pa.binary())})
    return run


class PairShard:
    """All pairs of a shard, gathered from the blocks.

    ``bucket_mass`` (of ``total_mass``) is only needed to score a part of a context without its context's totals.
    """

    def __init__(self, cells: list[dict[str, np.ndarray]], bucket_mass: np.ndarray | None = None, total_mass: float = 1.0) -> None:
        column = (lambda name: np.concatenate([c[name] for c in cells]))
        contexts, sizes = column("contexts"), column("sizes")
        slot, parts, count = np.zeros(len(contexts), np.int64), np.ones(len(contexts), np.int64), np.zeros(len(contexts))
        before = np.cumsum([0, *(len(c["contexts"]) for c in cells)])[:-1]
        at = np.concatenate([c["cut_up"].astype(np.int64) + b for c, b in zip(cells, before, strict=True)])
        slot[at], parts[at], count[at] = column("slots"), column("parts"), column("counts")
        # a part of a context is a context of its own
        key = contexts + slot.astype(U64) * U64(0x9E3779B97F4A7C15)
        self.keys, first, node = np.unique(key, return_index=True, return_inverse=True)
        self.contexts, self.split_count = contexts[first], np.where(parts[first] > 1, count[first], 0.0)
        self.part_mass = np.ones(len(first))
        if bucket_mass is not None:
            width = BUCKETS // parts[first]
            run = np.concatenate([[0.0], np.cumsum(bucket_mass)])
            begin = slot[first] * width
            seen = run[begin + width] - run[begin]
            self.part_mass = np.where(parts[first] > 1, (seen + PRIOR / parts[first]) / total_mass, 1.0)
        node, succ = np.repeat(node, sizes), column("successors")
        times, docs = column("times").astype(np.int64), column("docs").astype(np.int64)
        base = np.cumsum([0, *(len(c["held"]) for c in cells)])
        entries = [int(c["times"].sum(dtype=np.int64)) for c in cells]
        docs = docs + np.repeat(base[:-1], entries)
        train = ~column("held").astype(bool)
        order = np.argsort(node.astype(U64) << U64(32) | succ)
        node, succ, level = node[order], succ[order], column("levels")[order]
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (succ[1:] != succ[:-1])
        distinct = np.empty(len(order), np.int64)
        distinct[order] = np.cumsum(new) - 1
        self.pair_of, self.doc_of, self.n_docs = np.repeat(distinct, times), docs, base
        self.node, self.succ, self.level = node[new], succ[new], level[new]
        self.count = np.bincount(self.pair_of, weights=train[docs], minlength=int(new.sum()))

    def totals(self) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Training pairs that occur once and twice; contexts of the parts held, and their distinct successors."""
        kinds = np.bincount(self.node[self.count > 0], minlength=len(self.keys))
        cut = np.flatnonzero(self.split_count > 0)
        return int((self.count == 1).sum()), int((self.count == 2).sum()), self.contexts[cut], kinds[cut]

    def score(self, total_mass: float, once_twice: tuple[int, int] | None = None, whole: dict[int, int] | None = None) -> np.ndarray:
        """log10 probability of each distinct pair, looked up in the trie of the training pairs.

        ``once_twice`` are those totals over all shards, ``whole`` the distinct successors of each cut context in all its parts.
        """
        seen = self.count > 0
        lower = np.log10((count_at(self.level) + PRIOR) / total_mass)
        n = len(self.keys)
        in_part = np.bincount(self.node, weights=self.count, minlength=n)
        kinds = np.bincount(self.node[seen], minlength=n)
        once, twice = once_twice or self.totals()[:2]
        discount = min(0.98, max(0.3, once / max(1, once + 2 * twice)))
        in_all, all_kinds = np.where(self.split_count > 0, self.split_count, in_part), kinds / self.part_mass
        if whole is not None:
            cut = np.flatnonzero(self.split_count > 0)
            all_kinds[cut] = [whole[c] for c in self.contexts[cut].tolist()]
        back = np.where(in_all > 0, discount * all_kinds / np.maximum(in_all, 1), 1.0)
        node = self.node[seen]
        direct = (self.count[seen] - discount) / in_all[node] + back[node] * 10.0 ** lower[seen]
        used = np.flatnonzero(kinds)
        trie = BigramTrie(self.keys[used], kinds[used], self.succ[seen], np.log10(direct), np.log10(back[used]))
        at = trie.nodes(self.keys)  # contexts without a training pair are not in the trie
        out = restore(quantise(np.log10(np.maximum(back, 1e-300))))[self.node] + lower
        inside = at[self.node] >= 0
        out[inside] = trie.log10(at[self.node[inside]], self.succ[inside], lower[inside])
        return out

    def sums(self, scores: np.ndarray) -> list[np.ndarray]:
        total = np.bincount(self.doc_of, weights=scores[self.pair_of], minlength=self.n_docs[-1])
        return [total[a:b] for a, b in zip(self.n_docs, self.n_docs[1:], strict=False)]


def _count_pairs(table: pa.Table) -> pa.Table:
    """What a shard adds to the totals: a row without a context, and one for each of its parts of contexts."""
    cells = [_unpack(d) for d in table["data"].to_pylist() if d is not None]
    shard = table["shard"][0].as_py()
    once, twice, contexts, kinds = PairShard(cells).totals() if cells else (0, 0, np.empty(0, U64), np.empty(0, np.int64))
    n = len(contexts)
    return pa.table({"shard": pa.array([shard] * (n + 1), pa.int32()), "context": pa.array([None, *contexts.view(np.int64).tolist()], pa.int64()),
                     "once": pa.array([once] + [0] * n, pa.int64()), "twice": pa.array([twice] + [0] * n, pa.int64()),
                     "kinds": pa.array([0, *kinds.tolist()], pa.int64())})


def _score_pairs(total_mass: float):
    def run(table: pa.Table, totals: pa.Table) -> pa.Table:
        data = table["data"].to_pylist()
        rows = [i for i, d in enumerate(data) if d is not None]
        sums: list[bytes | None] = [None] * len(data)
        if rows:
            known = totals.to_pylist()
            once, twice = next((r["once"], r["twice"]) for r in known if r["context"] is None)
            whole = {r["context"] % (1 << 64): r["kinds"] for r in known if r["context"] is not None}
            shard = PairShard([_unpack(data[i]) for i in rows])
            scores = shard.score(total_mass, (once, twice), whole)
            for i, s in zip(rows, shard.sums(scores), strict=True):
                sums[i] = _pack(sums=s.astype(np.float32))
        return pa.table({"block": table["block"], "shard": table["shard"], "data": pa.array(sums, pa.binary()),
                         "meta": table["meta"], "ids": table["ids"]})
    return run


def _add_up(train_tokens: int, total_mass: float):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["shard", "data", "meta", "ids"]).to_pylist(), key=lambda r: r["shard"])
        own = next(r for r in rows if r["meta"] is not None)
        meta = _unpack(own["meta"])
        score = np.zeros(len(meta["lengths"]))
        for r in rows:
            if r["data"] is not None:
                score += _unpack(r["data"])["sums"]
        ids = pa.ipc.open_stream(own["ids"]).read_all()["id"]
        n = len(score)
        return pa.table({"id": ids, "held_out": pa.array(meta["held"].astype(bool)), "n_tokens": pa.array(meta["lengths"].astype(np.int64)),
                         "n_known": pa.array(meta["known"].astype(np.int64)), "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
                         "base_score": pa.array(meta["base"] - meta["lengths"] * np.log10(total_mass)), "score": pa.array(score)})
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are runs of bytes other than ASCII white space, ``A-Z`` lower-cased,
    and one end.  Rows whose crc32(id as text) modulo ``folds`` is not 0 train
    the model (a null id counts as an empty text).  ``base_score`` is the text's
    log10 probability by words alone with ``PRIOR`` added to each count,
    ``score`` that of the trie.  A null or empty text is one end token.
    Repeated rows count and are scored one by one; other columns are ignored; an
    empty table gives none; without training rows all counts are 0 and all
    words equally likely.

    The documents are read twice, and must come in the same order both times, as
    files or written tables do; otherwise the run stops with an error.
    """
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.pmod(crc, F.lit(folds)) == 0).alias("held"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_shards = int(min(MAX_SHARDS, max(8, size // 12 // WORDS_PER_SHARD)))
    pair_shards = int(min(MAX_SHARDS, max(16, size // 6 // PAIRS_PER_SHARD)))
    cells = source.mapInArrow(_send_words(word_shards), "block long, shard int, data binary")
    counted = cells.groupBy("shard").applyInArrow(
        _count_words, "block long, shard int, data binary, tokens long, types long")
    counted = materialize(counted, "lm-words")
    n, v = counted.agg(F.sum("tokens"), F.sum("types")).first()
    total_mass = (n or 0) + PRIOR * ((v or 0) + 1)
    answers = counted.select("block", "shard", "data", F.lit(None).cast("binary").alias("ids"))
    blocks = source.mapInArrow(_send_blocks, "block long, shard int, data binary, ids binary").unionByName(answers)
    pairs = blocks.groupBy("block").applyInArrow(_send_pairs(word_shards, pair_shards), "block long, shard int, data binary, meta binary, ids binary")
    # both readings of the shards are in one plan, so that the exchange of the pairs is done once
    totals = pairs.groupBy("shard").applyInArrow(_count_pairs, "shard int, context long, once long, twice long, kinds long")
    context = Window.partitionBy("context")
    totals = totals.select("shard", "context", *[F.sum(c).over(context).alias(c) for c in ("once", "twice", "kinds")])
    sums = pairs.groupBy("shard").cogroup(totals.groupBy("shard")).applyInArrow(
        _score_pairs(total_mass), "block long, shard int, data binary, meta binary, ids binary")
    schema = schema_with(source, "id", "id", "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return sums.groupBy("block").applyInArrow(_add_up(n or 0, total_mass), schema).withColumnRenamed("id", id_col)
