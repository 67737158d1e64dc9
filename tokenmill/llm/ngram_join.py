"""Documents whose word 5-gram sets overlap: an exact Jaccard join with several global token orders.

With similarity ``t`` a set of n tokens has at most n - ceil(t n) tokens outside
any partner.  So under *every* global order of the tokens two partners share one
of their first n - ceil(t n) + 1, and more generally the first ``l`` common
tokens lie within the first n - ceil(t n) + l of both.  Several orders are used,
and a pair has to pass all of them before it is verified on the whole sets:

* hash order: the first tokens of every document are looked up across the whole
  table; a document stays only if enough of them occur in another document;
* rarest first: exact document frequencies among those that stay; a document
  stays only if a token of its prefix is shared;
* hash order turned so that another block of it comes first, one order a block.
  Partners of n and m tokens differ in at most d = (n + m)(1 - t)/(1 + t) of them,
  so under more than d orders with tokens of theirs in front at least one has
  the same tokens in front of both.  Such a whole leading block is the key that
  makes candidates: passages that many documents share bring together only
  documents alike in all of a block.  A document with too few such blocks also has
  the shared tokens of its rarest-first prefix as keys;
* the differing tokens are bounded from below by the number of tokens that no other
  document has, plus what 256 parities of the other tokens, or sums of these in ranges
  of the hash order, a byte a range, tell of them, so most candidates go before a set is sent;
* hash order from either end and rarest first, checked on each pair that is left.

Tokens travel as packed arrays, one row per block of documents and token shard,
and a block sends each token once, so a token that every document holds costs a
row's entry per block.  Equal sets are one document from the second step on.

Candidates are not all pairs of a key's documents.  First each is compared
with one pivot of the key; then, while a key's documents lie in several
components, those outside its largest component are compared with the documents
of other components.  Pairs inside a component cannot change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import own_columns, schema_with
from tokenmill.llm.components import connected_components
from tokenmill.session import freeing, freeing_group, materialize

SHINGLE = 5
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096
ENTRIES_PER_SHARD = 1 << 20
MAX_SHARDS = 1 << 16
BROADCAST_IDS = 1 << 20
PAIRS_PER_COPY = 64  # a document of more pairs is sent to them in several copies
MANY = np.uint16(0xFFFF)  # instead of an owner: several documents of the block hold the token
U64 = np.uint64


def shingle_sets(w: W.Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): each text's distinct shingles in hash order; a text of fewer words is one shingle."""
    counts, owner = w.counts, w.owner()
    h, whole = W.sequence_hashes(w.hashes, w.bounds, k)
    tokens, owners = [h[whole]], [owner[whole]]
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            tokens.append(W.sequence_hashes(w.hashes, w.bounds, n)[0][w.bounds[short]])
            owners.append(short)
    tokens, owners = np.concatenate(tokens), np.concatenate(owners)
    packed = owners.astype(U64) << U64(52) | tokens >> U64(12)  # at most 4096 texts
    order = np.argsort(packed)
    packed, tokens, owners = packed[order], tokens[order], owners[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    if (new[1:] & (packed[1:] == packed[:-1])).any():  # tokens that differ in the last bits only
        order = np.lexsort((tokens, owners))
        tokens, owners = tokens[order], owners[order]
        new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    tokens, owners = tokens[new], owners[new]
    return tokens, np.searchsorted(owners, np.arange(len(counts) + 1))


def set_digests(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set; equal sets have equal ones."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x94D049BB133111EB):
        run = np.concatenate([[U64(0)], np.cumsum(W.mix(tokens ^ U64(salt)), dtype=U64)])
        out.append((run[bounds[1:]] - run[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def least_common(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def _hash_prefix(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of the prefix in hash order, and how many of it a partner must hold."""
    common = least_common(n, percent)
    return np.minimum(n, n - common + n // 10 + 1), np.minimum(common // 10 + 1, n)


def size_levels(most: int, percent: int) -> np.ndarray:
    """Least set size of each level, beyond ``most`` by two; partners' levels differ by at most one."""
    least = [1]
    while len(least) < 3 or least[-3] <= most:
        least.append(least[-1] * 100 // percent + 1)
    return np.array(least)


def most_apart(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that at most are in only one of two linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def leading_blocks(tokens: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, owners, few): a key for the tokens of each block of the hash order, of sets in that order.

    The number of blocks follows from the size level, so a set has keys for its
    level and the next, and partners meet at the larger one's level.  ``few``: sets
    that may differ from a partner in all their blocks that hold tokens.
    """
    least = size_levels(int(n.max(initial=1)), percent)
    own, owner = np.searchsorted(least, n, "right") - 1, np.repeat(np.arange(len(n)), n)
    keys, owners, few = [], [], np.zeros(len(n), bool)
    for level in (own, own + 1):
        top = least[level + 1] - 1
        apart = most_apart(top, top, percent)
        blocks = apart + apart // 6 + np.where(apart > 0, 3, 1)
        first = np.cumsum(blocks) - blocks
        place = first[owner] + ((tokens >> U64(32)) * blocks[owner].astype(U64) >> U64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(place, prepend=-1))
        doc = owner[at]
        sums = np.add.reduceat(W.mix(tokens ^ U64(0x9E3779B97F4A7C15)), at) if len(at) else np.empty(0, U64)
        where = level[doc].astype(U64) << U64(48) | (place[at] - first[doc]).astype(U64)
        keys.append(W.mix(sums + W.mix(where)))
        owners.append(doc)
        partner = np.minimum(n * 100 // percent, top)
        few |= np.bincount(doc, minlength=len(n)) <= most_apart(n, partner, percent)
    return np.concatenate(keys), np.concatenate(owners), few


def range_sums(tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): for each set of a hash order, sums of odd bytes of the tokens in 2^floor(log2 n) ranges."""
    bits = np.frexp(n.astype(float))[1] - 1
    bounds = np.concatenate([[0], np.cumsum(1 << bits)])
    owner = np.repeat(np.arange(len(n)), n)
    place = bounds[owner] + (tokens >> (63 - bits[owner]).astype(U64) >> U64(1)).astype(np.int64)
    at = np.flatnonzero(np.diff(place, prepend=-1))
    out = np.zeros(bounds[-1], np.uint8)
    if len(at):
        value = (W.mix(tokens ^ U64(0xD6E8FEB86659FD93)) >> U64(56) | U64(1)).astype(np.uint8)
        out[place[at]] = np.add.reduceat(value, at, dtype=np.uint8)
    return out, bounds


def parities(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each set of a hash order, 256 bits in four words: parities of its tokens by their first byte."""
    bits = np.bincount(np.repeat(np.arange(len(n)), n) << 8 | (tokens >> U64(56)).astype(np.int64), minlength=len(n) << 8) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(-1, 4)


def least_apart(x: np.ndarray, y: np.ndarray) -> int:
    """Tokens that at least are in only one of two sets with these range sums."""
    while len(x) > len(y):
        x = x[0::2] + x[1::2]
    while len(y) > len(x):
        y = y[0::2] + y[1::2]
    d = x - y
    # an even difference that is not 0 takes two tokens, since the bytes are odd
    return 2 * int(np.count_nonzero(d)) - int(np.count_nonzero(d & np.uint8(1)))


def _heads(lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions of the first ``lengths`` elements of each run."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(bounds[:-1] - total + lengths, lengths)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _blocks(batches: Iterator[pa.RecordBatch], k: int):
    """(block number, ids, tokens, bounds, digests) of each slice of a task's input."""
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        for part in W.slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
            tokens, bounds = shingle_sets(W.words(part.column(1), W.SPACE), k)
            d1, d2 = set_digests(tokens, bounds)
            meta = pa.RecordBatch.from_arrays([part.column(0), pa.array(d1), pa.array(d2), pa.array(np.diff(bounds))],
                                              names=["id", "d1", "d2", "n"])
            yield number, meta, tokens, bounds
            number += 1


def _cells(number: int, keys: np.ndarray, values: np.ndarray, shards: int, meta: bytes | None) -> pa.RecordBatch:
    """Sorted ``keys`` of a block and a value for each, dealt to the shards."""
    shard = (keys % U64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    keys, values = keys[order], values[order]
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    used = [s for s in range(shards) if cut[s] < cut[s + 1] or (s == 0 and meta is not None)]
    return pa.RecordBatch.from_arrays(
        [pa.array([number] * len(used), pa.int64()), pa.array(used, pa.int32()),
         pa.array([keys[cut[s]:cut[s + 1]].tobytes() for s in used], pa.binary()),
         pa.array([values[cut[s]:cut[s + 1]].tobytes() for s in used], pa.binary()),
         pa.array([meta if s == 0 else None for s in used], pa.binary())], names=["block", "shard", "keys", "own", "meta"])


def _gather(table: pa.Table, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, values and row numbers of all cells of a shard."""
    keys = [np.frombuffer(x, U64) for x in table["keys"].to_pylist()]
    values = [np.frombuffer(x, dtype) for x in table["own"].to_pylist()]
    rows = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
    return np.concatenate(keys), np.concatenate(values), rows


def documents_with_partners(docs: DataFrame, percent: int, k: int, shards: int) -> DataFrame:
    """(id, d1, d2, n, possible): whether enough of a document's first tokens in hash order occur elsewhere."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, meta, tokens, bounds in _blocks(batches, k):
            n = np.diff(bounds)
            length, _ = _hash_prefix(n, percent)
            at = _heads(length, bounds)
            owner = np.repeat(np.arange(len(n)), length)
            keys, first, each, count = np.unique(tokens[at], return_index=True, return_inverse=True, return_counts=True)
            shared_here = np.bincount(owner[count[each] > 1], minlength=len(n))
            own = np.where(count > 1, MANY, owner[first].astype(np.uint16)) if len(keys) else np.empty(0, np.uint16)
            yield _cells(number, keys, own.astype(np.uint16), shards, _ipc(meta.append_column("here", pa.array(shared_here))))

    def look_up(table: pa.Table) -> pa.Table:
        keys, own, rows = _gather(table, np.uint16)
        order = np.argsort(keys)
        run = keys[order]
        twin = np.zeros(len(run), bool)
        twin[1:] = run[1:] == run[:-1]
        twin[:-1] |= twin[1:].copy()
        shared = np.empty(len(run), bool)
        shared[order] = twin
        hit = shared & (own != MANY)
        cut = np.searchsorted(rows[hit], np.arange(table.num_rows + 1))
        own = own[hit]
        counts = [np.bincount(own[a:b]).astype(np.uint32).tobytes() for a, b in zip(cut, cut[1:], strict=False)]
        return pa.table({"block": table["block"], "counts": pa.array(counts, pa.binary()), "meta": table["meta"]})

    def decide(table: pa.Table) -> pa.Table:
        meta = _from_ipc(next(m for m in table["meta"].to_pylist() if m is not None))
        n = meta["n"].to_numpy()
        seen = meta["here"].to_numpy().astype(np.int64).copy()
        for counts in table["counts"].to_pylist():
            c = np.frombuffer(counts, np.uint32)
            seen[:len(c)] += c
        _, need = _hash_prefix(n, percent)
        return pa.table({"id": meta["id"], "d1": meta["d1"], "d2": meta["d2"], "n": meta["n"], "possible": pa.array((n > 0) & (seen >= need))})

    cells = docs.mapInArrow(freeing(send), "block long, shard int, keys binary, own binary, meta binary")
    answers = cells.groupBy("shard").applyInArrow(freeing_group(look_up), "block long, counts binary, meta binary")
    return answers.groupBy("block").applyInArrow(
        freeing_group(decide), schema_with(docs, "id", "id", "d1 long, d2 long, n long, possible boolean"))


def rare_prefixes(docs: DataFrame, percent: int, k: int, shards: int) -> DataFrame:
    """(cid, d1, d2, n, alone, prefix, tokens, keys, few, sums, p0 to p3) of documents with a shared token in their rarest-first prefix.

    ``prefix`` holds these shared tokens, rarest first, after ``alone`` tokens
    that no other document has; ``tokens`` the whole set in hash order; ``keys``
    and ``few`` follow :func:`leading_blocks`.  Of the tokens that other documents
    have too, ``sums`` follow :func:`range_sums`, ``p0`` to ``p3`` :func:`parities`.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, meta, tokens, bounds in _blocks(batches, k):
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_ipc(meta.drop_columns(["id"]))], pa.binary()),
                                              pa.array([tokens.tobytes()], pa.binary())], names=["block", "meta", "tokens"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, count = np.unique(np.frombuffer(tokens.as_buffer(), U64), return_counts=True)
                yield _cells(number, keys, count.astype(np.uint16), shards, None)

    def look_up(table: pa.Table) -> pa.Table:
        keys, here, rows = _gather(table, np.uint16)
        _, each = np.unique(keys, return_inverse=True)
        total = np.bincount(each, weights=here).astype(np.uint32)[each]
        cut = np.searchsorted(rows, np.arange(table.num_rows + 1))
        return pa.table({"block": table["block"], "shard": table["shard"], "meta": pa.nulls(table.num_rows, pa.binary()),
                         "tokens": pa.array([total[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())})

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["shard"] < 0)
        meta, tokens = _from_ipc(own["meta"]), np.frombuffer(own["tokens"], U64)
        n = meta["n"].to_numpy()
        bounds = np.concatenate([[0], np.cumsum(n)])
        keys = np.unique(tokens)
        shard, df = (keys % U64(shards)).astype(np.int32), np.zeros(len(keys), np.uint32)
        for r in rows:
            if r["shard"] >= 0:
                df[shard == r["shard"]] = np.frombuffer(r["tokens"], np.uint32)
        freq = df[np.searchsorted(keys, tokens)]
        owner = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((tokens, freq, owner))
        length = n - least_common(n, percent) + 1
        place = np.arange(len(tokens)) - bounds[owner]
        chosen = order[(place < length[owner]) & (freq[order] > 1)]
        cut = np.searchsorted(owner[chosen], np.arange(len(n) + 1))
        docs_in = np.flatnonzero(cut[1:] > cut[:-1])
        take = pa.array(docs_in, pa.int64())
        as_lists = (lambda v, b: pa.LargeListArray.from_arrays(pa.array(b, pa.int64()), pa.array(v.view(np.int64))))
        out = [meta[c].take(take) for c in ("d1", "d2", "n")]
        prefix = as_lists(tokens[chosen], cut).take(take).cast(pa.list_(pa.int64()))
        whole = as_lists(tokens, bounds).take(take).cast(pa.list_(pa.int64()))
        alone = np.bincount(owner[freq == 1], minlength=len(n))[docs_in]
        kept = np.isin(owner, docs_in)
        keys, of, few = leading_blocks(tokens[kept], n[docs_in], percent)
        order = np.argsort(of, kind="stable")
        keys = as_lists(keys[order], np.searchsorted(of[order], np.arange(len(docs_in) + 1))).cast(pa.list_(pa.int64()))
        shared = tokens[kept & (freq > 1)]  # what is alone in two sets differs beside what of these does
        sums, cut = range_sums(shared, n[docs_in] - alone)
        sums = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs_in), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(sums)])
        odd = parities(shared, n[docs_in] - alone)
        return pa.table({"d1": out[0], "d2": out[1], "n": out[2], "alone": pa.array(alone, pa.int64()), "prefix": prefix, "tokens": whole,
                         "keys": keys, "few": pa.array(few), "sums": sums.cast(pa.binary()), **{f"p{i}": pa.array(odd[:, i]) for i in range(4)}})

    packed = materialize(docs.mapInArrow(freeing(pack), "block long, meta binary, tokens binary"), "ngram-blocks")
    cells = packed.select("block", "tokens").mapInArrow(freeing(send), "block long, shard int, keys binary, own binary, meta binary")
    answers = cells.groupBy("shard").applyInArrow(freeing_group(look_up), "block long, shard int, meta binary, tokens binary")
    chosen = packed.select("block", F.lit(-1).alias("shard"), "meta", "tokens").unionByName(answers).groupBy("block") \
        .applyInArrow(freeing_group(choose), "d1 long, d2 long, n long, alone long, prefix array<long>, tokens array<long>, keys array<long>, few boolean, sums binary, "
               "p0 long, p1 long, p2 long, p3 long")
    return materialize(chosen.withColumn("cid", F.monotonically_increasing_id()), "ngram-prefixes")


def _may_link(na: Column, alone_a: Column, nb: Column, alone_b: Column, percent: int) -> Column:
    """Whether sets of these sizes, so many tokens of which no other document has, can have the similarity."""
    common = F.least(na - alone_a, nb - alone_b)
    return common * 100 >= (na + nb - common) * percent


def _with_sets(pairs: DataFrame, key: str, other: str, sets: DataFrame) -> DataFrame:
    """The pairs with the columns of ``sets`` by ``key``; a document of many pairs is dealt to several tasks."""
    many = pairs.groupBy(key).agg(F.ceil(F.count("*") / PAIRS_PER_COPY).cast("int").alias("copies")).filter("copies > 1")
    many = materialize(many, "ngram-many")
    copies = F.coalesce("copies", F.lit(1))
    dealt = pairs.join(many, key, "left").withColumn("copy", F.pmod(F.xxhash64(other), copies).cast("int")).drop("copies")
    sent = sets.join(many, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    return dealt.join(sent, [key, "copy"]).drop("copy")


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, near): whether lone tokens and the range sums of the others leave the similarity possible."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = most_apart(batch["na"].to_numpy(), batch["nb"].to_numpy(), percent)
            most -= batch["la"].to_numpy() + batch["lb"].to_numpy()
            near = [least_apart(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) <= m
                    for x, y, m in zip(batch["sa"], batch["sb"], most, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(near, pa.bool_())], names=["a", "b", "near"])

    joined = _with_sets(pairs, "a", "b", sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("alone").alias("la"), F.col("sums").alias("sa")))
    joined = _with_sets(joined, "b", "a", sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("alone").alias("lb"), F.col("sums").alias("sb")))
    return joined.select("a", "b", "na", "nb", "la", "lb", "sa", "sb").mapInArrow(freeing(compare), "a long, b long, near boolean")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): whether the sets have the similarity; before that, both hash orders and rarest first must agree."""
    one = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"), F.col("prefix").alias("pa"))
    two = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"), F.col("prefix").alias("pb"))
    joined = _with_sets(_with_sets(pairs, "a", "b", one), "b", "a", two)
    length = (lambda n: (n - F.ceil(n * percent / 100.0) + 1).cast("int"))
    head = F.arrays_overlap(F.slice("ta", 1, length(F.col("na"))), F.slice("tb", 1, length(F.col("nb"))))
    tail = F.arrays_overlap(F.slice("ta", F.col("na").cast("int") - length(F.col("na")) + 1, length(F.col("na"))),
                            F.slice("tb", F.col("nb").cast("int") - length(F.col("nb")) + 1, length(F.col("nb"))))
    common = F.size(F.array_intersect("ta", "tb"))
    linked = F.when(F.arrays_overlap("pa", "pb") & head & tail, common * 100 >= (F.col("na") + F.col("nb") - common) * percent).otherwise(False)
    return joined.select("a", "b", linked.alias("linked"))


def _judge(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of all the pairs; whole sets are sent for those only that the range sums leave."""
    near = materialize(_near(pairs, sets, percent), "ngram-near")
    far = near.filter(~F.col("near")).select("a", "b", F.lit(False).alias("linked"))
    return materialize(far.unionByName(_verify(near.filter("near").select("a", "b"), sets, percent)), "ngram-checked")


def link_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the link graph over the rows of :func:`rare_prefixes`."""
    keys = F.concat("keys", F.when(F.col("few"), F.col("prefix")).otherwise(F.array().cast("array<long>")))
    entries = sets.select("cid", "n", "alone", F.explode(keys).alias("token"))
    # the pivot is the document with the fewest tokens of its own: the likeliest to be near all others
    pivot = entries.groupBy("token").agg(F.min(F.struct("alone", "cid", "n")).alias("p"), F.count("*").alias("c")).filter("c > 1")
    entries = materialize(entries.join(pivot.select("token", "p"), "token"), "ngram-entries")
    pairs = entries.filter((F.col("cid") != F.col("p.cid")) & _may_link(F.col("p.n"), F.col("p.alone"), F.col("n"), F.col("alone"), percent))
    pairs = materialize(pairs.select(F.least("p.cid", "cid").alias("a"), F.greatest("p.cid", "cid").alias("b")).distinct(), "ngram-pairs")
    checked = _judge(pairs, sets, percent)
    facts = ["cid", "n", "alone", "p0", "p1", "p2", "p3"]
    while True:
        roots = connected_components(checked.filter("linked").select("a", "b"))
        nodes = sets.select(*facts).join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        placed = materialize(entries.select("token", "cid").join(nodes, "cid"), "ngram-placed")
        parts = placed.groupBy("token", "root").agg(F.count("*").alias("c"))
        mixed = parts.groupBy("token").agg(F.max(F.struct("c", "root")).alias("big"), F.count("*").alias("parts")).filter("parts > 1")
        open_ = placed.join(mixed.select("token", F.col("big.root").alias("big")), "token")
        x = open_.filter("root <> big").select("token", F.col("root").alias("rx"), *[F.col(c).alias(f"x_{c}") for c in facts]).withColumnRenamed("x_cid", "x")
        odd = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"x_p{i}"))) for i in range(4)), F.lit(0))
        pairs = open_.join(x, "token").filter((F.col("root") != F.col("rx")) & ((F.col("root") == F.col("big")) | (F.col("cid") < F.col("x")))
                                              & _may_link(F.col("n"), F.col("alone"), F.col("x_n"), F.col("x_alone"), percent)
                                              & ((odd + F.col("alone") + F.col("x_alone")) * (100 + percent)
                                                 <= (F.col("n") + F.col("x_n")) * (100 - percent)))
        pairs = pairs.select(F.least("cid", "x").alias("a"), F.greatest("cid", "x").alias("b")).distinct()
        more = _judge(materialize(pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti"), "ngram-pairs"), sets, percent)
        if more.filter("linked").isEmpty():
            return roots
        checked = checked.unionByName(more)


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, its own included).

    Words are runs of bytes other than ASCII white space, ``A-Z`` lower-cased.  A
    document's set is its distinct ``k``-word shingles; with fewer words, the
    whole sequence.  Documents link when 100 * common >= ``percent`` * union.  A
    null, empty or blank text has no set, links with nothing and is its own
    component; repeated rows are linked with each other; a null id does not
    name a component unless all its ids are null; other columns are ignored;
    an empty table gives none.
    """
    # a set is read again by the id and text hash of one of its rows; the struct is never null, so null ids match too
    row = F.struct(F.col(id_col).alias("i"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    source = docs.select(row.alias("id"), F.col(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = (lambda tokens: int(min(MAX_SHARDS, max(16, tokens // ENTRIES_PER_SHARD))))
    judged = materialize(documents_with_partners(source, percent, k, shards(size // 20)), "ngram-judged")
    classes = judged.filter("n > 0").groupBy("d1", "d2").agg(F.min("id.i").alias("least"))
    first = materialize(judged.filter("possible").groupBy("d1", "d2").agg(F.min("id").alias("id"), F.max("n").alias("n")), "ngram-first")
    rest = first.agg(F.count("*").alias("rows"), F.sum("n").alias("tokens")).first()
    ids = first.select("id").distinct()
    left = source.join(F.broadcast(ids) if rest["rows"] <= BROADCAST_IDS else ids, "id", "left_semi")
    sets = rare_prefixes(left, percent, k, shards(rest["tokens"] or 0))
    roots = link_components(sets, percent)
    placed = sets.select("cid", "d1", "d2").join(roots.withColumnRenamed("node", "cid"), "cid").select("d1", "d2", "root")
    placed = placed.groupBy("d1", "d2").agg(F.min("root").alias("root"))
    classes = classes.join(placed, ["d1", "d2"], "left")
    merged = classes.filter("root is not null")
    merged = merged.join(merged.groupBy("root").agg(F.min("least").alias("component")), "root").select("d1", "d2", "component")
    alone = classes.filter("root is null").select("d1", "d2", F.col("least").alias("component"))
    out = judged.join(merged.unionByName(alone), ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id.i"))
    return out.select(F.col("id.i").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """One document of each group of linked documents, all columns kept: the one with the smallest id.

    Of several rows with that id the smallest text hash stays, of equal rows one.
    Documents without words all stay.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    names = own_columns(docs)
    found = ngram_components(docs.select(F.struct(F.col(id_col).alias("i"), digest.alias("h")).alias("row"), F.col(text_col).alias("text")),
                             "row", "text", percent, k)
    keep = found.filter(F.col("row") == F.col("component_id")).groupBy("row").agg(F.max("n_shingles").alias("n"))
    keep = keep.select(F.col("row.i").alias("__i"), F.col("row.h").alias("__h"), F.col("n").alias("__n"))
    rows = docs.select(*names, digest.alias("__digest"))
    rows = rows.join(keep, rows[id_col].eqNullSafe(F.col("__i")) & (F.col("__digest") == F.col("__h")))
    nth = F.row_number().over(Window.partitionBy("__i", "__h").orderBy(F.lit(0)))
    return rows.withColumn("__nth", nth).filter((F.col("__nth") == 1) | (F.col("__n") == 0)).select(*names)
