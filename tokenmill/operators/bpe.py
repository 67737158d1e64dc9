"""Byte-level BPE training as an iterative Spark job with incremental pair counts.

Words are distinct pretokens held as strings with one character per token id
(see ``tokenmill.functions.ids``).  A merge is ``replace(w, ab, X)``, whose
left-to-right non-overlapping semantics are those of a BPE merge.

All pairs are counted once.  The driver keeps the *head*: every pair counted above
a floor, at most ``2 * fetch_k`` of them, with its exact count and first word.  Merging
changes the counts of few pairs, so a round is one job that

1. picks the words that hold a pair of the batch (a scan of the word column, no
   shuffle), merges them and lists the pairs each one lost and gained;
2. sums these changes by pair and returns those of the head's pairs and of new
   pairs above the floor.

Counts of old pairs only fall, so no other pair can enter the head.  When the head
runs dry, one count over all words fetches the next one: a few times in thousands of
merges.  Words are written anew once ``PENDING_MERGES`` merges are pending.

A round applies a *batch* of merges that equals what one-at-a-time training would
pick.  Two pairs conflict if one begins with the token that the other ends with; a
self-pair conflicts with all.  Let ``s`` be the largest count at which a pair conflicts
with one of the same or a larger count (the floor, when the head has no conflict):

* pairs counted above ``s`` never overlap inside a word, so merging one leaves the
  others' counts unchanged; every new pair contains an old pair that conflicts with
  the batch, so its count is at most ``s``.  All of them are merged, by rank;
* if none is above, the pairs counted ``s`` are walked in the order of their first
  places up to the first conflict.  A new pair that is counted ``s`` too contains a
  conflicting pair of that count, so its first word is not before the first
  conflict's; the head and all pairs whose first word is before that one are merged.

Ranking contract: count desc, then the pair's first occurrence in corpus order
(first word by ``(first_doc, first_pos)``, then position inside that word).  A
pair's first word stays known until a word that lost the pair is that word; it is
then looked up again, and only if the pair ties with another.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import BYTE_VOCAB, EOT, MIN_TRAIN_VOCAB
from tokenmill.functions.ids import char_id, id_char, latin1_word
from tokenmill.session import default_parallelism, delete_scratch, materialize, path_exists, scratch_path

MERGES_PER_ROUND = 256
PENDING_MERGES = 32
HEAD_PAIRS = 2048
LOOKED_UP = 64  # pairs whose first words one plan looks for


@dataclass
class BpeModel:
    """Trained (or loaded) tokenizer: the merge list in rank order."""

    merges: list[tuple[int, int]]
    vocab_size: int
    eot_id: int
    rounds: int = 0
    id_bytes: dict[int, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.id_bytes:
            table = {i: bytes([i]) for i in range(BYTE_VOCAB)}
            for r, (a, b) in enumerate(self.merges):
                table[BYTE_VOCAB + r] = table[a] + table[b]
            table[self.eot_id] = EOT.encode("utf-8")
            self.id_bytes = table

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, BYTE_VOCAB + r) for r, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, a int, b int, new_id int")

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.id_bytes.items())
        return spark.createDataFrame(rows, "token_id int, bytes binary")


def merge_word(word: Column, a: int, b: int, new_id: int) -> Column:
    """Replace each left-to-right non-overlapping ``(a, b)`` of a word string by ``new_id``."""
    return F.replace(word, F.lit(id_char(a) + id_char(b)), F.lit(id_char(new_id)))


def merge_words(word: Column, merges: list[tuple[int, int, int]]) -> Column:
    """Several merges, one after the other, as one expression.

    The merges are data, an array constant, so that rounds with other merges run
    code that is compiled already.
    """
    rows = [{"pair": id_char(a) + id_char(b), "id": id_char(new_id)} for a, b, new_id in merges]
    constant = F.from_json(F.lit(json.dumps(rows)), "array<struct<pair: string, id: string>>")
    return F.aggregate(constant, word, lambda w, m: F.replace(w, m["pair"], m["id"]))


def word_table(word_freq: DataFrame) -> DataFrame:
    """``w, freq, first`` from ``pretoken, freq, first_doc, first_pos``; inert words dropped."""
    return word_freq.select(
        latin1_word(F.col("pretoken")).alias("w"),
        F.col("freq").cast("bigint").alias("freq"),
        F.struct(F.col("first_doc").alias("d"), F.col("first_pos").cast("bigint").alias("p")).alias("first"),
    ).filter(F.length("w") >= 2)


def ranked_word_table(word_freq: DataFrame) -> tuple[DataFrame, int | None]:
    """Word table with ``first`` packed into one long when bounds allow.

    The tie-break key of a pair is (word's first occurrence, index in word).
    From measured bounds, ``first`` becomes a single order-preserving long:
    ``(doc - min_doc) << (pb + ib) | pos << ib`` when the widths fit in 62
    bits (no extra pass), else a dense first-seen rank ``<< ib`` (one
    distributed ranking), else the struct is kept.  A pair's key is then
    ``first | index``, so the per-round aggregate needs no struct buffer.
    Returns ``(table, ib)``; ``ib`` is None for the struct form.
    """
    from tokenmill.operators.ordered import global_rank

    # One pass over the (possibly expensive) upstream plan; everything below
    # reads this written copy of the distinct words.  A table written in fewer
    # files than there are cores is small, and spread so every round uses all.
    spark = word_freq.sparkSession
    table, path = _written(word_table(word_freq), "bpe-words0")
    parallelism = default_parallelism(spark)
    if len(table.inputFiles()) < parallelism:
        table, _ = _written(table.repartition(parallelism, "w"), "bpe-words0")
        delete_scratch(spark, path)
    st = table.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.length("w")).alias("m"),
        F.min("first.d").alias("d0"),
        F.max("first.d").alias("d1"),
        F.max("first.p").alias("p1"),
    ).collect()[0]
    n = int(st["n"])
    if n == 0:
        return table, None
    ib = max(1, int(st["m"]).bit_length())
    pb = max(1, int(st["p1"]).bit_length())
    db = max(1, (int(st["d1"]) - int(st["d0"])).bit_length())
    if db + pb + ib <= 62:
        key = F.shiftleft(F.col("first.d") - F.lit(int(st["d0"])), pb + ib).bitwiseOR(F.shiftleft(F.col("first.p"), ib))
        return table.select("w", "freq", key.cast("bigint").alias("first")), ib
    if n.bit_length() + ib > 62:
        return table, None
    keyed = table.select("w", "freq", F.col("first.d").alias("_d"), F.col("first.p").alias("_p"))
    # words are distinct, so no key repeats even where first places do
    ranks = global_rank(keyed, ["_d", "_p", "w"], "_r")
    packed = keyed.join(ranks, ["_d", "_p", "w"]).select(
        "w", "freq", F.shiftleft(F.col("_r"), ib).cast("bigint").alias("first")
    )
    return materialize(packed, "bpe-words0"), ib


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df``, written to a scratch table, and that table's path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _digest(word_freq: DataFrame) -> str:
    """What a training state belongs to: the words, their counts and places."""
    row = F.xxhash64(*[F.col(c) for c in ("pretoken", "freq", "first_doc", "first_pos")])
    r = word_freq.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    return ":".join(map(str, r))


def word_pair_stats(words: DataFrame, packed: bool = False) -> DataFrame:
    """Presence-weighted pair counts of word strings: ``pair, cnt, first``.

    With ``packed`` words, ``first`` is a long (word rank | index in word) and
    the aggregate needs no struct buffer.
    """
    # a row per place; a pair counts where it stands first in its word
    exploded = words.filter(F.length("w") >= 2).withColumn("idx", F.explode(F.sequence(F.lit(1), F.length("w") - 1)))
    exploded = exploded.withColumn("pair", F.substring("w", F.col("idx"), F.lit(2))).filter(F.instr("w", F.col("pair")) == F.col("idx"))
    if packed:
        key = F.col("first").bitwiseOR(F.col("idx").cast("bigint"))
    else:
        key = F.struct(F.col("first.d").alias("d"), F.col("first.p").alias("p"), F.col("idx").alias("i"))
    return exploded.groupBy("pair").agg(F.sum("freq").alias("cnt"), F.min(key).alias("first"))


def choose_batch(ranked: list[tuple[int, int, int]], fetched_all: bool, room: int) -> list[tuple[int, int, int]]:
    """Exact batch of merges from a ranked ``(a, b, cnt)`` list (see module doc)."""
    if not ranked or room <= 0:
        return []
    head = ranked[0]
    if head[0] == head[1] or room == 1:
        return [head]
    batch, lefts, rights = [head], {head[0]}, {head[1]}
    bound = None
    for a, b, cnt in ranked[1:]:
        if a == b or a in rights or b in lefts:
            bound = cnt
            break
        batch.append((a, b, cnt))
        lefts.add(a)
        rights.add(b)
    if bound is None:
        bound = 0 if fetched_all else ranked[-1][2]
    kept = [head] + [p for p in batch[1:] if p[2] > bound]
    return kept[:room]


def conflict_count(ranked: list[tuple[int, int, int]]) -> int | None:
    """Largest count at which a pair of a list by count conflicts with one of the same or a larger count."""
    lefts, rights = set(), set()
    for count, group in groupby(ranked, key=lambda p: p[2]):
        for a, b, _ in group:
            if a == b or a in rights or b in lefts:
                return count
            lefts.add(a)
            rights.add(b)
    return None


def tied_batch(tied: list[tuple[int, int, object]], complete: bool, room: int) -> list[tuple[int, int]]:
    """Exact batch from pairs ``(a, b, first word)`` of one count, in the order of their first places."""
    lefts, rights, end = set(), set(), None
    for at, (a, b, word) in enumerate(tied):
        if a == b or a in rights or b in lefts:
            end = (at, word)
            break
        lefts.add(a)
        rights.add(b)
    if end is None:
        end = (len(tied), None) if complete else (len(tied) - 1, tied[-1][2])
    kept = [p for p in tied[:end[0]] if end[1] is None or p[2] < end[1]]
    return [(a, b) for a, b, _ in (kept or tied[:1])[:room]]


def validate_sizes(vocab_size: int, eot_id: int) -> None:
    if eot_id != vocab_size - 1:
        raise ValueError(f"the marker's id is the last of the vocabulary, {vocab_size - 1}, not {eot_id}")
    if vocab_size < MIN_TRAIN_VOCAB:
        raise ValueError(f"a vocabulary of {vocab_size} has no room for a merge; the smallest is {MIN_TRAIN_VOCAB}")


class PairHead:
    """The words, the merges not yet written into them, and the most frequent pairs."""

    def __init__(self, words: DataFrame, bits: int, fetch_k: int, kept: bool = False):
        self.spark, self.words, self.bits, self.fetch_k = words.sparkSession, words, bits, fetch_k
        self.kept, self.path = kept, None  # kept: the caller writes the words, and no table is removed
        self.pending: list[tuple[int, int, int]] = []  # merges that the written words lack
        self.counts: dict[str, int] = {}  # all pairs counted above the floor
        self.first: dict[str, int | None] = {}  # their first words; None where to be looked up
        self.floor = 0
        self.tied: list[tuple[int, int, int]] = []  # if the pairs fetched have one count: in order, there may be more
        self.recounts = 0

    def current(self) -> DataFrame:
        """The words with all merges; exploding keeps the optimiser from repeating the expression."""
        merged = F.explode(F.array(merge_words(F.col("w"), self.pending)))
        return self.words.select(merged.alias("w"), "freq", "first").filter(F.length("w") >= 2)

    def recount(self) -> None:
        """Fetch the head by a count over all words."""
        top = (word_pair_stats(self.current(), packed=True)
               .orderBy(F.col("cnt").desc(), F.col("first").asc()).limit(self.fetch_k).collect())
        self.floor = int(top[-1]["cnt"]) if len(top) == self.fetch_k else 0
        self.counts = {r["pair"]: int(r["cnt"]) for r in top if r["cnt"] > self.floor}
        self.first = {r["pair"]: r["first"] >> self.bits for r in top if r["cnt"] > self.floor}
        self.tied = [] if self.counts else [(*_ids(r["pair"]), r["first"] >> self.bits) for r in top]
        self.recounts += 1

    def next_batch(self, room: int) -> list[tuple[int, int]]:
        """The next merges (see module doc), at most ``room``; none when no pair is left."""
        if not self.counts:
            self.recount()
        if self.tied:
            return tied_batch(self.tied, False, room)
        ranked = [(*_ids(p), c) for p, c in sorted(self.counts.items(), key=lambda x: -x[1])]
        if not ranked:
            return []
        bound = conflict_count(ranked)
        above = [p for p in ranked if p[2] > (self.floor if bound is None else bound)]
        if above:
            last = above[:room][-1][2]
            ordered = self._ordered([p for p in above if p[2] >= last])
            return self.next_batch(room) if ordered is None else [(a, b) for a, b, _ in ordered[:room]]
        ordered = self._ordered([p for p in ranked if p[2] == bound])
        return self.next_batch(room) if ordered is None else tied_batch(ordered, True, room)

    def _ordered(self, pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
        """(a, b, first word) by count and first place; None after a recount, which knows all first words."""
        groups = [[id_char(a) + id_char(b) for a, b, _ in g] for _, g in groupby(pairs, key=lambda p: p[2])]
        lost = [p for g in groups if len(g) > 1 for p in g if self.first[p] is None]
        if len(lost) > LOOKED_UP:
            self.recount()
            return None
        if lost:
            hit = self.current().filter(_any_of("w", lost))
            found = hit.select("first", F.explode(F.filter(F.array(*map(F.lit, lost)), lambda p: F.instr(F.col("w"), p) > 0)).alias("pair"))
            for r in found.groupBy("pair").agg(F.min("first").alias("first")).collect():
                self.first[r["pair"]] = r["first"] >> self.bits
        shared = {}
        for g in groups:
            for word, own in groupby(sorted(g, key=lambda p: self.first[p]) if len(g) > 1 else [], key=lambda p: self.first[p]):
                if len(list(own)) > 1:
                    shared[word] = ""
        if shared:
            places = ", ".join(str(word << self.bits) for word in shared)
            for r in self.current().filter(f"first IN ({places})").collect():
                shared[r["first"] >> self.bits] += r["w"] + "\0\0"  # words that share a first place, one after the other
        out = []
        for g in groups:
            by_place = sorted(g, key=lambda p: (self.first[p], shared[self.first[p]].find(p) if self.first[p] in shared else 0)) if len(g) > 1 else g
            out += [(*_ids(p), self.first[p]) for p in by_place]
        return out

    def merge(self, batch: list[tuple[int, int]], first_id: int) -> None:
        """Apply a batch and the changes it makes to the head."""
        merges = [(a, b, first_id + k) for k, (a, b) in enumerate(batch)]
        states = F.transform(F.array(merge_words(F.col("w"), self.pending)), lambda w: F.struct(w.alias("old"), merge_words(w, merges).alias("new")))
        touched = self.words.select("freq", "first", F.explode(states).alias("x")).select("freq", "first", "x.old", "x.new").filter("new <> old")
        # places of the old word count down from -1, of the new one up from 1
        rows = touched.withColumn("i", F.explode(F.sequence(1 - F.length("old"), F.length("new") - 1))).filter("i <> 0")
        rows = rows.withColumn("pair", F.when(F.col("i") > 0, F.substring("new", F.col("i"), F.lit(2))).otherwise(F.substring("old", -F.col("i"), F.lit(2))))
        rows = rows.filter(F.when(F.col("i") > 0, (F.instr("new", F.col("pair")) == F.col("i")) & (F.instr("old", F.col("pair")) == 0))
                           .otherwise((F.instr("old", F.col("pair")) == -F.col("i")) & (F.instr("new", F.col("pair")) == 0)))
        rows = rows.groupBy("pair").agg(F.sum(F.signum("i").cast("long") * F.col("freq")).alias("delta"), F.min("first").alias("first"))
        lefts, rights = {id_char(a) for a, _ in batch}, {id_char(b) for _, b in batch}
        merged = {id_char(a) + id_char(b) for a, b in batch}
        near = [p.encode().hex().upper() for p in self.counts if (p[1] in lefts or p[0] in rights) and p not in merged]
        known = F.array_contains(F.split(F.lit(",".join(near)), ","), F.hex("pair"))
        for r in rows.filter((F.col("delta") > F.lit(self.floor)) | known).collect():
            pair, word = r["pair"], r["first"] >> self.bits
            if r["delta"] > 0:
                self.counts[pair], self.first[pair] = int(r["delta"]), word
                continue
            self.counts[pair] += int(r["delta"])
            if self.first[pair] == word:
                self.first[pair] = None
        self.counts = {p: c for p, c in self.counts.items() if c > self.floor and p not in merged}
        if len(self.counts) > 2 * self.fetch_k:  # keep the head short: raise the floor
            self.floor = sorted(self.counts.values(), reverse=True)[self.fetch_k]
            self.counts = {p: c for p, c in self.counts.items() if c > self.floor}
        self.first = {p: self.first[p] for p in self.counts}
        self.tied = []
        self.pending += merges
        if len(self.pending) >= PENDING_MERGES and not self.kept:
            self.write()

    def write(self, path: str | None = None) -> None:
        """Write the words with all merges; tables that are read no more go."""
        before, self.path = self.path, path or scratch_path(self.spark, "bpe-words")
        self.current().write.mode("overwrite").parquet(self.path)
        self.words, self.pending = self.spark.read.schema(self.words.schema).parquet(self.path), []
        if before and not path:
            delete_scratch(self.spark, before)


def _ids(pair: str) -> tuple[int, int]:
    return char_id(pair[0]), char_id(pair[1])


def _any_of(word: str, pairs: list[str]) -> Column:
    out = F.lit(False)
    for pair in pairs:
        out = out | F.col(word).contains(pair)
    return out


def _latest_state(spark: SparkSession, state_dir: str, digest: str) -> tuple[int, list[tuple[int, int]], int, int] | None:
    """Last completed round under ``state_dir``: (round, merges, merges that the written words have, key bits)."""
    if not path_exists(spark, f"{state_dir}/input"):
        spark.createDataFrame([(digest,)], "digest string").coalesce(1).write.parquet(f"{state_dir}/input")
    begun = spark.read.parquet(f"{state_dir}/input").first()[0]
    if begun != digest:
        raise ValueError(f"the training state in {state_dir} belongs to other words")
    if not path_exists(spark, f"{state_dir}/rounds"):
        return None
    done = spark.read.parquet(f"{state_dir}/rounds")
    last = done.orderBy(F.col("round").desc()).first()
    merges = done.select(F.explode("merges").alias("m")).distinct().orderBy("m.rank").collect()
    return int(last["round"]), [(r["m"]["a"], r["m"]["b"]) for r in merges], int(last["written"]), int(last["bits"])


def _save_round(spark: SparkSession, state_dir: str, rnd: int, merges: list[tuple[int, int]], new: int, written: int, bits: int) -> None:
    """Record a round; the row, which comes last, marks completion."""
    own = [(r, *merges[r]) for r in range(len(merges) - new, len(merges))]
    row = spark.createDataFrame([(rnd, own, written, bits)], "round int, merges array<struct<rank: int, a: int, b: int>>, written int, bits int")
    row.coalesce(1).write.mode("append").parquet(f"{state_dir}/rounds")


def bpe_train(
    word_freq: DataFrame,
    vocab_size: int,
    eot_id: int | None = None,
    *,
    fetch_k: int = HEAD_PAIRS,
    state_dir: str | None = None,
) -> BpeModel:
    """Train merges on a word-frequency table (``pretoken_counts`` output).

    Stops early when no pair is left.  The words are written to the shared
    checkpoint folder whenever ``PENDING_MERGES`` merges wait to be applied, so
    lineage stays short and a failed task re-runs its part of one scan.

    With ``state_dir`` (a shared folder) the written words and every round's merges
    are kept there, and a new call with the same ``state_dir`` resumes from the last
    completed round — after a driver failure, or to continue to a larger
    vocabulary.  The state records which words it was made from, and a call with
    other words raises.  Scratch tables that no later round reads are removed.
    """
    spark = word_freq.sparkSession
    eot_id = vocab_size - 1 if eot_id is None else eot_id
    validate_sizes(vocab_size, eot_id)
    num_merges = eot_id - BYTE_VOCAB
    if state_dir:
        word_freq, _ = _written(word_freq, "bpe-input")  # read for the digest and for the words
    state = _latest_state(spark, state_dir, _digest(word_freq)) if state_dir else None
    if state is not None:
        rounds, merges, written, bits = state
        schema = "w string, freq long, first long"
        head = PairHead(spark.read.schema(schema).parquet(f"{state_dir}/words/merges={written}"), bits, fetch_k, True)
        head.pending = [(a, b, BYTE_VOCAB + r) for r, (a, b) in enumerate(merges) if r >= written]
    else:
        words, bits = ranked_word_table(word_freq)  # written once, spread over all cores
        rounds, merges, written = 0, [], 0
        if bits is None and not words.isEmpty():
            raise ValueError("too many words to rank their first places in 62 bits")
        head = PairHead(words, bits or 0, fetch_k, bool(state_dir))
        if bits is None:
            num_merges = 0  # no word has a pair
        if state_dir:
            head.write(f"{state_dir}/words/merges=0")
    while len(merges) < num_merges:
        batch = head.next_batch(min(MERGES_PER_ROUND, num_merges - len(merges)))
        if not batch:
            break
        head.merge(batch, BYTE_VOCAB + len(merges))
        merges += batch
        rounds += 1
        if state_dir:
            if len(head.pending) >= PENDING_MERGES:
                written = len(merges)
                head.write(f"{state_dir}/words/merges={written}")
            _save_round(spark, state_dir, rounds, merges, len(batch), written, head.bits)
    if head.path and not state_dir:
        delete_scratch(spark, head.path)
    return BpeModel(merges=merges[:num_merges], vocab_size=vocab_size, eot_id=eot_id, rounds=rounds)


def bpe_vocab(model: BpeModel, spark: SparkSession) -> DataFrame:
    """``token_id, bytes``: bytes, merges (concatenated children) and EOT."""
    return model.vocab_df(spark)
