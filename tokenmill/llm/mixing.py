"""Mixing sources to target weights by subset-sum budget fitting.

The target words of a source are its weight's share of all words, at most
``max_repeats`` times what it has; what lies above is shared again by weight.  A
source is taken whole as often as its target allows.  For the budget that
remains, its documents are counted by exact length; the plan takes the same
share of every length, the fractions of neighbouring lengths in turn from a seeded
place on, then closes the rest of the budget, a few documents, by a bounded
knapsack, so it usually fits to the word.  Which documents of a length are taken
follows from a seeded hash of the rows.

Only one total per source reaches the driver.  A source's plan sees one row per
length.  Documents are ranked inside (source, length, salt), so a source or a
group of copies that fills a third of the table is ranked in many tasks.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.frames import column, own_columns
from tokenmill.session import materialize

SALTS = 256
EXACT_BUDGET = 1 << 16
BROADCAST_SOURCES = 100_000


def count_words(text: Column) -> Column:
    """Number of runs of bytes other than ASCII white space; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fair_targets(sizes: list[int], weights: list[float], max_repeats: int) -> list[float]:
    """Shares of the total by weight, each at most ``max_repeats`` sizes, the excess shared again."""
    left, free, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        heavy = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / heavy >= max_repeats * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / heavy
            break
        for i in over:
            out[i] = float(max_repeats * sizes[i])
        left = max(0.0, left - sum(out[i] for i in over))
        free -= over
    return out


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, exact: int = EXACT_BUDGET, seed: int = 0) -> np.ndarray:
    """How many documents of each length to take, so that their words come nearest to ``budget``.

    ``lengths`` ascend.  All lengths give the same share of their documents: whole
    ones, and of the fractions one document whenever their running sum, begun at a
    seeded place, passes a whole number, so neighbouring lengths take turns.  That
    misses the budget by at most twice the longest document; lengths in a seeded
    order close the rest by the knapsack.  If no sum of documents left fits, the
    knapsack begins with the whole parts alone.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    rng = np.random.default_rng(seed)
    whole = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    passed = np.floor(np.cumsum(counts * (budget / total) - whole) + rng.random()).astype(np.int64)
    extra = np.diff(passed, prepend=0)
    extra = np.clip(extra, 0, np.minimum(1, counts - whole))
    over = int((lengths * (whole + extra)).sum()) - budget
    order = rng.permutation(len(lengths))
    if over > 0:  # documents whose words come nearest to what is too much go back, as below they are added
        gone = _fill(lengths, extra, np.zeros_like(extra), over, exact, order)
        extra, over = extra - gone, over - int((lengths * gone).sum())
    while over > 0:  # take back the shortest document that is enough, else any
        taken = np.flatnonzero(extra)
        enough = taken[lengths[taken] >= over]
        i = enough[0] if len(enough) else taken[rng.integers(len(taken))]
        extra[i] = 0
        over -= int(lengths[i])
    best, back = None, 1
    while True:
        take = _fill(lengths, counts, whole + extra, budget, exact, order)
        miss = abs(int((lengths * take).sum()) - budget)
        if best is None or miss < best[0]:
            best = (miss, take)
        taken = np.flatnonzero(extra)
        if not miss or not len(taken):
            return best[1]
        extra[rng.choice(taken, min(back, len(taken)), replace=False)] = 0  # more room for the knapsack
        back *= 2


def _fill(lengths: np.ndarray, counts: np.ndarray, base: np.ndarray, budget: int, exact: int, order: np.ndarray) -> np.ndarray:
    """``base`` and the documents beyond it whose words come nearest to what is left of the budget."""
    take = base.copy()
    left = budget - int((lengths * take).sum())
    for i in range(len(lengths) - 1, -1, -1):  # a rest of more than a few documents: whole ones, longest first
        if left <= exact:
            break
        more = min(int(counts[i] - take[i]), -(-(left - exact) // int(lengths[i])), left // int(lengths[i]))
        take[i] += more
        left -= more * int(lengths[i])
    if left <= 0 or not (counts > take).any():
        return take
    mask, reached, steps = (1 << 2 * left) - 1, 1, []  # a sum twice as large is no nearer than none
    for i in order:
        spare, pack = min(int(counts[i] - take[i]), (2 * left - 1) // int(lengths[i])), 1
        while spare > 0 and not reached >> left & 1:
            n = min(pack, spare)
            steps.append((i, n, reached))
            reached |= reached << (n * int(lengths[i])) & mask
            spare, pack = spare - n, pack * 2
    below, above = (reached & (1 << (left + 1)) - 1).bit_length() - 1, reached >> left + 1
    goal = below  # the sum that comes nearest, of two the smaller
    if above and (above & -above).bit_length() < left - below:
        goal = left + (above & -above).bit_length()
    for i, n, before in reversed(steps):
        if not before >> goal & 1:
            take[i] += n
            goal -= n * int(lengths[i])
    return take


def _plan(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    return pdf.assign(take=fit_budget(lengths, counts, int(pdf["budget"].iloc[0]), EXACT_BUDGET, seed + 1_000_003 * int(pdf["no"].iloc[0])))


def _row_hash(docs: DataFrame, seed: int) -> Column:
    """A hash of all columns that can be hashed; rows that differ there differ in it."""
    return F.xxhash64(*[column(f.name) for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())], F.lit(seed))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", seed: int = 23) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken`` (size times copies).

    Sources in code point order, null last, weigh ``weights`` in turn.  Reruns
    agree on any layout: rows are chosen by a seeded hash of id, text and source, then
    of all columns, so rows of one id, or of none, are told apart, and only rows
    that agree in every column are interchangeable.  Null and empty texts have no words
    and 0 copies; a source without words has the target 0; repeated rows are
    counted one by one; input columns named like an output are replaced; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = own_columns(docs, ("size", "source_size", "target", "copies", "taken"))
    lot = F.xxhash64(column(id_col), column(text_col), column(source_col), F.lit(seed))
    salt = F.pmod(F.shiftright(lot, 20), F.lit(SALTS)).cast("int")
    sizes = docs.select(F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size"), salt.alias("salt"))
    # one row per source, length and salt: all that the plan needs to know of the documents
    groups = materialize(sizes.groupBy("source", "size", "salt").agg(F.count("*").alias("n")), "mix-lengths")
    totals = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()
    totals = sorted(totals, key=lambda r: (r.source is None, r.source or ""))
    targets = fair_targets([r.words for r in totals], [weights[i % len(weights)] for i in range(len(totals))], max_repeats)
    rows = []
    for i, (r, target) in enumerate(zip(totals, targets, strict=True)):
        whole = min(max_repeats, int(target // r.words)) if r.words else 0
        budget = 0 if whole == max_repeats or not r.words else max(0, round(target) - whole * r.words)
        rows.append((i, r.source, r.words, target, whole, budget))
    sources = spark.createDataFrame(rows, "no int, from_source string, source_size long, target double, whole int, budget long")
    if len(rows) <= BROADCAST_SOURCES:  # one short row per source
        sources = F.broadcast(sources)
    groups = groups.join(sources, groups["source"].eqNullSafe(F.col("from_source"))).drop("source", "from_source")
    plan = (groups.filter("size > 0").groupBy("no", "budget", "size").agg(F.sum("n").alias("n"))
            .groupBy("no").applyInPandas(lambda pdf: _plan(pdf, seed), "no int, budget long, size long, n long, take long").select("no", "size", "take"))
    before = Window.partitionBy("no", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    quota = (groups.join(plan, ["no", "size"])
             .withColumn("quota", F.greatest(F.lit(0), F.least("n", F.col("take") - F.coalesce(F.sum("n").over(before), F.lit(0)))))
             .select("no", "size", "salt", "quota"))
    quota = materialize(quota, "mix-quota")
    own = {c: f"__mix_{c}" for c in ("no", "size", "salt", "quota", "from_source", "source_size", "target", "whole", "budget")}
    out = docs.select(*kept, F.col(source_col).alias("__mix_source"), count_words(F.col(text_col)).alias(own["size"]), lot.alias("__mix_lot"),
                      _row_hash(docs, seed + 1).alias("__mix_tie"), F.col(id_col).alias("__mix_id"), salt.alias(own["salt"]))
    out = out.join(sources.withColumnsRenamed(own), F.col("__mix_source").eqNullSafe(F.col("__mix_from_source")))
    group = [own[c] for c in ("no", "size", "salt")]
    out = out.join(quota.withColumnsRenamed(own), group, "left")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("__mix_lot", "__mix_id", "__mix_tie"))
    copies = F.when(F.col("__mix_size") == 0, F.lit(0)).otherwise(
        F.col("__mix_whole") + (F.col("__mix_rank") <= F.coalesce("__mix_quota", F.lit(0))).cast("int"))
    return out.withColumn("__mix_rank", rank).select(
        *kept, F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"),
        copies.alias("copies"), (F.col("__mix_size") * copies).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source", seed: int = 23) -> DataFrame:
    """The mix itself: the documents' own columns, each row as often as it is taken."""
    rows = docs.select(F.struct(*own_columns(docs)).alias("__row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(source_col).alias("source"))
    out = mix_sources(rows, weights, max_repeats, "id", "text", "source", seed).filter("copies > 0")
    return out.select("__row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("__row.*")
