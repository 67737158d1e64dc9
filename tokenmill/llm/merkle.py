"""Merkle manifest of a dataset by a butterfly exchange.

Rows become leaves, the leaves of a part (say, of a language) a tree of fixed
fanout, the parts' roots a tree of their own.  Every leaf gets its proof: the
siblings on its way to the root.

1. leaves (digests, no texts) are range-partitioned by (part, id) and numbered
   inside their part from one count per range, so a part that holds most rows is
   numbered by many tasks;
2. ``fanout ** block_levels`` consecutive leaves of a part are a block: a complete
   subtree, folded in one task;
3. blocks trade subtree roots round by round.  In round r the ``fanout`` sibling
   subtrees of r levels form a group; the block at place o of one subtree hears
   from place o (modulo the subtree's size, at a ragged end) of each other one, and
   hashes their common ancestor.  So every block of a subtree hashes the same
   ancestors again, and after the last round, beyond the parts' roots, each knows
   the root and its own upper proof: nothing is passed down the tree;
4. each block folds its leaves again and joins the two halves of their proofs.

A round moves ``fanout`` short messages a block.  The driver sees two numbers, the
count of parts and the blocks of the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm.frames import column
from tokenmill.operators.ordered import global_rank, prefix_offsets
from tokenmill.session import materialize

FANOUT = 8
BLOCK_LEVELS = 4
MESSAGES_PER_ROW = 4096  # of one subtree root, so that no row holds a list as long as its sibling

PROOF = "array<struct<left: string, right: string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` for a null, else byte count, ``:`` and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(field.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Hex SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def fold_levels(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The leaves and the ``levels`` above them, or all up to a single node."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i:i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return out


def _block(table: pa.Table, fanout: int, block_levels: int) -> tuple[pa.Table, list[list[str]]]:
    """A block's rows in order and its levels; a part of a single block ends with its root."""
    table = table.take(pa.array(np.argsort(table.column("pos").to_numpy(), kind="stable")))
    alone = table.column("n_blocks")[0].as_py() == 1
    return table, fold_levels([d.hex() for d in table.column("leaf").to_pylist()], fanout, None if alone else block_levels)


def _place_leaves(leaves: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Leaves with their position and block, blocks numbered through all parts; and one row per part."""
    leaves = materialize(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    order = ["id", "leaf", "tie"]
    dealt = leaves.repartitionByRange("part", *order).withColumn("bucket", F.spark_partition_id())
    dealt = materialize(dealt, "merkle-ranges")
    before = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    pieces = dealt.groupBy("part", "bucket").agg(F.count("*").alias("n"))  # at most ranges + parts rows
    pieces = materialize(pieces.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "merkle-pieces")
    parts = pieces.groupBy("part").agg(F.expr(f"(sum(n) + {size - 1}) div {size}").alias("n_blocks"))
    parts = prefix_offsets(parts, ["part"], "n_blocks", "first_block")
    numbers = global_rank(parts, ["part"], "part_no").withColumnRenamed("part", "__part")
    parts = materialize(parts.join(numbers, F.col("part").eqNullSafe(F.col("__part"))).drop("__part"), "merkle-parts")
    pieces = pieces.join(parts.withColumnRenamed("part", "__part"), F.col("part").eqNullSafe(F.col("__part"))).select(
        "__part", F.col("bucket").alias("__bucket"), "base", "first_block", "n_blocks", "part_no")
    placed = dealt.join(pieces, F.col("part").eqNullSafe(F.col("__part")) & (F.col("bucket") == F.col("__bucket")))
    pos = F.col("base") + F.row_number().over(Window.partitionBy("bucket", "part_no").orderBy(*order)) - 1
    placed = placed.withColumn("pos", pos.cast("long")).select(
        "id", "part", "leaf", "claim", "pos", (F.col("first_block") + F.expr(f"pos div {size}")).alias("block"), "first_block", "n_blocks", "part_no")
    return materialize(placed, "merkle-placed"), parts


def _top_groups(parts: DataFrame, n_parts: int, fanout: int) -> DataFrame:
    """``part_no``, ``top``: for each round above the parts, the block ranges of the subtrees in the part's group."""
    out, width, rounds = parts.select("part_no"), 1, []
    while width < n_parts:
        child = F.expr(f"part_no div {width}")
        children = parts.groupBy(child.alias("q")).agg(F.min("first_block").alias("start"), F.sum("n_blocks").alias("size"))
        groups = children.groupBy(F.expr(f"q div {fanout}").alias("__group")).agg(
            F.array_sort(F.collect_list(F.struct((F.col("q") % fanout).cast("int").alias("c"), "start", "size"))).alias(f"r{len(rounds)}"))
        out = out.join(groups, F.expr(f"part_no div {width * fanout}") == F.col("__group")).drop("__group")
        rounds.append(f"r{len(rounds)}")
        width *= fanout
    kind = "array<array<struct<c: int, start: bigint, size: bigint>>>"
    return out.select(F.col("part_no").alias("__part_no"), (F.array(*rounds) if rounds else F.array()).cast(kind).alias("top"))


def _swap(nodes: DataFrame, ranges: Column, active: Column) -> DataFrame:
    """One round: subtree roots go to the sibling subtrees of the group, each block hashes the ancestor.

    ``ranges`` are the group's subtrees as (c, start, size) in blocks; a block that
    is not ``active`` keeps its digest and proof.
    """
    state = [c for c in nodes.columns if c != "block"]
    alone = F.array(F.struct(F.lit(0).alias("c"), F.col("block").alias("start"), F.lit(1).cast("long").alias("size")))
    sent = nodes.withColumn("__active", active).withColumn("__ranges", F.when(F.col("__active"), ranges).otherwise(alone))
    mine = F.filter("__ranges", lambda x: (F.col("block") >= x["start"]) & (F.col("block") < x["start"] + x["size"]))
    sent = sent.withColumn("__mine", F.get(mine, 0))
    state_of = F.struct(*state, F.col("__active"), F.col("__mine")["c"].alias("__c"))
    sent = sent.select("block", "digest", state_of.alias("__state"), "__mine", F.explode("__ranges").alias("__to"))
    own = F.col("__to")["c"] == F.col("__mine")["c"]
    first = F.when(own, F.col("block")).otherwise(F.col("__to")["start"] + F.col("block") - F.col("__mine")["start"])
    last = F.when(own, F.col("block")).otherwise(F.col("__to")["start"] + F.col("__to")["size"] - 1)
    step = F.col("__mine")["size"]
    sent = sent.select("digest", F.col("__mine")["c"].alias("c"), F.when(own, F.col("__state")).alias("__state"), step.alias("__step"),
                       first.alias("__first"), last.alias("__last")).filter("__first <= __last")
    sent = sent.withColumn("__first", F.explode(F.sequence("__first", "__last", F.col("__step") * MESSAGES_PER_ROW)))
    until = F.least("__last", F.col("__first") + F.col("__step") * (MESSAGES_PER_ROW - 1))
    sent = sent.withColumn("__target", F.explode(F.sequence("__first", until, "__step")))
    heard = sent.groupBy("__target").agg(F.first("__state", ignorenulls=True).alias("s"), F.array_sort(F.collect_list(F.struct("c", "digest"))).alias("got"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("got", lambda e: keep(e["c"], F.col("s.__c"))), lambda e: e["digest"]), "")

    level = F.struct(joined(lambda c, own_c: c < own_c).alias("left"), joined(lambda c, own_c: c > own_c).alias("right"))
    new = {"digest": F.when(F.col("s.__active"), F.sha2(joined(lambda c, own_c: F.lit(True)), 256)).otherwise(F.col("s.digest")),
           "proof": F.when(F.col("s.__active"), F.concat("s.proof", F.array(level))).otherwise(F.col("s.proof"))}
    return heard.select(F.col("__target").alias("block"), *[new.get(c, F.col(f"s.{c}")).alias(c) for c in state])


def butterfly(nodes: DataFrame, parts: DataFrame, fanout: int) -> DataFrame:
    """``block``, ``subroot``, ``root``, ``proof`` (above the block) from ``block``, ``digest``, ``first_block``, ``n_blocks``, ``part_no``."""
    largest, n_parts = parts.agg(F.max("n_blocks"), F.count("*")).first()
    groups = _top_groups(parts, n_parts, fanout)
    nodes = nodes.join(groups, F.col("part_no") == F.col("__part_no")).drop("__part_no", "part_no")
    nodes = nodes.withColumn("proof", F.array().cast(PROOF))
    width = 1
    while width < (largest or 0):  # inside the parts
        done = F.expr(f"(block - first_block) div {width * fanout} * {width * fanout}")
        rest = F.col("n_blocks") - done
        count = F.least(F.lit(fanout), F.ceil(rest / F.lit(width))).cast("int")
        places = F.transform(F.sequence(F.lit(0), count - 1), lambda c: F.struct(c.alias("c"), (c * width).cast("long").alias("at")))  # noqa: B023
        ranges = F.transform(places, lambda x: F.struct(x["c"].alias("c"), (F.col("first_block") + done + x["at"]).alias("start"),  # noqa: B023
                                                        F.least(F.lit(width).cast("long"), rest - x["at"]).alias("size")))  # noqa: B023
        nodes = materialize(_swap(nodes, ranges, F.col("n_blocks") > width), "merkle-round")
        width *= fanout
    nodes, width, at = nodes.withColumn("subroot", F.col("digest")), 1, 0
    while width < n_parts:  # between the parts
        nodes = materialize(_swap(nodes, F.get("top", at), F.lit(True)), "merkle-round")
        width, at = width * fanout, at + 1
    return nodes.select("block", "subroot", F.col("digest").alias("root"), "proof")


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
                    part_col: str = "lang", claim: Column | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest: ``id_col``, ``part_col``, ``position`` (in its part), ``leaf``, ``subroot``, ``root``, ``proof``, ``claim``.

    ``proof`` has one (left, right) pair a level, the siblings' hex digests joined on
    either side; ``fold(leaf, proof)`` gives the root.  ``claim`` is any hex digest of
    the row, carried along to be checked against the proof, the leaf's own by default.

    Leaves ascend by id, a null id first; rows of one id by their digest, so equal
    rows take neighbouring places and any order of them gives the same tree.  Parts
    ascend by code point, a null part first.  Null fields and empty texts differ.
    Further columns are left out; an empty table gives an empty manifest.
    """
    if fanout < 2 or block_levels < 1:
        raise ValueError("a tree needs a fanout of two or more, and blocks of a level or more")
    leaf = leaf_digest([column(c) for c in fields])
    leaves = docs.select(column(id_col).alias("id"), column(part_col).alias("part"), F.unhex(leaf).alias("leaf"),
                         F.unhex(leaf if claim is None else claim).alias("claim"))
    placed, parts = _place_leaves(leaves, fanout ** block_levels)
    root_of = T.StructType.fromDDL("block long, digest string, first_block long, n_blocks long, part_no long")

    def roots(table: pa.Table) -> pa.Table:
        table, levels = _block(table, fanout, block_levels)
        one = {c: table.column(c)[:1] for c in ("block", "first_block", "n_blocks", "part_no")}
        return pa.table({"block": one["block"], "digest": [levels[-1][0]], **{c: one[c] for c in ("first_block", "n_blocks", "part_no")}})

    narrow = placed.select("block", "pos", "leaf", "first_block", "n_blocks", "part_no")
    upper = butterfly(materialize(narrow.groupBy("block").applyInArrow(roots, root_of), "merkle-blocks"), parts, fanout)
    out = T.StructType([T.StructField(id_col, placed.schema["id"].dataType), T.StructField(part_col, placed.schema["part"].dataType),
                        *T.StructType.fromDDL(f"position long, leaf string, claim string, subroot string, root string, proof {PROOF}").fields])

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        table, levels = _block(table, fanout, block_levels)
        n, upper_proof = table.num_rows, above.column("proof")[0].as_py()
        left, right = [], []
        for i in range(n):
            for level in levels[:-1]:
                at = i // fanout * fanout
                left.append("".join(level[at:i]))
                right.append("".join(level[i + 1:at + fanout]))
                i //= fanout
            left += [x["left"] for x in upper_proof]
            right += [x["right"] for x in upper_proof]
        pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
        offsets = np.arange(n + 1, dtype=np.int32) * (len(levels) - 1 + len(upper_proof))
        columns = [table.column("id"), table.column("part"), table.column("pos"), pa.array(levels[0], pa.string()),
                   pa.array([d and d.hex() for d in table.column("claim").to_pylist()], pa.string()),
                   *[pa.array([above.column(c)[0].as_py()] * n, pa.string()) for c in ("subroot", "root")], pa.ListArray.from_arrays(offsets, pairs)]
        return pa.Table.from_arrays(columns, names=out.names)

    return placed.groupBy("block").cogroup(upper.groupBy("block")).applyInArrow(proofs, out)
