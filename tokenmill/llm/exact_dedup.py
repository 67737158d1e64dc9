"""Exact deduplication with a heavy-hitter split.

Digests of the normalised texts (``A-Z`` lower-cased) go to a narrow table.  A
Misra-Gries summary per partition, ``counters`` entries each, finds every digest
that may fill more than ``2 / (counters + 1)`` of the rows.  Those, at most
``counters + 1``, are counted exactly and their winners are broadcast, so their
rows never meet in one task.  All other digests use an ordinary aggregation and
join, whose groups are then bounded by that share.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import column, own_columns, schema_with
from tokenmill.session import materialize


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            data, offsets = W.text_bytes(part.column(1))
            raw = memoryview(W.LOWER[data])
            out = [hashlib.sha256(raw[offsets[i]:offsets[i + 1]]).digest() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["id", "digest"])


def misra_gries(counts: pd.Series, add: pd.Series, counters: int) -> pd.Series:
    """Merge two summaries; keep ``counters`` entries by subtracting the next largest count from all."""
    merged = counts.add(add, fill_value=0) if len(counts) else add.astype("float64")
    if len(merged) > counters:
        cut = np.partition(merged.to_numpy(), len(merged) - counters - 1)[len(merged) - counters - 1]
        merged = merged[merged > cut] - cut
    return merged


def frequent_digests(keys: DataFrame, counters: int) -> DataFrame:
    """(digest): at most ``counters + 1`` candidates, all digests of more than 2n/(counters+1) rows among them."""
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen = pd.Series(dtype="float64"), 0
        for pdf in batches:
            seen += len(pdf)
            counts = misra_gries(counts, pdf["digest"].value_counts(), counters)
        yield pd.DataFrame({"digest": [*counts.index, None], "n": [*counts.astype("int64"), 0], "seen": [0] * len(counts) + [seen]})

    found = keys.select("digest").mapInPandas(summarise, "digest binary, n long, seen long")
    found = found.groupBy("digest").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    found = materialize(found, "dedup-candidates")
    rows = found.agg(F.sum("seen")).first()[0] or 0
    return found.filter(F.col("digest").isNotNull() & (F.col("n") * (counters + 1) > rows)).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 255) -> DataFrame:
    """One row per document: ``id_col``, ``digest`` (SHA-256), ``keep_id``, ``group_size``, ``kept``.

    Of equal texts the row with the largest id stays; a null text counts as
    empty and a null id never wins against another.  If the winning id is
    repeated with an equal text, each of those rows is marked as kept.  Extra
    columns are ignored; an empty table gives an empty result.
    """
    keys = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_digests, schema_with(docs, id_col, "id", "digest binary"))
    keys = materialize(keys, "dedup-digests")
    group = [F.max("id").alias("keep_id"), F.count("*").alias("group_size")]
    hot = F.broadcast(frequent_digests(keys, counters))  # counters + 1 digests at most
    winners = materialize(keys.join(hot, "digest").groupBy("digest").agg(*group), "dedup-winners")
    winners = F.broadcast(winners)
    rest = keys.join(winners.select("digest"), "digest", "left_anti")
    done = rest.join(rest.groupBy("digest").agg(*group), "digest")
    return (keys.join(winners, "digest").unionByName(done)
            .select(F.col("id").alias(id_col), "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 255) -> DataFrame:
    """The documents that stay, all columns: of equal texts one row, that with the largest id.

    A null id stays where its group has no other.  If the winning id is repeated with an
    equal text, the row with the smallest hash of all its columns stays.
    """
    text = F.translate(F.coalesce(column(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    stay = exact_groups(docs, id_col, text_col, counters).filter("kept").groupBy("digest").agg(
        F.struct(F.max(column(id_col)).alias("id")).alias("id"), F.count("*").alias("n"))  # a struct joins nulls, too
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), F.struct(column(id_col).alias("id")).alias("id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))
    found = materialize(rows.join(stay, ["digest", "id"]), "dedup-stay")
    tied = found.filter("n > 1").groupBy("digest").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return found.filter("n = 1").select("row").unionByName(tied.select("row")).select("row.*")
