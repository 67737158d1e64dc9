"""Pretokenization, word frequencies and pair statistics.

Everything stays in the JVM: the GPT-2 split is ``regexp_extract_all`` with a
java.util.regex pattern, bytes come from a Latin-1 re-decode, and pairs from
``transform``/``array_distinct``.  Aggregations are plain ``groupBy`` so Spark
combines map-side; a pretoken as common as " the" costs one row per
partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.ids import let, utf8_byte_ids
from tokenmill.functions.text import pretokens


def pretokenize(
    df: DataFrame, text_col: str = "text", keep_cols: Sequence[str] = ("doc_id",), mode: str = "jvm"
) -> DataFrame:
    """One row per pretoken: ``keep_cols..., pos, pretoken`` (pos 0-based).

    ``mode="python"`` uses the exact-Unicode ``regex`` UDF (see ``pretokens``).
    """
    return df.select(
        *[F.col(c) for c in keep_cols],
        F.posexplode(pretokens(F.col(text_col), mode)).alias("pos", "pretoken"),
    ).filter(F.length("pretoken") > 0)


def pretoken_bytes(df: DataFrame, col: str = "pretoken", out_col: str = "ids") -> DataFrame:
    """UTF-8 bytes of each pretoken as ``array<int>``; empty pretokens dropped."""
    return df.filter(F.octet_length(col) > 0).withColumn(out_col, utf8_byte_ids(F.col(col)))


_SHIFT = 10**19


def pretoken_counts(
    docs: DataFrame,
    text_col: str = "text",
    order_col: str = "doc_id",
) -> DataFrame:
    """Word frequency over all documents.

    ``pretoken, freq, first_doc, first_pos`` — ``(first_doc, first_pos)`` is the
    first occurrence in corpus order, the tie-break of BPE training.
    """
    toks = pretokenize(docs, text_col, keep_cols=(order_col,))
    # (doc, pos) packed as DECIMAL(38,0) = doc * 10^19 + pos: exact and
    # order-preserving for any bigint doc and 0 <= pos < 10^19, and a decimal
    # buffer is updated in place, so this is a HashAggregate (a struct min
    # would force a sort-based aggregate over every pretoken occurrence).
    key = F.col(order_col).cast("decimal(38,0)") * F.lit(str(_SHIFT)).cast("decimal(38,0)") + F.col("pos").cast("decimal(38,0)")
    agg = toks.groupBy("pretoken").agg(
        F.count(F.lit(1)).alias("freq"),
        F.min(key.cast("decimal(38,0)")).alias("_first"),
    )
    doc = F.floor(F.col("_first") / F.lit(str(_SHIFT)).cast("decimal(38,0)"))
    return agg.select(
        "pretoken",
        "freq",
        doc.cast("bigint").alias("first_doc"),
        (F.col("_first") - doc * F.lit(str(_SHIFT)).cast("decimal(38,0)")).cast("bigint").alias("first_pos"),
    )


def adjacent_pairs(ids: Column) -> Column:
    """Distinct adjacent pairs of an id array, in order of first occurrence.

    ``array<struct<a:int,b:int>>``; empty for fewer than two ids.
    """
    def pairs(v: Column) -> Column:
        return F.when(
            F.size(v) >= 2,
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.size(v) - 1),
                    lambda i: F.struct(F.element_at(v, i).alias("a"), F.element_at(v, i + 1).alias("b")),
                )
            ),
        ).otherwise(F.array().cast("array<struct<a:int,b:int>>"))

    return let(ids, pairs)


def pair_stats(words: DataFrame, ids_col: str = "ids", freq_col: str = "freq") -> DataFrame:
    """Frequency-weighted *presence* count per adjacent pair.

    A word containing a pair several times adds its frequency once.  Carries
    ``first`` = min(first_doc, first_pos, index of the pair in the word) for
    the deterministic tie-break.  ``words`` needs ``first_doc, first_pos``.
    """
    exploded = words.select(
        F.col(freq_col),
        F.col("first_doc"),
        F.col("first_pos"),
        F.posexplode(adjacent_pairs(F.col(ids_col))).alias("idx", "pair"),
    )
    # Tie-break (first_doc, first_pos, idx) as one DECIMAL(38,0):
    # doc * 10^19 + pos * 10^9 + idx.  Exact while pos < 10^10 and idx < 10^9;
    # beyond that the query fails instead of ordering wrongly.  A decimal
    # buffer keeps the aggregate hash-based.
    dec = "decimal(38,0)"
    guard = F.when(
        (F.col("first_pos") < F.lit(10**10)) & (F.col("idx") < F.lit(10**9)),
        F.col("first_doc").cast(dec) * F.lit(str(_SHIFT)).cast(dec)
        + F.col("first_pos").cast(dec) * F.lit(10**9).cast(dec)
        + F.col("idx").cast(dec),
    ).otherwise(F.raise_error(F.lit("pair_stats: position beyond the packed tie-break range")).cast(dec))
    return exploded.groupBy(F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).agg(
        F.sum(freq_col).alias("cnt"),
        F.min(guard).alias("first"),
    )


def top_pair(stats: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` best pairs: count desc, then first occurrence (a bounded top-k)."""
    ranked = stats.orderBy(F.col("cnt").desc(), F.col("first").asc()).limit(k)
    return ranked


def corpus_token_stats(docs: DataFrame, text_col: str = "text", ids_col: str | None = None) -> DataFrame:
    """Docs seen, bytes, pretokens (and token ids / max id when ``ids_col`` is given)."""
    aggs = [
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.octet_length(text_col)).cast("bigint").alias("bytes"),
        F.sum(F.size(pretokens(F.col(text_col)))).cast("bigint").alias("pretokens"),
    ]
    if ids_col:
        aggs += [
            F.sum(F.size(ids_col)).cast("bigint").alias("tokens"),
            F.max(F.array_max(ids_col)).cast("bigint").alias("max_id"),
        ]
    return docs.agg(*aggs)
