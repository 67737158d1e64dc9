"""Exact deduplication and ingest reports.

Survivor choice always uses an explicit order key, never arrival order: the
smallest key per fingerprint, and the row that has it.  Spark combines the keys
map-side, so a fingerprint shared by a third of all rows costs one row per
partition in the aggregate; the rows then meet their keys on (fingerprint, key),
which spreads such a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.constants import DOC_SUFFIX
from tokenmill.functions.text import fingerprint, strip_ws
from tokenmill.operators.clean import clean_documents


def dedupe_exact(
    df: DataFrame,
    order_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    fp_col: str = "fp",
) -> DataFrame:
    """Keep the first row (by ``order_cols``) of every normalised-text fingerprint.

    The kept text is the row's own (stripped) text, not the normal form.
    """
    keyed = df.withColumn(fp_col, fingerprint(F.col(text_col))).withColumn("_key", F.struct(*[F.col(c) for c in order_cols]))
    # keys only: the texts do not pass through the aggregate's buffers
    first = keyed.groupBy(fp_col).agg(F.min("_key").alias("_key"))
    same_key = Window.partitionBy(fp_col, "_key").orderBy(F.lit(0))  # copies with one key: any one of them
    kept = keyed.join(first, [fp_col, "_key"], "left_semi").withColumn("_nth", F.row_number().over(same_key))
    return kept.filter("_nth = 1").select(*df.columns, fp_col)


def dedupe_merged(
    sources: Sequence[tuple[DataFrame, Sequence[str]]],
    text_col: str = "text",
) -> DataFrame:
    """Union several sources and dedupe the result; earlier sources win.

    ``sources`` is a list of ``(df, order_cols)``; order columns must be
    integral.  The survivor order is ``(source_rank, k1, k2, ...)`` with keys
    padded by 0, so every source keeps its own input order.
    """
    width = max(len(cols) for _, cols in sources)
    parts = []
    for rank, (df, cols) in enumerate(sources):
        keys = [F.col(c).cast("bigint") for c in cols] + [F.lit(0).cast("bigint")] * (width - len(cols))
        parts.append(
            df.select(
                F.lit(rank).cast("bigint").alias("source_rank"),
                *[k.alias(f"k{i + 1}") for i, k in enumerate(keys)],
                F.col(text_col).alias("text"),
            )
        )
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    order = ["source_rank"] + [f"k{i + 1}" for i in range(width)]
    return dedupe_exact(clean_documents(merged, "text"), order, "text")


def dedupe_resume(
    existing: DataFrame,
    new: DataFrame,
    order_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    *,
    global_pass: bool = True,
) -> DataFrame:
    """Rows of an appended run to write.

    Within-run dedupe always applies.  With ``global_pass`` the batch is also
    anti-joined against fingerprints already present in ``existing`` (the
    global fix the reference leaves to a later clean pass).  The anti-join
    shuffles only fingerprints of the existing output, never its text.
    """
    batch = dedupe_exact(clean_documents(new, text_col), order_cols, text_col)
    if not global_pass:
        return batch
    seen = clean_documents(existing, text_col).select(fingerprint(F.col(text_col)).alias("fp")).distinct()
    return batch.join(seen, "fp", "left_anti")


def dedupe_report(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents read / unique kept / duplicates dropped (a dry run)."""
    fp = fingerprint(F.col(text_col))
    return df.select(fp.alias("_fp")).agg(
        F.count(F.lit(1)).alias("docs_read"),
        F.count_distinct("_fp").alias("unique_kept"),
    ).withColumn("duplicates_dropped", F.col("docs_read") - F.col("unique_kept"))


def ingest_report(
    df: DataFrame,
    order_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    *,
    dedupe: bool = True,
) -> DataFrame:
    """Counters of an export run over raw rows (one row).

    rows_read, non_empty, blank (null or whitespace only), duplicates (when
    deduping; the first row by ``order_cols`` survives) and output_bytes: the
    UTF-8 bytes written, each kept document followed by the corpus separator.
    """
    suffix_bytes = len(DOC_SUFFIX.encode("utf-8"))
    rows = df.select(
        *[F.col(c) for c in order_cols],
        strip_ws(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"),
    )
    # one pass: a row per fingerprint (null for blank rows), then one total
    blank = F.length("_t") == 0
    size = F.octet_length("_t") + suffix_bytes
    keyed = rows.select(*order_cols, F.when(~blank, fingerprint(F.col("_t"))).alias("_fp"), size.cast("bigint").alias("_b"))
    order = F.struct(*[F.col(c) for c in order_cols])
    groups = keyed.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(order.alias("k"), F.col("_b"))).alias("_first"), F.sum("_b").alias("_all"))
    real, n = F.col("_fp").isNotNull(), F.col("_n")
    kept = F.when(real, F.lit(1) if dedupe else n)
    written = F.when(real, F.col("_first._b") if dedupe else F.col("_all"))
    out = groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows_read"), F.coalesce(F.sum(F.when(real, n)), F.lit(0)).alias("non_empty"),
        F.coalesce(F.sum(F.when(~real, n)), F.lit(0)).alias("blank"), F.coalesce(F.sum(kept), F.lit(0)).alias("kept"),
        F.sum(written).alias("output_bytes"))
    return out.select(
        "rows_read",
        "non_empty",
        "blank",
        (F.col("non_empty") - F.col("kept")).alias("duplicates"),
        F.coalesce(F.col("output_bytes"), F.lit(0)).cast("bigint").alias("output_bytes"),
    )
