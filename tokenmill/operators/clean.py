"""Cleaning and projection operators (DataFrame → DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.constants import EOT
from tokenmill.functions.text import fingerprint, normalize_ws, rstrip_ws, strip_ws


def clean_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """null → '', strip Unicode whitespace, drop empty documents."""
    cleaned = df.withColumn(text_col, strip_ws(F.coalesce(F.col(text_col), F.lit(""))))
    return cleaned.filter(F.length(text_col) > 0)


def normalize_text(df: DataFrame, text_col: str = "text", out_col: str = "norm_text") -> DataFrame:
    """Add the dedupe normal form: stripped, whitespace runs collapsed to one space."""
    return df.withColumn(out_col, normalize_ws(F.col(text_col)))


def doc_fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fp") -> DataFrame:
    """Add the SHA-256 hex fingerprint of the normalised text."""
    return df.withColumn(out_col, fingerprint(F.col(text_col)))


def split_on_eot(
    df: DataFrame,
    text_col: str = "text",
    delimiter: str = EOT,
    *,
    keep_empty: bool = False,
    strip: bool = True,
    seg_col: str = "seg",
) -> DataFrame:
    """Split each text on a literal delimiter into one row per segment.

    Adds ``seg`` (0-based segment index) and ``followed_by_delim`` (a delimiter
    came after this segment in the source text).  Segments are stripped and
    empty ones dropped unless asked otherwise.
    """
    quoted = "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), quoted, -1)
    out = df.select(
        *[c for c in df.columns if c != text_col],
        F.posexplode(parts).alias(seg_col, text_col),
        F.size(parts).alias("_nparts"),
    )
    out = out.withColumn("followed_by_delim", F.col(seg_col) < F.col("_nparts") - 1).drop("_nparts")
    if strip:
        out = out.withColumn(text_col, strip_ws(F.col(text_col)))
    if not keep_empty:
        out = out.filter(F.length(text_col) > 0)
    return out


def strip_trailing_eot(df: DataFrame, ids_col: str, text_col: str, eot_id: int, out_col: str | None = None) -> DataFrame:
    """If ``ids`` ended on EOT, remove the trailing marker from the text and right-strip it."""
    out_col = out_col or text_col
    ends_eot = F.element_at(F.col(ids_col), -1) == F.lit(eot_id)
    tail = F.lit(EOT)
    trimmed = F.expr(f"substring({text_col}, 1, length({text_col}) - {len(EOT)})")
    rstripped = rstrip_ws(trimmed)
    cond = F.coalesce(ends_eot, F.lit(False)) & F.col(text_col).endswith(tail)
    return df.withColumn(out_col, F.when(cond, rstripped).otherwise(F.col(text_col)))
