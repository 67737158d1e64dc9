"""Small helpers for operators that carry a table's own columns along."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def own_columns(df: DataFrame, replaced: Iterable[str] = ()) -> list[Column]:
    """The columns of ``df`` but those that outputs replace (names compare without case, as Spark does)."""
    gone = {c.lower() for c in replaced}
    return [column(c) for c in df.columns if c.lower() not in gone]


def schema_with(df: DataFrame, source: str, name: str, rest: str) -> T.StructType:
    """A schema of ``name``, typed as ``source`` of ``df`` down to the nullability of its parts, and ``rest`` (DDL)."""
    return T.StructType([T.StructField(name, df.schema[source].dataType), *T.StructType.fromDDL(rest).fields])
