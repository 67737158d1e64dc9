"""Range search as a Column expression: which of many sorted ranges holds a key."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _literal(values: Sequence) -> Column:
    """An array constant; parsed once, when the plan is optimised."""
    kind = "string" if isinstance(values[0], str) else "bigint"
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def with_range(df: DataFrame, key: Sequence[Column], bounds: Sequence[tuple], out: str) -> DataFrame:
    """Add ``out``: how many of the sorted ``bounds`` are not above the row's key.

    A binary search as one expression, so a row costs the logarithm of the
    number of bounds and nothing is joined or shuffled.  The key is evaluated
    once.  The bounds travel in the plan; callers keep their number bounded.
    """
    if not bounds:
        return df.withColumn(out, F.lit(0))
    columns = [_literal(c) for c in zip(*bounds, strict=True)]
    steps = F.lit([1 << level for level in reversed(range(len(bounds).bit_length()))])
    names = [f"k{i}" for i in range(len(key))]

    def search(k: Column) -> Column:
        def halve(found: Column, step: Column) -> Column:
            at = found + step
            reached = F.lit(True)  # key >= bound, lexicographically, from the last part to the first
            for name, column in reversed(list(zip(names, columns, strict=True))):
                bound = F.get(column, at - 1)
                reached = (k[name] > bound) | ((k[name] == bound) & reached)
            return F.when((at <= len(bounds)) & reached, at).otherwise(found)
        return F.aggregate(steps, F.lit(0), halve)

    held = F.array(F.struct(*[c.alias(n) for c, n in zip(key, names, strict=True)]))
    return df.withColumn(out, F.get(F.transform(held, search), 0))


def among(df: DataFrame, key: Sequence[Column], chosen: Sequence[tuple], out: str) -> DataFrame:
    """Add ``out``: whether the row's key is one of the sorted ``chosen`` keys (their number must be bounded)."""
    if not chosen:
        return df.withColumn(out, F.lit(False))
    found = with_range(df, key, chosen, out)
    same = F.lit(True)
    for part, values in zip(key, zip(*chosen, strict=True), strict=True):
        same = same & part.eqNullSafe(F.get(_literal(values), F.col(out) - 1))
    return found.withColumn(out, same)
