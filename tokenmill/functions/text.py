"""Text functions: strip, normalise, fingerprint, pretokenize, UTF-8 decode."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.constants import GPT2_PATTERN_JAVA, GPT2_PATTERN_PY, WS_CHARS, WS_STRIP


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    The characters are named: Spark's plain ``trim`` only removes U+0020, and a
    regex anchored at the end would be tried anew at every inner space, which
    takes quadratic time on a long run of them.
    """
    return F.btrim(_col(c), F.lit(WS_CHARS))


def rstrip_ws(c: Column | str) -> Column:
    """Python ``str.rstrip()``."""
    return F.rtrim(_col(c), F.lit(WS_CHARS))


def normalize_ws(c: Column | str) -> Column:
    """Collapse every whitespace run to one space, then trim the space at either end."""
    return F.trim(F.regexp_replace(_col(c), rf"{WS_STRIP}+", " "))


def fingerprint(c: Column | str) -> Column:
    """SHA-256 (hex) of the normalised UTF-8 text."""
    return F.sha2(normalize_ws(c), 256)


def pretokens(c: Column | str, mode: str = "jvm") -> Column:
    """GPT-2 pretokens of a text as ``array<string>``.

    ``mode="jvm"`` (default): java.util.regex, no UDF.  ``mode="python"``:
    the published pattern on the ``regex`` module in an Arrow pandas UDF, for
    exact parity where the JDK's Unicode tables differ from the module's (they
    agree on all test documents; the UDF is the slow path).
    """
    if mode == "jvm":
        return F.regexp_extract_all(_col(c), F.lit(GPT2_PATTERN_JAVA), F.lit(0))
    if mode == "python":
        return _regex_pretokens()(_col(c))
    raise ValueError(f"unknown pretokenizer mode: {mode!r}")


def _regex_pretokens():
    from pyspark.sql import types as T

    pattern = GPT2_PATTERN_PY

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(texts: pd.Series) -> pd.Series:
        import regex

        pat = regex.compile(pattern)
        return pd.Series([[p for p in pat.findall(t) if p] if t is not None else None for t in texts])

    return split


def utf8_decode(c: Column | str, errors: str = "replace") -> Column:
    """Decode a binary column as UTF-8 with Python's ``errors`` policies.

    ``replace`` maps each maximal invalid subsequence to U+FFFD (Spark's
    ``make_valid_utf8`` follows the same rule); ``strict`` raises on bad input;
    ``ignore`` drops the bytes that are not part of a well-formed sequence.
    """
    b = _col(c)
    if errors == "replace":
        return F.make_valid_utf8(b.cast("string"))
    if errors == "strict":
        return F.decode(b, "UTF-8")
    if errors == "ignore":
        as_text = b.cast("string")
        return F.when(F.is_valid_utf8(as_text), as_text).otherwise(_drop_invalid(b))
    raise ValueError(f"unknown errors policy: {errors!r}")


def _drop_invalid(b: Column) -> Column:
    """Invalid input under ``ignore``: keep only well-formed sequences.

    Work on the hex string: keep only well-formed UTF-8 sequences (the regex
    below is the UTF-8 grammar), drop everything else, then decode.
    """
    valid_seq = (
        "[0-7][0-9A-F]"
        "|C[2-9A-F][89AB][0-9A-F]|D[0-9A-F][89AB][0-9A-F]"
        "|E0[AB][0-9A-F][89AB][0-9A-F]"
        "|E[1-9ABCEF][89AB][0-9A-F][89AB][0-9A-F]"
        "|ED[89][0-9A-F][89AB][0-9A-F]"
        "|F0[9AB][0-9A-F][89AB][0-9A-F][89AB][0-9A-F]"
        "|F[123][89AB][0-9A-F][89AB][0-9A-F][89AB][0-9A-F]"
        "|F4[8][0-9A-F][89AB][0-9A-F][89AB][0-9A-F]"
    )
    pairs = F.regexp_extract_all(F.hex(b), F.lit(f"(?:{valid_seq})|(?:..)"), F.lit(0))
    kept = F.filter(pairs, lambda p: p.rlike(f"^(?:{valid_seq})$"))
    return F.decode(F.unhex(F.array_join(kept, "")), "UTF-8")
