"""Id ↔ string helpers.

A BPE *word* is held as a Spark string with one character per token id: byte
``b`` is code point ``b`` and merge id ``m`` is code point ``m`` (shifted past
the surrogate block).  Merging a pair is then the built-in ``replace``, whose
left-to-right, non-overlapping semantics are exactly those of a BPE merge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.constants import SURROGATE_SHIFT, SURROGATE_START


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latin1_word(c: Column | str) -> Column:
    """UTF-8 bytes of a string, one character per byte (code point = byte)."""
    return F.decode(F.encode(_col(c), "UTF-8"), "ISO-8859-1")


def code_units_to_ids(word: Column | str) -> Column:
    """Characters of a word string back to token ids (``array<int>``)."""
    w = _col(word)
    cps = F.transform(F.split(w, ""), lambda ch: F.ascii(ch))
    ids = F.transform(
        cps,
        lambda cp: F.when(cp >= SURROGATE_START + SURROGATE_SHIFT, cp - SURROGATE_SHIFT).otherwise(cp),
    )
    return F.when(F.length(w) == 0, F.array().cast("array<int>")).otherwise(ids)


def utf8_byte_ids(c: Column | str) -> Column:
    """UTF-8 bytes of a string as ``array<int>`` (0..255)."""
    return code_units_to_ids(latin1_word(c))


def char_id(ch: str) -> int:
    """The id that a character of a word string stands for."""
    cp = ord(ch)
    return cp - SURROGATE_SHIFT if cp >= SURROGATE_START + SURROGATE_SHIFT else cp


def id_char(token_id: int) -> str:
    """The character standing for ``token_id`` in a word string."""
    if token_id < 0:
        raise ValueError("token ids are non-negative")
    return chr(token_id + SURROGATE_SHIFT if token_id >= SURROGATE_START else token_id)


def ids_to_string(c: Column | str, sep: str = " ") -> Column:
    """``array<int>`` → ``'1 2 3'`` (a comparison-friendly rendering)."""
    return F.array_join(_col(c).cast("array<string>"), sep)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Catalyst inlines projected columns into lambdas, where a reference is
    re-evaluated per array element; binding through a one-element
    ``transform`` keeps the cost at one evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
