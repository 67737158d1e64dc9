"""Exact token counts of every prefix, from counts of distinct words.

The tokenizer drops white space and never joins text across it, so the tokens of
a text are those of its words (runs of bytes other than ASCII white space), each
encoded by itself by the library.  A dynamic program over the words keeps, for
each prefix that ends with a word, its exact number of tokens: the count before
plus the word's.  The last entry is the text's count; budget questions are
searches in that table.  Each distinct word is encoded once per task.

Inside a word (text without white space is a single one) the count of each
character prefix is that of the library's pre-token pieces before it plus that
of the piece it cuts.  Only words that straddle a limit, or all when the table
itself is wanted, are looked into.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import schema_with

LONG_PIECE = 128  # characters; prefixes of longer pieces are counted by the merges' prefix program
MEMO_WORDS = 1 << 20  # entries held by a task; when full it is begun again, which costs time only


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceProgram:
    """Token counts of all prefixes of a piece, by the merges of a byte-pair model.

    The tokens of a prefix are those of a shorter prefix and one token more, the one
    that the merges leave beside the shorter prefix's last token.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.known = model.get("type") == "BPE" and not any(
            model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "byte_fallback", "unk_token"))
        if self.known:
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.rank, self.vocab, self.end = {m: i for i, m in enumerate(merges)}, model["vocab"], model.get("end_of_word_suffix") or ""
            self.longest = max(map(len, self.vocab))
            self.beside = lru_cache(maxsize=1 << 16)(self._beside)

    def _beside(self, last: tuple[str, bool] | None, token: tuple[str, bool]) -> bool:
        """Whether the merges leave these two (text, ends the word) as two tokens."""
        parts, expected = [], []
        for text, ends in (token,) if last is None else (last, token):
            parts += [*text[:-1], text[-1] + self.end * ends]
            expected.append(text + self.end * ends)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:], strict=False), key=lambda p: self.rank.get(p, len(self.rank)))
            if best not in self.rank:
                break
            out = []
            for part in parts:
                if out and (out[-1], part) == best:
                    out[-1] = best[0] + best[1]
                else:
                    out.append(part)
            parts = out
        return parts == expected

    def counts(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... symbols of a piece."""
        body, last, out = [0], [None], []
        for j in range(1, len(piece) + 1):
            for ends in (True, False):
                for i in range(max(0, j - self.longest), j):
                    token = piece[i:j]
                    if token + self.end * ends in self.vocab and self.beside(last[i], (token, ends)):
                        if ends:
                            out.append(body[i] + 1)
                        else:
                            body.append(body[i] + 1)
                            last.append((token, False))
                        break
                else:
                    raise ValueError(f"no token of the vocabulary ends {piece[:j]!r}")
        return out


@lru_cache(maxsize=2)
def _program(path: str) -> PieceProgram:
    return PieceProgram(path)


class Prefixes:
    """Exact token counts of the character prefixes of a word."""

    def __init__(self, path: str, word: str) -> None:
        self.tokenizer, self.program, self.word = _tokenizer(path), _program(path), word
        encoded = self.tokenizer.encode(word, add_special_tokens=False)
        self.starts, self.before = [0], [0]  # where pieces begin, and the tokens before them
        for i, (piece, (begin, _)) in enumerate(zip(encoded.word_ids, encoded.offsets, strict=True)):
            if i and piece != encoded.word_ids[i - 1] and begin > self.starts[-1]:
                self.starts.append(begin)
                self.before.append(i)
        self.starts.append(len(word))
        self.before.append(len(encoded.ids))

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _long(self, text: str) -> list[int] | None:
        """Counts of the prefixes of a text that is one piece of the model, if its characters are normalised one by one."""
        if not self.program.known:
            return None
        normal, pieces = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        alone = [normal.normalize_str(c) if normal else c for c in text]
        whole = normal.normalize_str(text) if normal else text
        found = pieces.pre_tokenize_str(whole) if pieces else [(whole, None)]
        symbols = [len(pieces.pre_tokenize_str(c)[0][0]) if pieces and c.strip() else 0 for c in alone]
        if "".join(alone) != whole or len(found) != 1 or sum(symbols) != len(found[0][0]) or 0 in symbols:
            return None
        counts = self.program.counts(found[0][0])
        return [counts[i - 1] for i in np.cumsum(symbols)]

    def of_piece(self, k: int) -> list[int]:
        """Counts of the prefixes that end with a character of piece ``k``."""
        begin, end = self.starts[k], self.starts[k + 1]
        if end - begin > LONG_PIECE and (counts := self._long(self.word[begin:end])) is not None:
            return [self.before[k] + c for c in counts]
        from_ = max(0, k - 1)  # a special string cut short may join the piece before
        texts, out = range(begin + 1, end + 1), []
        for i in range(0, len(texts), 256):
            out += self._encoded([self.word[self.starts[from_]:t] for t in texts[i:i + 256]])
        return [self.before[from_] + c for c in out]

    def all(self) -> list[int]:
        return [c for k in range(len(self.starts) - 1) for c in self.of_piece(k)]

    def longest(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if budget < 1:
            return 0
        last = int(np.searchsorted(self.before, budget, side="right"))
        for k in range(min(last + 1, len(self.starts) - 2), -1, -1):
            fits = [i for i, c in enumerate(self.of_piece(k)) if c <= budget]
            if fits:
                return self.starts[k] + fits[-1] + 1
        return 0


class WordCounts:
    """Token counts of words, by the words' hashes."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int32)

    def of(self, w: W.Words) -> np.ndarray:
        """Token count of each word of ``w``."""
        distinct, first, each = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        counts = np.zeros(len(distinct), np.int32)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        for begin in range(0, len(new), 4096):
            part = new[begin:begin + 4096]
            texts = [_text(w, i) for i in first[part]]
            counts[part] = [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.hashes) + len(new) > MEMO_WORDS:
            self.hashes, self.counts = distinct[:MEMO_WORDS], counts[:MEMO_WORDS]
        else:
            hashes, values = np.concatenate([self.hashes, distinct[new]]), np.concatenate([self.counts, counts[new]])
            order = np.argsort(hashes)
            self.hashes, self.counts = hashes[order], values[order]
        return counts[each]


def _text(w: W.Words, i: int) -> str:
    return w.data[w.starts[i]:w.ends[i]].tobytes().decode("utf-8", "replace")


def _inside(path: str, w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and tokens of all prefixes of each distinct word, the distinct word of each word, and where its prefixes begin."""
    _, first, each = np.unique(w.hashes, return_index=True, return_inverse=True)
    lengths, counts, cut = [], [], [0]
    for i in first:
        text = _text(w, i)
        lengths += np.cumsum([len(c.encode()) for c in text]).tolist()
        counts += Prefixes(path, text).all()
        cut.append(len(counts))
    return np.array(lengths, np.int64), np.array(counts, np.int64), each, np.array(cut)


def _count(path: str, budget: int, table: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordCounts(path)
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column(1), W.SPACE, fold_case=False)
                tokens = np.concatenate([[0], np.cumsum(memo.of(w), dtype=np.int64)])
                base = tokens[w.bounds[:-1]]
                total = tokens[w.bounds[1:]] - base
                # words whose prefix stays within the budget: a search in the running counts
                fits = np.searchsorted(tokens, base + budget, side="right") - 1
                fits = np.minimum(fits, w.bounds[1:])
                ends = np.concatenate([[0], w.ends])
                begin = w.text_offsets[:-1]
                fit_bytes = np.where(total <= budget, np.diff(w.text_offsets), np.where(fits > w.bounds[:-1], ends[fits] - begin, 0))
                for i in np.flatnonzero(total > budget):  # the word that straddles the budget
                    left = int(base[i] + budget - tokens[fits[i]])
                    text = _text(w, fits[i])
                    if left and (n := Prefixes(path, text).longest(left)):
                        fit_bytes[i] = w.starts[fits[i]] - begin[i] + len(text[:n].encode())
                out = [part.column(0), pa.array(np.diff(w.text_offsets)), pa.array(total), pa.array(total > budget), pa.array(fit_bytes)]
                names = ["id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"]
                if table:
                    lengths, counts, each, cut = _inside(path, w)
                    size = cut[each + 1] - cut[each]
                    at = np.arange(size.sum()) + np.repeat(cut[each] - np.cumsum(size) + size, size)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(size)])[w.bounds], pa.int32())
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(lengths[at] + np.repeat(w.starts - np.repeat(begin, w.counts), size))))
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(counts[at] + np.repeat(tokens[:-1] - np.repeat(base, w.counts), size))))
                    names += ["prefix_bytes", "prefix_tokens"]
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 with_prefixes: bool = False) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``, ``fit_bytes``.

    ``fit_bytes`` is the length of the longest prefix of at most ``limit``
    tokens: the whole text, or a prefix that ends with a character of a word.
    With ``with_prefixes`` the table itself comes along: ``prefix_bytes`` and
    ``prefix_tokens``, one entry per character of a word.  Counts are without begin, end or
    added special tokens; special strings inside a text count as the library
    counts them.  A null text is empty (0 bytes, 0 tokens); repeated rows are
    counted one by one; other columns are ignored; an empty table gives none.

    ``tokenizer`` is the path of a tokenizers file whose normaliser and
    pre-tokenizer treat ASCII white space as a boundary that yields no token.
    """
    rest = "n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    rest += ", prefix_bytes array<long>, prefix_tokens array<long>" if with_prefixes else ""
    schema = schema_with(docs, id_col, "id", rest)
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_count(tokenizer, limit, with_prefixes), schema)
    return out.withColumnRenamed("id", id_col)


def tokens_within(prefixes: DataFrame, n_bytes: int, out: str = "tokens") -> DataFrame:
    """Tokens of the characters that end within the first ``n_bytes`` bytes, from the table of :func:`token_counts`."""
    inside = F.size(F.filter("prefix_bytes", lambda b: b <= n_bytes))
    return prefixes.withColumn(out, F.coalesce(F.get("prefix_tokens", inside - 1), F.lit(0).cast("long")))


def truncate_to_tokens(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the longest prefix of the text that ends in a word and has at most ``limit`` tokens."""
    row = docs.select(F.struct(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    fit = token_counts(row, tokenizer, limit, "row", "text")
    cut = F.substring(F.col(f"row.{text_col}").cast("binary"), F.lit(1), F.col("fit_bytes").cast("int")).cast("string")
    return fit.select(F.col(f"row.{id_col}").alias(id_col), cut.alias(text_col), "n_tokens", "over_limit")
