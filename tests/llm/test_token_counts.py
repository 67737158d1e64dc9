import pytest

from llm_cases import SF_SMALL, clashing_docs, edge_docs, make_docs, no_docs  # noqa: F401
import __spark_entry__ as E
from tokenmill.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = ["Hello <|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>", "a b ́x é", "\x1c a\x1fb \x85c", "don't  I'll 's", "<|start oftext|> <|startoftext|>",
           "ſt İ ﬁ Å Å", "日本語 テスト", "a b", "  lead", "1234 5a6", "\u200b x\u2028y"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_query_counts_as_the_library_does(spark, library):
    rows = {r.doc_id: r for r in E.queries()["op9_token_counts"](spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        n = library(texts[i])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[i] or "").encode()), n, n > 2048)


def test_every_prefix_and_truncation(spark, library, monkeypatch):
    monkeypatch.setattr(T, "MEMO_WORDS", 8)  # the memo is begun again many times
    docs = make_docs(spark, [(i, s, "s") for i, s in enumerate(SPECIAL)])
    table = T.token_counts(docs, PATH, 3, with_prefixes=True)
    for r in table.collect():
        raw = SPECIAL[r.doc_id].encode()
        assert [library(raw[:b].decode()) for b in r.prefix_bytes] == r.prefix_tokens
        fits = [b for b, t in zip(r.prefix_bytes, r.prefix_tokens, strict=True) if t <= 3]
        assert r.fit_bytes == (len(raw) if r.n_tokens <= 3 else max(fits, default=0))
    for r in T.tokens_within(table, 7).collect():
        assert r.tokens == max([0, *(t for b, t in zip(r.prefix_bytes, r.prefix_tokens, strict=True) if b <= 7)])
    for r in T.truncate_to_tokens(docs, PATH, 3).collect():
        assert SPECIAL[r.doc_id].startswith(r.text) and library(r.text) <= 3


def test_over_limit_texts_without_spaces(spark, library, monkeypatch):
    monkeypatch.setattr(T, "LONG_PIECE", 24)
    texts = ["日本語のテキストを、空白なしで書く。" * 6, "aGVsbG8gd29ybGQ+/x9Zk" * 9, "function(a){return!a<|endoftext|>&&'ll've}" * 4,
             "GATTACAcatgat" * 12, "Thequickbrownfoxjumpsoverthelazydogandgoesaway" * 3, "e\u0301a" * 40, "lead " + "ΣſtﬁÅ漢" * 20]
    docs = make_docs(spark, [(i, s, "s") for i, s in enumerate(texts)])
    for limit in (1, 17, 40):
        for r in T.token_counts(docs, PATH, limit).collect():
            text = texts[r.doc_id]
            fits = [i for i in range(len(text) + 1) if library(text[:i]) <= limit]
            assert r.over_limit and r.fit_bytes == len(text[:fits[-1]].rstrip().encode()), (text, limit)
        assert all(r.text for r in T.truncate_to_tokens(docs, PATH, limit).collect())
    for r in T.token_counts(docs, PATH, 5, with_prefixes=True).collect():
        raw = texts[r.doc_id].encode()
        assert [library(raw[:b].decode()) for b in r.prefix_bytes] == r.prefix_tokens


def test_edges(spark, edge_docs, clashing_docs, no_docs, library):
    for docs in (edge_docs, clashing_docs):
        got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in T.token_counts(docs, PATH).collect())
        assert got == sorted((r.doc_id or 0, len((r.text or "").encode()), library(r.text)) for r in edge_docs.collect())
    assert T.token_counts(no_docs, PATH).count() == 0
