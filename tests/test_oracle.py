"""Spark queries against their DuckDB oracle on sf0.001 (the driver's gate, small)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, _digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

KEYS = [
    "clean_documents", "doc_fingerprint", "dedupe_exact", "dedupe_report", "ingest_report", "skip_rows",
    "pretokenize", "pretoken_counts", "pair_stats", "top_pair", "bpe_train", "bpe_vocab",
    "encode_documents", "encode_corpus", "decode_tokens", "split_on_eot", "token_offsets",
    "window_examples", "top_p_filter", "eval_loss", "dedupe_merged", "chunk_boundaries",
    "corpus_chunks", "chunk_preview", "read_corpus", "stream_dedupe", "write_corpus", "append_corpus", "clean_corpus",
    "raw_chunks", "token_totals", "cache_windows", "tokens_cached", "strip_trailing_eot", "check_token_width", "stream_encode",
    "seek_boundaries", "positioned_corpus", "packed_batches", "cache_few_windows", "softmax_long", "top_p_long", "stream_known",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_every_query_has_an_oracle():
    llm = {k for k in E.queries() if k.startswith("op") or k == "pipeline"}
    assert set(E.queries()) - llm == set(E.oracle_sql()) - llm


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pretoken", "freq", "first_doc", "first_pos"]
    assert df.limit(5).count() == 5
