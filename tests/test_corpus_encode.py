"""Corpus-file encoding follows the streaming encoder's EOT rules."""

from tokenmill.constants import EOT
from tokenmill.operators import bpe as B
from tokenmill.plans.tokenizer_jobs import corpus_token_cache, corpus_token_ids
from tokenmill.sources import corpus as IO

BYTES = B.BpeModel(merges=[], vocab_size=257, eot_id=256)


def _flat(df):
    return [i for r in df.orderBy("doc_seq").collect() for i in r.ids]


def test_eot_rules_on_raw_file(spark, tmp_path):
    p = tmp_path / "c.txt"
    p.write_text(f"a{EOT}  {EOT} b ")
    assert _flat(corpus_token_ids(spark, str(p), BYTES)) == [97, 256, 256, 98]


def test_writer_layout_each_doc_then_eot(spark, tmp_dir):
    df = spark.createDataFrame([(0, "x y"), (1, "z")], "doc_id long, text string")
    IO.write_corpus(df, f"{tmp_dir}/c", order_cols=["doc_id"])
    assert _flat(corpus_token_ids(spark, f"{tmp_dir}/c", BYTES)) == [120, 32, 121, 256, 122, 256]
    blocks = corpus_token_cache(spark, f"{tmp_dir}/c", BYTES, f"{tmp_dir}/cache", block_size=4)
    got = [i for r in blocks.orderBy("block_id").collect() for i in r.ids]
    assert got == [120, 32, 121, 256, 122, 256]
