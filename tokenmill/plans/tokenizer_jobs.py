"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import COMPACT_ID_LIMIT
from tokenmill.operators import bpe as B
from tokenmill.operators.codec import compact_ids, encode_text
from tokenmill.operators.pretokenize import pretoken_counts
from tokenmill.operators.windows import token_blocks
from tokenmill.session import materialize
from tokenmill.sources.corpus import ORDER_COLS, read_corpus, with_sequence
from tokenmill.sources.token_cache import merges_digest, source_size, tokens_cached
from tokenmill.sources.tokenizer_io import write_tokenizer


def word_freq_from_corpus(spark: SparkSession, corpus_path: str) -> DataFrame:
    """Corpus file → documents in file order → word frequencies."""
    docs = with_sequence(read_corpus(spark, corpus_path))  # the reader cuts at every marker
    return pretoken_counts(docs.select(F.col("doc_seq").alias("doc_id"), "text"), "text", "doc_id")


def bpe_train_corpus(
    spark: SparkSession, corpus_path: str, vocab_size: int, out_dir: str | None = None, **train_kw
) -> B.BpeModel:
    """Train a tokenizer on an EOT-separated corpus and optionally save it."""
    model = B.bpe_train(word_freq_from_corpus(spark, corpus_path), vocab_size, **train_kw)
    if out_dir:
        write_tokenizer(spark, model, out_dir)
    return model


def corpus_token_ids(spark: SparkSession, corpus_path: str, model: B.BpeModel) -> DataFrame:
    """Encode an EOT-delimited corpus file (or directory) like the streaming encoder.

    Every document that a delimiter ends is stripped, encoded and followed by
    one EOT id, also when it is empty; a non-empty tail after the last
    delimiter is encoded with no EOT.  The blank segment after each file's
    final delimiter (the writer's trailing newlines) is not a document.
    Returns ``doc_seq, ids`` in file order.
    """
    segs = materialize(read_corpus(spark, corpus_path, keep_empty=True), "corpus-segments")
    place = F.struct(*ORDER_COLS[1:])
    last = segs.groupBy("file_key").agg(F.max(place).alias("p"))  # one row per file
    final_file = last.agg(F.max("file_key")).first()[0]
    last = last.select("file_key", "p.*", F.lit(True).alias("_is_last"))
    marked = segs.join(last, list(ORDER_COLS), "left").withColumn("_is_last", F.coalesce("_is_last", F.lit(False)))
    marked = marked.filter(~(F.col("_is_last") & (F.length("text") == 0)))
    tail = F.col("_is_last") & (F.col("file_key") == F.lit(final_file))
    ids = encode_text(F.col("text"), model, add_eot_between_docs=False)
    eot = F.when(tail, F.array().cast("array<int>")).otherwise(F.array(F.lit(model.eot_id)))
    encoded = with_sequence(marked.select(*ORDER_COLS, F.concat(ids, eot).alias("ids"))).select("doc_seq", "ids")
    return compact_ids(encoded) if model.vocab_size <= COMPACT_ID_LIMIT else encoded


def corpus_token_cache(
    spark: SparkSession,
    corpus_path: str,
    model: B.BpeModel,
    cache_path: str,
    *,
    rebuild: bool = False,
    block_size: int = 4096,
    halo: int = 0,
) -> DataFrame:
    """Token blocks of a corpus; those at ``cache_path`` if they were made from the same files and tokenizer."""
    def build() -> DataFrame:
        ids = materialize(corpus_token_ids(spark, corpus_path, model), "corpus-ids")
        return token_blocks(ids, ["doc_seq"], block_size=block_size, halo=halo)

    blocks, _ = tokens_cached(
        spark, cache_path, build, rebuild=rebuild, source_path=corpus_path, source_size_bytes=source_size(spark, corpus_path),
        vocab_size=model.vocab_size, eot_token_id=model.eot_id, merges_sha256=merges_digest(model.merges), block_size=block_size, halo=halo,
    )
    return blocks
