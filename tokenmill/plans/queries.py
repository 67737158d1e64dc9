"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) in
full.  Array outputs are rendered as space-separated strings so that results
compare value for value with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import EOT
from tokenmill.functions.ids import ids_to_string
from tokenmill.functions.text import fingerprint, normalize_ws, strip_ws
from tokenmill.operators import bpe as B
from tokenmill.operators import chunks as K
from tokenmill.operators import clean as C
from tokenmill.operators import codec as X
from tokenmill.operators import dedupe as D
from tokenmill.operators import pretokenize as P
from tokenmill.operators import scores as S
from tokenmill.operators import scores_long as SL
from tokenmill.operators import windows as W
from tokenmill.operators.ordered import global_rank
from tokenmill.plans.tokenizer_jobs import bpe_train_corpus
from tokenmill.session import materialize, scratch_path
from tokenmill.sources import byteranges as BR
from tokenmill.sources import corpus as IO
from tokenmill.sources import fingerprints as FP
from tokenmill.sources import token_cache as TC
from tokenmill.sources import tokenizer_io as TIO
from tokenmill.sources.tables import read_documents, read_table, skip_rows
from tokenmill.streaming import ops as ST
from tokenmill.streaming import token_sink as TS

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_documents(spark, sf, columns=("doc_id", "text"))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_documents(_docs(spark, sf))


def q_read_documents(spark, sf):
    return read_documents(spark, sf, columns=("doc_id", "text", "lang", "source", "n_chars"))


def q_clean_documents(spark, sf):
    return _clean(spark, sf)


def q_normalize_text(spark, sf):
    return C.normalize_text(_clean(spark, sf)).select("doc_id", "norm_text")


def q_doc_fingerprint(spark, sf):
    return C.doc_fingerprint(_clean(spark, sf)).select("doc_id", "fp")


def q_dedupe_exact(spark, sf):
    return D.dedupe_exact(_clean(spark, sf), ("doc_id",)).select("doc_id", "text", "fp")


def q_dedupe_report(spark, sf):
    return D.dedupe_report(_clean(spark, sf))


def q_ingest_report(spark, sf):
    return D.ingest_report(_docs(spark, sf), ("doc_id",))


def q_skip_rows(spark, sf):
    return skip_rows(_docs(spark, sf), 100, ("doc_id",))


def q_pretokenize(spark, sf):
    return P.pretokenize(_clean(spark, sf)).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "pretoken")


def q_pretoken_counts(spark, sf):
    return P.pretoken_counts(_clean(spark, sf))


def _distinct_pretokens(spark, sf):
    return P.pretokenize(_clean(spark, sf)).select("pretoken").distinct()


def q_pretoken_bytes(spark, sf):
    return P.pretoken_bytes(_distinct_pretokens(spark, sf)).select("pretoken", ids_to_string("ids").alias("ids"))


def _word_ids(spark, sf):
    return P.pretoken_bytes(P.pretoken_counts(_clean(spark, sf)))


def q_adjacent_pairs(spark, sf):
    w = _word_ids(spark, sf)
    pairs = P.adjacent_pairs(F.col("ids"))
    rendered = F.array_join(F.transform(pairs, lambda p: F.concat_ws(",", p["a"], p["b"])), " ")
    return w.filter(F.size("ids") >= 2).select("pretoken", rendered.alias("pairs"))


def q_pair_stats(spark, sf):
    return P.pair_stats(_word_ids(spark, sf)).select("a", "b", F.col("cnt").cast("bigint").alias("cnt"))


def q_top_pair(spark, sf):
    top = P.top_pair(P.pair_stats(_word_ids(spark, sf)), 20)
    # 20 rows: numbering them on the driver side of the plan is a top-k report.
    from pyspark.sql import Window

    w = Window.orderBy(F.col("cnt").desc(), F.col("first").asc())
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "a", "b", F.col("cnt").cast("bigint").alias("cnt"))


def q_corpus_token_stats(spark, sf):
    return P.corpus_token_stats(_clean(spark, sf))


def q_flagship(spark, sf):
    """clean → dedupe → pretokenize → word frequencies, most frequent first."""
    kept = D.dedupe_exact(_clean(spark, sf), ("doc_id",))
    return P.pretoken_counts(kept).orderBy(F.col("freq").desc(), "first_doc", "first_pos")


def registry() -> dict[str, Query]:
    return {
        "read_documents": q_read_documents,
        "clean_documents": q_clean_documents,
        "normalize_text": q_normalize_text,
        "doc_fingerprint": q_doc_fingerprint,
        "dedupe_exact": q_dedupe_exact,
        "dedupe_report": q_dedupe_report,
        "ingest_report": q_ingest_report,
        "skip_rows": q_skip_rows,
        "pretokenize": q_pretokenize,
        "pretoken_counts": q_pretoken_counts,
        "pretoken_bytes": q_pretoken_bytes,
        "adjacent_pairs": q_adjacent_pairs,
        "pair_stats": q_pair_stats,
        "top_pair": q_top_pair,
        "corpus_token_stats": q_corpus_token_stats,
        **_extra(),
    }


def _extra() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in sorted(k for k in globals() if k.startswith("_REGISTRY_")):
        out.update(globals()[name])
    return out


# ---- BPE training --------------------------------------------------------------------------

BPE_VOCAB = 256 + 8 + 1  # 8 merges + EOT: the oracle unrolls eight rounds


def _word_freq(spark, sf):
    return P.pretoken_counts(_clean(spark, sf))


def q_bpe_train(spark, sf):
    model = B.bpe_train(_word_freq(spark, sf), BPE_VOCAB)
    return model.merges_df(spark).select(*[F.col(c).cast("bigint").alias(c) for c in ("rank", "a", "b", "new_id")])


def q_merge_word(spark, sf):
    from tokenmill.functions.ids import code_units_to_ids, latin1_word

    wf = _word_freq(spark, sf)
    top = B.word_pair_stats(B.word_table(wf)).orderBy(F.col("cnt").desc(), F.col("first").asc()).limit(1).collect()
    w = latin1_word(F.col("pretoken"))
    if top:
        pair = top[0]["pair"]
        w = B.merge_word(w, B.char_id(pair[0]), B.char_id(pair[1]), 256)
    return wf.select("pretoken", ids_to_string(code_units_to_ids(w)).alias("ids"))


def q_bpe_vocab(spark, sf):
    model = B.bpe_train(_word_freq(spark, sf), BPE_VOCAB)
    v = B.bpe_vocab(model, spark)
    return v.select(F.col("token_id").cast("bigint").alias("token_id"), F.hex("bytes").alias("hex"))


_REGISTRY_BPE = {"bpe_train": q_bpe_train, "merge_word": q_merge_word, "bpe_vocab": q_bpe_vocab}


# ---- encode / decode with a fixed merge list -----------------------------------------------

# ---- fixed values: a literal 10-merge tokenizer used by the codec queries ----
FIXED_MERGES = [(32, 116), (104, 101), (256, 257), (105, 110), (101, 114),
                (32, 97), (111, 110), (259, 103), (101, 110), (32, 115)]
FIXED_VOCAB = 256 + len(FIXED_MERGES) + 1
# ---- end of fixed values ----


def fixed_model() -> B.BpeModel:
    return B.BpeModel(merges=list(FIXED_MERGES), vocab_size=FIXED_VOCAB, eot_id=FIXED_VOCAB - 1)


def q_encode_pretokens(spark, sf):
    enc = X.encode_pretokens(_distinct_pretokens(spark, sf), fixed_model())
    return enc.select("pretoken", ids_to_string("ids").alias("ids"))


def _encoded_docs(spark, sf):
    return X.encode_documents(_clean(spark, sf), fixed_model())


def q_encode_documents(spark, sf):
    return _encoded_docs(spark, sf).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_to_string("ids").alias("ids")
    )


def _eot_docs(spark, sf):
    """Documents whose line breaks are turned into delimiters (segments inside rows)."""
    return _clean(spark, sf).withColumn("text", F.replace(F.col("text"), F.lit("\n"), F.lit(EOT)))


def q_split_on_eot(spark, sf):
    return C.split_on_eot(_eot_docs(spark, sf)).select(
        "doc_id", F.col("seg").cast("bigint").alias("seg"), "text"
    )


def q_encode_corpus(spark, sf):
    enc = X.encode_corpus(_eot_docs(spark, sf), fixed_model())
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_to_string("ids").alias("ids"))


def q_decode_tokens(spark, sf):
    return X.decode_tokens(_encoded_docs(spark, sf), fixed_model()).select("doc_id", "text")


def q_strip_trailing_eot(spark, sf):
    m = fixed_model()
    enc = _encoded_docs(spark, sf).join(read_documents(spark, sf, columns=("doc_id", "lang")), "doc_id")
    ids = F.when(F.col("lang") == "en", F.concat("ids", F.array(F.lit(m.eot_id)))).otherwise(F.col("ids"))
    dec = X.decode_tokens(enc.withColumn("ids", ids), m, out_col="decoded")
    return C.strip_trailing_eot(dec, "ids", "decoded", m.eot_id, out_col="text").select("doc_id", "text")


def q_check_token_width(spark, sf):
    return X.check_token_width(_encoded_docs(spark, sf))


def q_utf8_decode(spark, sf):
    # Whole document bytes followed by a malformed tail: 'o' 'k' FF E2 82 ' ' 'z'.
    bad = F.concat(F.encode(F.col("text"), "UTF-8"), F.unhex(F.lit("6F6BFFE282207A")))
    from tokenmill.functions.text import utf8_decode

    return _clean(spark, sf).select(
        "doc_id",
        utf8_decode(bad, "replace").alias("replaced"),
        utf8_decode(bad, "ignore").alias("ignored"),
    )


_REGISTRY_CODEC = {
    "encode_pretokens": q_encode_pretokens,
    "encode_documents": q_encode_documents,
    "split_on_eot": q_split_on_eot,
    "encode_corpus": q_encode_corpus,
    "decode_tokens": q_decode_tokens,
    "strip_trailing_eot": q_strip_trailing_eot,
    "check_token_width": q_check_token_width,
    "utf8_decode": q_utf8_decode,
}


# ---- token stream layout, windows, batches -------------------------------------------------

CONTEXT = 32
BATCH = 32
SEED = 42
TRAIN_SAMPLES = 5000 * BATCH  # steps × batch size, the reference's default run
EVAL_SAMPLES = 32 * BATCH  # eval batches × batch size


def byte_model() -> B.BpeModel:
    """No merges: ids are raw UTF-8 bytes, EOT = 256."""
    return B.BpeModel(merges=[], vocab_size=257, eot_id=256)


def _stream_docs(spark, sf, table="documents"):
    if table == "documents":
        docs, keys = _clean(spark, sf), ["doc_id"]
    else:
        docs = C.clean_documents(read_table(spark, sf, "conversations", ["conv_id", "turn", "text"]))
        keys = ["conv_id", "turn"]
    return X.encode_corpus(docs, byte_model()), keys


def _examples(spark, sf, table="documents", num_samples=None, seed=SEED):
    enc, keys = _stream_docs(spark, sf, table)
    return W.training_examples(enc.select(*keys, "ids"), keys, CONTEXT, num_samples, seed)


def q_token_offsets(spark, sf):
    enc, keys = _stream_docs(spark, sf)
    return W.token_offsets(enc, keys)


def q_sample_windows(spark, sf):
    enc, keys = _stream_docs(spark, sf)
    n = W.stream_length(W.token_offsets(enc, keys))
    return W.sample_windows(spark, n, CONTEXT, None, SEED)


def q_window_examples(spark, sf):
    ex, _ = _examples(spark, sf)
    return W.window_checksums(ex)


def q_batch_examples(spark, sf):
    ex, k = _examples(spark, sf)
    sums = W.window_checksums(ex)
    b = W.batch_examples(sums, BATCH, k).select("batch_id", "sample_id", "x_sum")
    return b.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.sum("x_sum").cast("bigint").alias("x_sum"),
        F.min("sample_id").alias("first_sample"),
    )


def q_packed_batches(spark, sf):
    """Every training batch as one row of nested arrays, summed with the place of each row in it."""
    ex, k = _examples(spark, sf)
    return W.packed_checksums(W.packed_batches(ex, BATCH, k), CONTEXT)


def q_holdout_examples(spark, sf):
    train_ids, train_keys = _stream_docs(spark, sf, "documents")
    val_ids, val_keys = _stream_docs(spark, sf, "conversations")
    train, val = W.holdout_examples(
        materialize(train_ids.select(*train_keys, "ids"), "stream"), train_keys, CONTEXT, TRAIN_SAMPLES, EVAL_SAMPLES, SEED,
        eval_ids=materialize(val_ids.select(*val_keys, "ids"), "stream"), eval_order=val_keys,
    )
    return W.window_checksums(train).withColumn("split", F.lit("train")).unionByName(
        W.window_checksums(val).withColumn("split", F.lit("val"))
    )


_REGISTRY_WINDOWS = {
    "token_offsets": q_token_offsets,
    "sample_windows": q_sample_windows,
    "window_examples": q_window_examples,
    "batch_examples": q_batch_examples,
    "packed_batches": q_packed_batches,
    "holdout_examples": q_holdout_examples,
}


# ---- scored rows (embeddings stand in for logits, label for the target) ---------------------

TEMPERATURE = 0.9
TOP_P = 0.9


def _logits(spark, sf):
    return read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("logits"), "label"
    )


def _probs(spark, sf):
    return S.softmax(_logits(spark, sf), "logits", "probs", TEMPERATURE).select("vec_id", "probs")


def q_softmax_scores(spark, sf):
    return _probs(spark, sf).select("vec_id", F.posexplode("probs").alias("item", "prob")).select(
        "vec_id", F.col("item").cast("bigint").alias("item"), F.round("prob", 6).alias("prob")
    )


def _nucleus(spark, sf):
    return S.top_p(_probs(spark, sf), "probs", TOP_P, "dist").select("vec_id", "dist")


def q_top_p_filter(spark, sf):
    return _nucleus(spark, sf).select("vec_id", F.explode("dist").alias("d")).select(
        "vec_id", F.col("d.item").cast("bigint").alias("item"), F.round("d.p", 6).alias("prob")
    )


def _long_probs(spark, sf):
    long = _logits(spark, sf).select("vec_id", F.posexplode("logits").alias("item", "score"))
    return SL.softmax_long(long, "vec_id", "item", "score", TEMPERATURE)


def q_softmax_long(spark, sf):
    """The softmax of scores that stand one a row."""
    return _long_probs(spark, sf).select("vec_id", F.col("item").cast("bigint").alias("item"), F.round("prob", 6).alias("prob"))


def q_top_p_long(spark, sf):
    """The nucleus cut of scores that stand one a row."""
    cut = SL.top_p_long(_long_probs(spark, sf), "vec_id", "item", "prob", TOP_P)
    return cut.select("vec_id", F.col("item").cast("bigint").alias("item"), F.round("prob", 6).alias("prob"))


def q_weighted_choice(spark, sf):
    n = _nucleus(spark, sf)
    pick = S.weighted_choice(F.col("dist"), S.md5_uniform(SEED, F.col("vec_id")))
    return n.select("vec_id", pick.cast("bigint").alias("item"))


def q_greedy_choice(spark, sf):
    return _logits(spark, sf).select("vec_id", S.greedy_choice(F.col("logits")).cast("bigint").alias("item"))


def q_eval_loss(spark, sf):
    # the loss of each row first, so that its place in the order joins one number
    rows = materialize(S.cross_entropy(_logits(spark, sf), "logits", "label").select("vec_id", "ce"), "losses")
    ranks = global_rank(rows, ["vec_id"], "_r")
    full = (rows.count() // BATCH) * BATCH
    batched = rows.join(ranks, "vec_id").filter(F.col("_r") < full).withColumn("batch_id", F.floor(F.col("_r") / BATCH))
    out = S.mean_of_batches(batched, "ce", "batch_id")
    return out.select(F.round("loss", 6).alias("loss"), F.col("n_batches").cast("bigint").alias("n_batches"))


_REGISTRY_SCORES = {
    "softmax_scores": q_softmax_scores,
    "top_p_filter": q_top_p_filter,
    "softmax_long": q_softmax_long,
    "top_p_long": q_top_p_long,
    "weighted_choice": q_weighted_choice,
    "greedy_choice": q_greedy_choice,
    "eval_loss": q_eval_loss,
}


# ---- multi-source dedupe and resume ---------------------------------------------------------
def q_dedupe_merged(spark, sf):
    sources = [
        (read_table(spark, sf, "documents", ["doc_id", "text"]), ["doc_id"]),
        (read_table(spark, sf, "conversations", ["conv_id", "turn", "text"]), ["conv_id", "turn"]),
        (read_table(spark, sf, "benchmark", ["item_id", "text"]), ["item_id"]),
    ]
    return D.dedupe_merged(sources).select("source_rank", "k1", "k2", "text", "fp")


def _resume_split(spark, sf):
    """All documents, split into an earlier run (English) and the appended run (the rest)."""
    docs = read_documents(spark, sf, columns=("doc_id", "text", "lang"))
    earlier = F.coalesce(F.col("lang") == "en", F.lit(False))
    return docs.filter(earlier).drop("lang"), docs.filter(~earlier).drop("lang")


def q_dedupe_resume(spark, sf):
    existing, new = _resume_split(spark, sf)
    return D.dedupe_resume(existing, new, ("doc_id",)).select("doc_id", "text", "fp")


# ---- corpus chunking over the written-corpus layout ------------------------------------------

NUM_CHUNKS = 8
FEW_WINDOWS = 20
ROUNDTRIP_MERGES = 200


def _layout(spark, sf):
    return materialize(K.file_layout(_clean(spark, sf)), "layout")


def q_chunk_boundaries(spark, sf):
    bounds = K.chunk_boundaries(_layout(spark, sf), NUM_CHUNKS)
    return spark.createDataFrame(list(enumerate(bounds)), "idx bigint, byte_offset bigint")


def q_corpus_chunks(spark, sf):
    lay = _layout(spark, sf)
    return K.corpus_chunks(lay, K.chunk_boundaries(lay, NUM_CHUNKS))


def q_chunk_preview(spark, sf):
    lay = _layout(spark, sf)
    return K.chunk_preview(lay, K.chunk_boundaries(lay, NUM_CHUNKS), 200)


_REGISTRY_MORE = {
    "dedupe_merged": q_dedupe_merged,
    "dedupe_resume": q_dedupe_resume,
    "chunk_boundaries": q_chunk_boundaries,
    "corpus_chunks": q_corpus_chunks,
    "chunk_preview": q_chunk_preview,
}


# ---- file connectors: corpus text, tokenizer artifact, token cache ---------------------------


def _written_corpus(spark, sf):
    path = scratch_path(spark, "corpus")
    IO.write_corpus(_clean(spark, sf), path, order_cols=["doc_id"])
    return path


def q_write_corpus(spark, sf):
    """Counts taken from the files that were written."""
    path = _written_corpus(spark, sf)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    docs = IO.read_corpus(spark, path, strip=False, keep_empty=True).filter(~F.col("text").rlike(r"\A\s*\z"))
    return files.agg(F.sum("length").alias("bytes")).crossJoin(docs.agg(F.count(F.lit(1)).alias("docs"))).select("docs", "bytes")


def q_append_corpus(spark, sf):
    """English documents, then the others in a second run; read back in the order of writing."""
    path = scratch_path(spark, "corpus")
    earlier, later = _resume_split(spark, sf)
    IO.write_corpus(C.clean_documents(earlier), path, order_cols=["doc_id"])
    IO.write_corpus(C.clean_documents(later), path, order_cols=["doc_id"], mode="append")
    return IO.with_sequence(IO.read_corpus(spark, path)).select("doc_seq", "text")


def q_append_deduped(spark, sf):
    """English documents, then the others, each appended without what the corpus has; the corpus read back."""
    path = scratch_path(spark, "corpus")
    for part in _resume_split(spark, sf):
        FP.append_deduped(part, path)
    return IO.with_sequence(IO.read_corpus(spark, path)).select("doc_seq", "text", fingerprint(F.col("text")).alias("fp"))


def q_clean_corpus(spark, sf):
    """A corpus file deduplicated in file order, written again and read back."""
    path = scratch_path(spark, "corpus")
    IO.clean_corpus(spark, _written_corpus(spark, sf), path)
    return IO.with_sequence(IO.read_corpus(spark, path)).select("doc_seq", fingerprint(F.col("text")).alias("fp"))


def q_raw_chunks(spark, sf):
    """Chunks of a written file, cut at its own delimiters."""
    path = scratch_path(spark, "corpus")
    IO.write_corpus(_clean(spark, sf), path, order_cols=["doc_id"])
    lay = materialize(K.raw_file_layout(spark, path), "layout")
    return K.corpus_chunks(lay, K.chunk_boundaries(lay, NUM_CHUNKS, ("doc_seq",)))


def q_seek_boundaries(spark, sf):
    """Boundaries of a written corpus, found by seeking to each guess."""
    bounds, _ = BR.seek_boundaries(spark, _written_corpus(spark, sf), NUM_CHUNKS)
    return spark.createDataFrame(list(enumerate(bounds)), "idx bigint, byte_offset bigint")


def q_positioned_corpus(spark, sf):
    """Documents of a written corpus with the byte at which each ends, read in ranges of a megabyte."""
    return BR.positioned_corpus(spark, _written_corpus(spark, sf), range_bytes=1 << 20).select("text", "end_byte")


def q_trained_roundtrip(spark, sf):
    """Train on the documents, encode them with the result, decode again."""
    model = B.bpe_train(_word_freq(spark, sf), 256 + ROUNDTRIP_MERGES + 1)
    docs = materialize(X.encode_documents(_clean(spark, sf), model), "encoded")
    return X.decode_tokens(docs, model, "ids", "text").select("doc_id", "text")


def q_token_totals(spark, sf):
    """Documents, bytes, pretokens, tokens and the largest id, with the width that the vocabulary asks for."""
    model = fixed_model()
    docs = materialize(X.encode_documents(_clean(spark, sf), model).select("text", "ids"), "encoded")
    width = X.check_token_width(docs, vocab_size=model.vocab_size).select("width")
    return P.corpus_token_stats(docs, "text", "ids").crossJoin(width)


def q_read_corpus(spark, sf):
    docs = IO.with_sequence(IO.read_corpus(spark, _written_corpus(spark, sf)))
    return docs.select("doc_seq", "text")


def q_bpe_train_corpus(spark, sf):
    model = bpe_train_corpus(spark, _written_corpus(spark, sf), BPE_VOCAB)
    return model.merges_df(spark).select(*[F.col(c).cast("bigint").alias(c) for c in ("rank", "a", "b", "new_id")])


def _tokenizer_dir(spark, sf):
    path = scratch_path(spark, "tokenizer")
    TIO.write_tokenizer(spark, B.bpe_train(_word_freq(spark, sf), BPE_VOCAB), path)
    return path


def q_write_tokenizer(spark, sf):
    _, merges, _ = TIO.read_tokenizer_frames(spark, _tokenizer_dir(spark, sf))
    return merges.select(*[F.col(c).cast("bigint").alias(c) for c in ("rank", "a", "b", "new_id")])


def q_read_tokenizer(spark, sf):
    model = TIO.read_tokenizer(spark, _tokenizer_dir(spark, sf))
    return B.bpe_vocab(model, spark).select(F.col("token_id").cast("bigint").alias("token_id"), F.hex("bytes").alias("hex"))


def _cache_blocks(spark, sf):
    enc, keys = _stream_docs(spark, sf)
    return W.token_blocks(enc.select(*keys, "ids"), keys)


def _cache_meta(spark, sf):
    m = byte_model()
    path = f"{sf.rstrip('/')}/documents.parquet"
    return dict(source_path=path, source_size_bytes=TC.source_size(spark, path), vocab_size=m.vocab_size, eot_token_id=m.eot_id,
                merges_sha256=TC.merges_digest(m.merges), block_size=W.DEFAULT_BLOCK, halo=0)


def _block_summary(blocks):
    return blocks.select(
        "block_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")).alias("id_sum"),
    )


def q_write_token_cache(spark, sf):
    path = scratch_path(spark, "token-cache")
    TC.write_token_cache(_cache_blocks(spark, sf), path, **_cache_meta(spark, sf))
    _, meta = TC.read_token_cache(spark, path)
    return spark.createDataFrame(
        [(meta["vocab_size"], meta["eot_token_id"], meta["n_tokens"], meta["block_size"])],
        "vocab_size bigint, eot_token_id bigint, n_tokens bigint, block_size bigint",
    )


def q_read_token_cache(spark, sf):
    path = scratch_path(spark, "token-cache")
    TC.write_token_cache(_cache_blocks(spark, sf), path, **_cache_meta(spark, sf))
    blocks, _ = TC.read_token_cache(spark, path)
    return _block_summary(blocks)


def q_tokens_cached(spark, sf):
    path = scratch_path(spark, "token-cache")
    meta = _cache_meta(spark, sf)
    TC.tokens_cached(spark, path, lambda: _cache_blocks(spark, sf), **meta)
    blocks, reused = TC.tokens_cached(spark, path, lambda: _cache_blocks(spark, sf), **meta)
    return _block_summary(blocks).withColumn("reused", F.lit(reused))


def q_cache_windows(spark, sf):
    """Training windows from a token cache whose blocks carry no halo."""
    path = scratch_path(spark, "token-cache")
    TC.write_token_cache(_cache_blocks(spark, sf), path, **_cache_meta(spark, sf))
    examples, _ = TC.cached_examples(spark, path, CONTEXT, None, SEED)
    return W.window_checksums(examples)


def q_cache_few_windows(spark, sf):
    """A handful of training windows; of the cache only the parts that hold them are read."""
    path = scratch_path(spark, "token-cache")
    TC.write_token_cache(_cache_blocks(spark, sf), path, part_blocks=4, **_cache_meta(spark, sf))
    examples, _ = TC.cached_examples(spark, path, CONTEXT, FEW_WINDOWS, SEED)
    return W.window_checksums(examples)


_REGISTRY_IO = {
    "write_corpus": q_write_corpus,
    "read_corpus": q_read_corpus,
    "append_corpus": q_append_corpus,
    "append_deduped": q_append_deduped,
    "clean_corpus": q_clean_corpus,
    "raw_chunks": q_raw_chunks,
    "seek_boundaries": q_seek_boundaries,
    "positioned_corpus": q_positioned_corpus,
    "trained_roundtrip": q_trained_roundtrip,
    "token_totals": q_token_totals,
    "cache_windows": q_cache_windows,
    "cache_few_windows": q_cache_few_windows,
    "bpe_train_corpus": q_bpe_train_corpus,
    "write_tokenizer": q_write_tokenizer,
    "read_tokenizer": q_read_tokenizer,
    "write_token_cache": q_write_token_cache,
    "read_token_cache": q_read_token_cache,
    "tokens_cached": q_tokens_cached,
}


# ---- streaming (availableNow into a fresh sink, read back as a static table) -----------------

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _docs_glob(sf):
    return f"{sf.rstrip('/')}/documents.parque[t]"


def q_stream_corpus(spark, sf):
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    ST.run_available_now(ST.stream_corpus(spark, _written_corpus(spark, sf)), sink, ck)
    out = spark.read.parquet(sink)
    return out.select(strip_ws(F.col("text")).alias("text")).filter(F.length("text") > 0)


def q_stream_clean(spark, sf):
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = ST.stream_rows(spark, _docs_glob(sf), DOC_SCHEMA).select("doc_id", "text")
    ST.run_available_now(ST.stream_clean(stream), sink, ck)
    return spark.read.parquet(sink).select("doc_id", "text")


def q_stream_dedupe(spark, sf):
    ST.use_rocksdb_state(spark)
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = ST.stream_rows(spark, _docs_glob(sf), DOC_SCHEMA).select("doc_id", "text")
    ST.run_available_now(ST.stream_dedupe(ST.stream_clean(stream)), sink, ck)
    return spark.read.parquet(sink).select("fp")


def q_stream_resume(spark, sf):
    """Two runs on one checkpoint; the second sees only newly arrived files."""
    ST.use_rocksdb_state(spark)
    src, sink, ck = scratch_path(spark, "in"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    earlier, later = _resume_split(spark, sf)
    IO.write_corpus(C.clean_documents(earlier), src, order_cols=["doc_id"])
    stream = ST.stream_dedupe(ST.stream_clean(ST.stream_corpus(spark, src)))
    ST.run_available_now(stream, sink, ck)
    IO.write_corpus(C.clean_documents(later), src, order_cols=["doc_id"], mode="append")
    ST.run_available_now(stream, sink, ck)
    return spark.read.parquet(sink).select("fp")


def q_stream_known(spark, sf):
    """A stream of all documents over a corpus of some: only fingerprints that the corpus lacks come out."""
    ST.use_rocksdb_state(spark)
    base, sink, ck = scratch_path(spark, "corpus"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    earlier, _ = _resume_split(spark, sf)
    FP.append_deduped(earlier, base)
    stream = ST.stream_rows(spark, _docs_glob(sf), DOC_SCHEMA).select("doc_id", "text")
    ST.run_available_now(ST.stream_dedupe(ST.stream_clean(stream), known=FP.seen_fingerprints(spark, base)), sink, ck)
    return spark.read.parquet(sink).select("fp")


def q_stream_flush(spark, sf):
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = ST.stream_clean(ST.stream_corpus(spark, _written_corpus(spark, sf), max_files_per_trigger=1))
    ST.run_available_now(stream, sink, ck)
    return spark.read.parquet(sink).select("text")


def q_stream_encode(spark, sf):
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = ST.stream_encode(ST.stream_clean(ST.stream_corpus(spark, _written_corpus(spark, sf))), fixed_model())
    ST.run_available_now(stream.select("text", "ids"), sink, ck)
    out = spark.read.parquet(sink)
    return out.select(
        fingerprint(F.col("text")).alias("fp"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        ids_to_string("ids").alias("ids"),
    )


def q_stream_token_cache(spark, sf):
    """Token blocks of a corpus that arrives in two runs, encoded by two runs of one stream."""
    src, cache, ck = scratch_path(spark, "in"), scratch_path(spark, "cache"), scratch_path(spark, "ckpt")
    for part, mode in zip(_resume_split(spark, sf), ("overwrite", "append"), strict=True):
        IO.write_corpus(C.clean_documents(part), src, order_cols=["doc_id"], mode=mode)
        TS.stream_token_cache(spark, src, fixed_model(), cache, ck)
    blocks, _ = TS.read_stream_cache(spark, cache)
    weighted = F.transform("ids", lambda x, i: x.cast("bigint") * (i + 1))
    return blocks.select("block_id", F.size("ids").cast("bigint").alias("n_tokens"),
                         F.aggregate(weighted, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("checksum"))


_REGISTRY_STREAM = {
    "stream_token_cache": q_stream_token_cache,
    "stream_corpus": q_stream_corpus,
    "stream_clean": q_stream_clean,
    "stream_dedupe": q_stream_dedupe,
    "stream_resume": q_stream_resume,
    "stream_known": q_stream_known,
    "stream_flush": q_stream_flush,
    "stream_encode": q_stream_encode,
}
