"""The vectorised encoder against merging by adjacency lists, and trims of long white space."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tokenmill.functions.sql import register_sql_functions
from tokenmill.functions.text import normalize_ws, strip_ws
from tokenmill.operators import bpe as B
from tokenmill.operators import codec as X
from tokenmill.operators.clean import strip_trailing_eot
from bpe_oracle import encode_word


def model_of(merges):
    return B.BpeModel(merges=merges, vocab_size=256 + len(merges) + 1, eot_id=256 + len(merges))


def random_model(rng, n):
    merges, top = [], 256
    while len(merges) < n:
        pair = tuple(rng.choice([97, 98, 99, 32, 195, 169, *range(256, top)]) for _ in range(2))
        if pair not in merges:
            merges.append(pair)
            top += 1
    return model_of(merges)


@pytest.mark.parametrize("seed", range(4))
def test_merge_piece_is_one_merge_at_a_time(seed):
    rng = random.Random(seed)
    model = random_model(rng, 60)
    pairs = [X.id_char(a) + X.id_char(b) for a, b in model.merges]
    ranks = {p: r for r, p in enumerate(pairs)}
    for _ in range(200):
        piece = "".join(rng.choice("abc é") for _ in range(rng.randrange(0, 25)))
        assert X.merge_piece(piece, pairs, ranks) == encode_word(model.merges, piece.encode())


def test_batches_with_markers_empties_and_repeats(spark):
    model = random_model(random.Random(9), 40)
    rng = random.Random(3)
    texts = [None, "", "<|endoftext|>", "a<|endoftext|>", "<|endoftext|><|endoftext|>b ", " ab <|endoftext|> ba "]
    texts += ["".join(rng.choice(["a", "b", "c", " ", "é", "<|endoftext|>"]) for _ in range(rng.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    from tokenmill.functions.text import pretokens

    pieces = {r.p for r in df.select(F.explode(F.split(F.coalesce("text", F.lit("")), r"<\|endoftext\|>")).alias("s"))
              .select(F.explode(F.concat(pretokens(F.col("s")), pretokens(strip_ws("s")))).alias("p")).collect()}
    known = {p: encode_word(model.merges, p.encode()) for p in pieces}

    def ids(segments):
        return [[i for p in seg for i in known[p]] for seg in segments]

    split = df.select("doc_id", F.transform(F.split(F.coalesce("text", F.lit("")), r"<\|endoftext\|>", -1),
                                            lambda s: pretokens(strip_ws(s))).alias("segs"), pretokens(F.coalesce("text", F.lit(""))).alias("whole"))
    expected = {}
    for r in split.collect():
        parts = ids(r.segs) if len(r.segs) > 1 else ids([r.whole])
        expected[r.doc_id] = [i for k, part in enumerate(parts) for i in ([model.eot_id] if k else []) + part]
    assert {r.doc_id: list(r.ids) for r in X.encode_documents(df, model).collect()} == expected
    register_sql_functions(spark, model)
    df.createOrReplaceTempView("enc_docs")
    got = spark.sql("SELECT doc_id, tm_bpe_encode(text) e, tm_bpe_decode(NULL) d FROM enc_docs").collect()
    assert {r.doc_id: list(r.e) for r in got} == expected
    assert {r.d for r in got} == {X.decode_tokens(spark.createDataFrame([(None,)], "ids array<int>"), model).first().text}


def test_long_inner_white_space_is_linear(spark):
    text = "  a" + " " * 1_000_000 + "b　\x1f"
    df = spark.createDataFrame([(text, [9])], "t string, ids array<int>")
    began = time.perf_counter()
    row = df.select(F.length(strip_ws("t")).alias("n"), normalize_ws("t").alias("w")).first()
    tail = strip_trailing_eot(df.withColumn("t", F.concat("t", F.lit("<|endoftext|>"))), "ids", "t", 9).select(F.length("t").alias("n")).first()
    assert time.perf_counter() - began < 10
    assert (row.n, row.w, tail.n) == (1_000_002, "a b", 1_000_004)


def test_every_white_space_character_is_trimmed(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    df = spark.createDataFrame([(i, f"{c}x{c}y{c}") for i, c in enumerate(spaces)] + [(-1, "​z᠎")], "i long, t string")
    for r in df.select("i", "t", strip_ws("t").alias("s")).collect():
        assert r.s == r.t.strip()


def test_width_by_vocabulary_and_compact_writes(spark):
    df = spark.createDataFrame([([1, 300],), ([],), (None,)], "ids array<int>")
    assert X.check_token_width(df, vocab_size=65_537, compact=False).first().width == "int32"
    assert X.check_token_width(df, vocab_size=65_536).first().width == "uint16"
    with pytest.raises(Exception, match="vocabulary"):
        X.check_token_width(df, vocab_size=300).collect()
    assert X.compact_ids(df).count() == 3
    with pytest.raises(Exception, match="16-bit"):
        X.compact_ids(spark.createDataFrame([([70_000],)], "ids array<int>")).collect()
