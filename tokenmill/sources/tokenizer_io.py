"""Tokenizer artifact: ``tokenizer.json`` plus Parquet ``merges`` and ``vocab``.

The JSON keeps the reference layout (``vocab_size``, ``eot_token_id``,
``merges`` as pairs, ``id_to_bytes`` as string id → byte list, ids sorted).
It is written and read with Spark, so the directory may live on any shared
file system.  Its size is bounded by the vocabulary.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.operators.bpe import BpeModel

TOKENIZER_SCHEMA = T.StructType(
    [
        T.StructField("vocab_size", T.IntegerType()),
        T.StructField("eot_token_id", T.IntegerType()),
        T.StructField("merges", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("id_to_bytes", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
    ]
)


def tokenizer_json(model: BpeModel) -> str:
    payload = {
        "vocab_size": model.vocab_size,
        "eot_token_id": model.eot_id,
        "merges": [list(p) for p in model.merges],
        "id_to_bytes": {str(k): list(v) for k, v in sorted(model.id_bytes.items())},
    }
    return json.dumps(payload)


def write_tokenizer(spark: SparkSession, model: BpeModel, path: str, mode: str = "overwrite") -> None:
    base = path.rstrip("/")
    spark.createDataFrame([(tokenizer_json(model),)], "value string").coalesce(1).write.mode(mode).text(
        f"{base}/tokenizer.json"
    )
    model.merges_df(spark).write.mode(mode).parquet(f"{base}/merges")
    model.vocab_df(spark).write.mode(mode).parquet(f"{base}/vocab")


def read_tokenizer_frames(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(meta, merges, vocab)`` read from ``tokenizer.json`` with an explicit schema."""
    raw = spark.read.schema(TOKENIZER_SCHEMA).option("multiLine", True).json(f"{path.rstrip('/')}/tokenizer.json")
    meta = raw.select("vocab_size", "eot_token_id")
    merges = raw.select(F.posexplode("merges").alias("rank", "pair")).select(
        F.col("rank").cast("int").alias("rank"),
        F.col("pair")[0].alias("a"),
        F.col("pair")[1].alias("b"),
        (F.col("rank") + 256).cast("int").alias("new_id"),
    )
    vocab = raw.select(F.explode("id_to_bytes").alias("k", "v")).select(
        F.col("k").cast("int").alias("token_id"),
        F.unhex(F.array_join(F.transform("v", lambda x: F.lpad(F.hex(x), 2, "0")), "")).alias("bytes"),
    )
    return meta, merges, vocab


def read_tokenizer(spark: SparkSession, path: str) -> BpeModel:
    """Load the artifact as a model (merges and vocabulary are ≤ vocab_size rows)."""
    meta, merges, vocab = read_tokenizer_frames(spark, path)
    m = meta.collect()[0]
    pairs = [(int(r["a"]), int(r["b"])) for r in merges.orderBy("rank").collect()]
    id_bytes = {int(r["token_id"]): bytes(r["bytes"]) for r in vocab.collect()}
    return BpeModel(merges=pairs, vocab_size=int(m["vocab_size"]), eot_id=int(m["eot_token_id"]), id_bytes=id_bytes)
