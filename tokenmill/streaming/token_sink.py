"""Exactly-once token cache of a stream of corpus files.

A ``foreachBatch`` sink that encodes each micro-batch and lays its tokens out behind
those of all earlier ones, as the batch job would with the same files in the order
of their arrival.  What a later batch has to know is one ledger row per batch: the
length of the stream so far and the ids of the last, open block.

A batch writes its closed blocks to a folder of its own and then its ledger row, a
file that appears by a single rename.  A batch that is replayed after a crash finds
its row and does nothing, or does not and writes its folder anew, so every token is in
the cache once.  Readers take the folders of batches with a row, and the open block
from the last row.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import COMPACT_ID_LIMIT, EOT
from tokenmill.functions.text import strip_ws, utf8_decode
from tokenmill.operators.bpe import BpeModel
from tokenmill.operators.codec import compact_ids
from tokenmill.operators.ordered import global_rank
from tokenmill.operators.windows import DEFAULT_BLOCK, token_blocks
from tokenmill.session import delete_scratch, path_exists, scratch_path
from tokenmill.sources.corpus import ORDER_COLS, file_key
from tokenmill.sources.token_cache import merges_digest
from tokenmill.streaming.ops import stream_encode

LEDGER = "batch_id bigint, n_tokens bigint, open_block array<int>, n_docs bigint"
IDENTITY = ("vocab_size", "eot_token_id", "merges_sha256", "block_size", "checkpoint_path")


def stream_segments(spark: SparkSession, path: str, *, delimiter: str = EOT, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw segments of text files as they arrive, with their places: ``file_path, block_start, value``."""
    reader = spark.readStream.option("lineSep", delimiter).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"), "value")


class TokenSink:
    """Writes the micro-batches of :func:`stream_segments` to a token cache at ``path``."""

    def __init__(self, spark: SparkSession, path: str, model: BpeModel, checkpoint_path: str, block_size: int = DEFAULT_BLOCK, errors: str = "replace"):
        self.spark, self.path, self.model, self.block_size, self.errors = spark, path.rstrip("/"), model, block_size, errors
        identity = {"vocab_size": model.vocab_size, "eot_token_id": model.eot_id, "merges_sha256": merges_digest(model.merges),
                    "block_size": block_size, "checkpoint_path": checkpoint_path.rstrip("/")}
        known = read_identity(spark, self.path)
        if known is None:
            spark.createDataFrame([(json.dumps(identity),)], "identity string").coalesce(1).write.mode("error").parquet(f"{self.path}/identity")
        elif known != identity:
            differs = [k for k in IDENTITY if known.get(k) != identity[k]]
            raise ValueError(f"the token cache at {path} belongs to another stream or tokenizer: {', '.join(differs)}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        last = last_row(self.spark, self.path)
        if last is not None and last["batch_id"] >= batch_id:
            return  # committed before the stream could record it
        before, held = (last["n_tokens"], last["open_block"]) if last else (0, [])
        scratch: list[str] = []

        def written(df: DataFrame, name: str) -> DataFrame:
            scratch.append(scratch_path(self.spark, name))
            df.write.parquet(scratch[-1])
            return self.spark.read.schema(df.schema).parquet(scratch[-1])

        docs = written(self._encoded(written(self._segments(batch), "stream-segments")), "stream-ids")
        ranks = global_rank(docs, ORDER_COLS, "seq")
        ids = docs.join(ranks, list(ORDER_COLS)).select("seq", "ids")
        total = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("tokens")).first()
        if held:  # the open block goes on as a document before the first
            ids = ids.unionByName(self.spark.createDataFrame([(-1, held)], "seq bigint, ids array<int>"))
        here = len(held) + int(total["tokens"])
        closed, first = here // self.block_size, before // self.block_size
        blocks = written(token_blocks(ids, ["seq"], block_size=self.block_size), "stream-blocks")
        (blocks.filter(F.col("block_id") < closed).select((F.col("block_id") + first).alias("block_id"), "ids")
         .write.mode("overwrite").parquet(f"{self.path}/blocks/batch={batch_id}"))
        rest = blocks.filter(F.col("block_id") == closed).select("ids").first() if here % self.block_size else None
        row = (batch_id, before + int(total["tokens"]), list(rest["ids"]) if rest else [], int(total["n"]))
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        for path in scratch:
            delete_scratch(self.spark, path)

    def _segments(self, batch: DataFrame) -> DataFrame:
        text = F.regexp_replace(utf8_decode(F.col("value").cast("binary"), self.errors), "\r\n?", "\n")
        return batch.select(file_key(F.col("file_path")).alias("file_key"), "block_start", F.monotonically_increasing_id().alias("row_id"),
                            strip_ws(text).alias("text"))

    def _encoded(self, segs: DataFrame) -> DataFrame:
        last = segs.groupBy("file_key").agg(F.max(F.struct(*ORDER_COLS[1:])).alias("p"))  # one row per file
        last = last.select("file_key", "p.*", F.lit(True).alias("last"))
        docs = segs.join(last, list(ORDER_COLS), "left").filter(~(F.coalesce("last", F.lit(False)) & (F.length("text") == 0)))
        ids = stream_encode(docs.select(*ORDER_COLS, "text"), self.model).select(*ORDER_COLS, "ids")
        return compact_ids(ids) if self.model.vocab_size <= COMPACT_ID_LIMIT else ids


def read_identity(spark: SparkSession, path: str) -> dict | None:
    where = f"{path.rstrip('/')}/identity"
    row = spark.read.schema("identity string").parquet(where).first() if path_exists(spark, where) else None
    return json.loads(row["identity"]) if row else None


def last_row(spark: SparkSession, path: str):
    ledger = f"{path.rstrip('/')}/ledger"
    if not path_exists(spark, ledger):
        return None
    return spark.read.schema(LEDGER).parquet(ledger).orderBy(F.col("batch_id").desc()).first()


def read_stream_cache(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """``(blocks, meta)`` of all committed batches; ``meta`` has the stream's length and the cache's identity."""
    identity, last = read_identity(spark, path), last_row(spark, path)
    if identity is None:
        raise ValueError(f"no token cache of a stream was found at {path}")
    none = spark.createDataFrame([], "block_id bigint, ids array<int>")
    if last is None:
        return none, {**identity, "n_tokens": 0, "batch_id": None}
    blocks = spark.read.schema("block_id bigint, ids array<int>, batch bigint").parquet(f"{path.rstrip('/')}/blocks")
    blocks = blocks.filter(F.col("batch") <= last["batch_id"]).select("block_id", "ids")
    if last["open_block"]:
        tail = [(last["n_tokens"] // identity["block_size"], last["open_block"])]
        blocks = blocks.unionByName(spark.createDataFrame(tail, "block_id bigint, ids array<int>"))
    return blocks, {**identity, "n_tokens": last["n_tokens"], "batch_id": last["batch_id"]}


def stream_token_cache(
    spark: SparkSession,
    source_path: str,
    model: BpeModel,
    cache_path: str,
    checkpoint_path: str,
    *,
    block_size: int = DEFAULT_BLOCK,
    max_files_per_trigger: int | None = None,
    errors: str = "replace",
) -> dict:
    """Encode all files that have arrived at ``source_path`` since the last call into the cache; its meta.

    Every document is stripped, encoded and followed by one EOT id, also when it is
    empty; a file's blank last segment is no document.  A non-empty last segment gets
    an EOT as well, since more files may follow it.  Documents are laid out by batch,
    then run and part number, then place in the file.
    """
    sink = TokenSink(spark, cache_path, model, checkpoint_path, block_size, errors)
    stream = stream_segments(spark, source_path, max_files_per_trigger=max_files_per_trigger)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_stream_cache(spark, cache_path)[1]
