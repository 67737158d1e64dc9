"""Structured Streaming: corpus ingestion, cleaning, dedupe and encoding.

Streams are file sources (EOT-delimited text or Parquet rows) written to an
exactly-once file sink.  ``checkpointLocation`` replaces the reference's manual
``--resume N``: a restarted query continues from its last committed batch and
keeps its dedupe state.  ``maxFilesPerTrigger`` bounds the work per
micro-batch, so a crash loses at most one uncommitted batch (``--flush_every``).

Dedupe state is the set of fingerprints, unbounded like the reference's
in-memory set; on a cluster it lives in the RocksDB state store, which spills
to local disk and checkpoints to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.constants import EOT
from tokenmill.functions.text import fingerprint, strip_ws, utf8_decode
from tokenmill.operators.bpe import BpeModel
from tokenmill.operators.codec import encode_text
from tokenmill.session import free_memory

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOCAL_ROWS = 512  # rows copied at a time by the map-side combine


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the JVM heap (set before a stateful query starts)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_corpus(
    spark: SparkSession, path: str, *, delimiter: str = EOT, errors: str = "replace", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Documents of EOT-delimited text files as they arrive: ``file_path, text`` (raw)."""
    reader = spark.readStream.option("lineSep", delimiter).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.text(path)
    text = F.regexp_replace(utf8_decode(F.col("value").cast("binary"), errors), "\r\n?", "\n")
    return raw.select(F.col("_metadata.file_path").alias("file_path"), text.alias("text"))


def stream_rows(
    spark: SparkSession, path: str, schema: T.StructType | str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of Parquet files as they arrive (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_clean(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """Stateless clean: null → '', strip, drop empty."""
    cleaned = stream.withColumn(text_col, strip_ws(F.coalesce(F.col(text_col), F.lit(""))))
    return cleaned.filter(F.length(text_col) > 0)


def drop_local_duplicates(df: DataFrame, key_col: str) -> DataFrame:
    """Keep the first row of each key *within each Arrow batch* (no shuffle, no memory between batches).

    A map-side combine for streaming dedupe: ``dropDuplicates`` shuffles every
    copy of a key to one task, so a document copied into a third of a batch
    would land in one task.  Dropping a batch's repeats first leaves at most one
    copy per key and batch; the state store drops the rest.  The rows that stay are
    copied ``LOCAL_ROWS`` at a time, or not at all where none goes.
    """
    import pyarrow as pa

    def first_per_key(batches):
        for batch in batches:
            keys = pa.table({"k": batch.column(batch.schema.get_field_index(key_col)), "i": pa.array(range(batch.num_rows), pa.int64())})
            first = keys.group_by("k").aggregate([("i", "min")]).column("i_min").combine_chunks().sort()
            if len(first) == batch.num_rows:
                yield batch
            else:
                for at in range(0, len(first), LOCAL_ROWS):
                    yield batch.take(first.slice(at, LOCAL_ROWS))
            del batch, keys, first  # not beside the next batch
        free_memory()

    return df.mapInArrow(first_per_key, df.schema)


def stream_dedupe(
    stream: DataFrame,
    text_col: str = "text",
    fp_col: str = "fp",
    *,
    ttl: str | None = None,
    time_col: str = "ingest_time",
    known: DataFrame | None = None,
) -> DataFrame:
    """Drop documents whose fingerprint was already seen by this query.

    ``known`` (a static frame with ``fp_col``, such as ``seen_fingerprints`` of a corpus)
    names fingerprints that were there before the stream: their documents are dropped
    by an anti-join before the state, which holds none of them.  The frame is read
    in every micro-batch, which an index of 32-byte rows bears and texts would not.

    Local repeats are dropped before the shuffle (map-side combine), then the
    state store keeps one entry per fingerprint.  Arrival order decides the
    survivor inside one stream, as in the reference.

    With ``ttl`` (e.g. ``"7 days"``) state is bounded instead: a fingerprint
    is forgotten once the watermark on ``time_col`` (added as the ingest time
    when absent) passes it by ``ttl`` — ``dropDuplicatesWithinWatermark``.
    A deliberate deviation: copies further apart than ``ttl`` both survive.
    """
    with_fp = stream.withColumn(fp_col, fingerprint(F.col(text_col)))
    local = drop_local_duplicates(with_fp, fp_col)
    if known is not None:
        local = local.join(known.select(fp_col), fp_col, "left_anti").select(*with_fp.columns)
    if ttl is None:
        return local.dropDuplicates([fp_col])
    if time_col not in local.columns:
        local = local.withColumn(time_col, F.current_timestamp())
    return local.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark([fp_col])


def stream_encode(stream: DataFrame, model: BpeModel, text_col: str = "text", out_col: str = "ids", *, tail_col: str | None = None) -> DataFrame:
    """Streaming-encoder semantics: each document is stripped and encoded, then one EOT id.

    A null or blank document is one EOT id.  With ``tail_col`` (boolean), text
    that no delimiter ends gets none, and a blank tail is no document.
    """
    text = strip_ws(F.coalesce(F.col(text_col), F.lit("")))
    tail = F.coalesce(F.col(tail_col), F.lit(False)) if tail_col else F.lit(False)
    kept = stream.withColumn(text_col, text).filter(~tail | (F.length(text_col) > 0))
    ids = encode_text(F.col(text_col), model, add_eot_between_docs=False)
    eot = F.when(tail, F.array().cast("array<int>")).otherwise(F.array(F.lit(model.eot_id)))
    return kept.withColumn(out_col, F.concat(ids, eot))


def run_available_now(stream: DataFrame, sink_path: str, checkpoint_path: str, fmt: str = "parquet") -> dict:
    """Process everything available, commit to the file sink, stop; return progress."""
    query = (
        stream.writeStream.format(fmt)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    return {
        "batches": len([p for p in progress if p.get("numInputRows", 0) > 0]),
        "rows": sum(p.get("numInputRows", 0) for p in progress),
    }
