"""Token cache: the encoded stream as Parquet blocks plus a metadata row.

Layout under ``path``: ``blocks`` (``block_id BIGINT, ids ARRAY<INT>``, in folders
``part=N`` of ``part_blocks`` successive blocks each, sorted) and
``meta``, one row that identifies what the blocks were made from: source path
and size, vocabulary, EOT id, digest of the merge list, block size and halo.
The row is taken away before blocks are written and put back after them, so a
half-written cache has none and is not used.  A bare table with a single
``ids`` column is accepted on read as well; anything else is an error.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators.ordered import global_rank
from tokenmill.operators.packed_stream import pack_blocks, stream_blocks
from tokenmill.operators.windows import by_passes, dealt_examples, many_windows, passed_examples, sample_windows, window_examples, with_halo
from tokenmill.session import materialize, path_exists
from tokenmill.sources.commits import snapshot_paths

META = ("source_path string, source_size_bytes bigint, vocab_size int, eot_token_id int, merges_sha256 string, "
        "block_size int, halo int, n_tokens bigint, part_blocks bigint")
#: Blocks in a folder: half a gigabyte of ids at the default block size.
PART_BLOCKS = 1 << 15
#: Parts are read one by one if the windows are fewer than the parts by this factor.
FEW = 2
BLOCKS = "block_id bigint, ids array<int>"
#: What has to agree for a cache to be used again.
IDENTITY = ("source_path", "source_size_bytes", "vocab_size", "eot_token_id", "merges_sha256", "block_size", "halo")


def source_size(spark: SparkSession, path: str) -> int:
    """Bytes of the source's files (of a corpus: its snapshot's); their contents are not read."""
    paths = snapshot_paths(spark, path)
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return int(files.agg(F.sum("length")).first()[0] or 0)


def merges_digest(merges: Sequence[tuple[int, int]]) -> str:
    return hashlib.sha256(json.dumps([list(m) for m in merges]).encode()).hexdigest()


def _write_meta(spark: SparkSession, base: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, META).coalesce(1).write.mode("overwrite").parquet(f"{base}/meta")


def write_token_cache(
    blocks: DataFrame,
    path: str,
    *,
    source_path: str,
    source_size_bytes: int | None,
    vocab_size: int,
    eot_token_id: int,
    block_size: int,
    halo: int = 0,
    merges_sha256: str | None = None,
    part_blocks: int = PART_BLOCKS,
) -> None:
    """Write the blocks and then the row that makes them a cache.

    Successive blocks share a folder whose number follows from theirs, so a reader of
    some blocks opens the folders that hold them, without listing the others.
    """
    spark = blocks.sparkSession
    base = path.rstrip("/")
    _write_meta(spark, base, [])
    stream, size, _ = packed = vars(blocks).get("_packed", (None, None, None))
    made = stream_blocks(spark, *packed, part_blocks) if stream is not None else blocks
    parted = made.select("block_id", "ids", F.floor(F.col("block_id") / part_blocks).cast("bigint").alias("part"))
    if stream is None:  # else each task has its parts to itself
        parted = parted.repartition("part")
    (parted.sortWithinPartitions("part", "block_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{base}/blocks"))
    if stream is not None and size == block_size:
        n = stream.n_tokens
    else:
        own = F.least(F.size("ids"), F.lit(block_size))
        n = spark.read.parquet(f"{base}/blocks").agg(F.coalesce(F.sum(own), F.lit(0))).first()[0]
    _write_meta(spark, base, [(source_path, source_size_bytes, vocab_size, eot_token_id, merges_sha256, block_size, halo, int(n), part_blocks)])


def read_meta(spark: SparkSession, path: str) -> dict | None:
    """The metadata of a complete cache, else None."""
    meta = f"{path.rstrip('/')}/meta"
    row = spark.read.schema(META).parquet(meta).first() if path_exists(spark, meta) else None
    return row.asDict() if row else None


def read_token_cache(spark: SparkSession, path: str) -> tuple[DataFrame, dict | None]:
    """``(blocks, meta)``; ``meta`` is None for a bare ``ids`` table, whose rows are numbered 0, 1, ... in file order."""
    base = path.rstrip("/")
    if path_exists(spark, f"{base}/blocks"):
        meta = read_meta(spark, base)
        if meta is None:
            raise ValueError(f"the token cache at {path} was not written to its end")
        return spark.read.schema(BLOCKS).parquet(f"{base}/blocks").select("block_id", "ids"), meta
    df = spark.read.parquet(base)
    if df.columns == ["ids"]:
        rows = materialize(df.select(F.monotonically_increasing_id().alias("_row"), "ids"), "cache-rows")
        return rows.join(global_rank(rows, ["_row"], "block_id"), "_row").select("block_id", "ids"), None
    raise ValueError(f"no token cache was found at {path}: neither blocks nor a table of ids")


def read_cached_blocks(spark: SparkSession, path: str, meta: dict, parts: Sequence[int]) -> DataFrame:
    """The blocks of some parts; no other folder is opened or listed."""
    base = f"{path.rstrip('/')}/blocks"
    if not parts:
        return spark.createDataFrame([], BLOCKS)
    return spark.read.schema(BLOCKS).parquet(*[f"{base}/part={p}" for p in sorted(set(parts))])


def tokens_cached(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    *,
    rebuild: bool = False,
    **meta,
) -> tuple[DataFrame, bool]:
    """Use the cache if every recorded item of its identity agrees with ``meta``, else build it anew.

    ``build()`` returns the blocks; ``meta`` goes to :func:`write_token_cache`.
    Returns ``(blocks, reused)``.
    """
    wanted = {"halo": 0, "merges_sha256": None, **meta}
    if not rebuild:
        got = read_meta(spark, path)
        if got is not None and all(got[k] == wanted[k] for k in IDENTITY):
            return read_token_cache(spark, path)[0], True
    write_token_cache(build(), path, **meta)
    return read_token_cache(spark, path)[0], False


def cached_examples(
    spark: SparkSession, path: str, context_length: int, num_samples: int | None = None, seed: int = 42
) -> tuple[DataFrame, int]:
    """``(examples, num_samples)``: training windows straight from a token cache.

    A cache whose blocks carry no halo, or a shorter one than the context, is
    given one first: the head of each block goes to the block before.  Many windows
    are cut from the blocks as a packed stream.  Where the
    windows are few beside the parts, only their parts are read.
    """
    # listing all parts of a large cache takes longer than reading a few
    meta = read_meta(spark, path) or read_token_cache(spark, path)[1]
    if meta is None:
        raise ValueError("windows need the stream's length and block size, which a bare table of ids does not have")
    size, per_part = meta["block_size"], meta["part_blocks"]
    windows = sample_windows(spark, meta["n_tokens"], context_length, num_samples, seed)
    k = num_samples if num_samples is not None else meta["n_tokens"] - context_length - 1
    lacks = meta["halo"] < context_length
    if per_part and k * FEW < meta["n_tokens"] // (size * per_part) + 1:
        parts = _parts_of(windows, size, per_part, lacks, meta["n_tokens"])
        blocks = read_cached_blocks(spark, path, meta, parts)
    else:
        blocks = read_token_cache(spark, path)[0]
        if by_passes(meta["n_tokens"], k) and (stream := pack_blocks(blocks, size, meta["n_tokens"])) is not None:
            return passed_examples(spark, stream, context_length, k, seed), k
    if lacks:
        blocks = with_halo(blocks, context_length, size)
    if stretch := many_windows(meta["n_tokens"], k, context_length, size):
        return dealt_examples(windows, blocks, context_length, size, stretch), k
    return window_examples(windows, blocks, context_length, size, num_samples=k), k


def _parts_of(windows: DataFrame, block_size: int, per_part: int, with_next: bool, n_tokens: int) -> list[int]:
    """Parts that hold the windows' blocks, and the blocks behind them if their heads are needed; at most two a window."""
    block = F.floor(F.col("start") / block_size)
    last = F.lit((n_tokens - 1) // block_size)
    held = F.array(block, F.least(block + 1, last) if with_next else block)
    parts = windows.select(F.explode(F.transform(held, lambda b: F.floor(b / per_part).cast("bigint"))).alias("part")).distinct()
    return [r["part"] for r in parts.collect()]
