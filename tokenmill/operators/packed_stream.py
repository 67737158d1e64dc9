"""A token stream as packed rows in files, and what is cut from it without moving it by keys.

The stream is written once, in order, in rows of ``ROW_TOKENS`` ids of about a byte
each.  Tasks read it by position: blocks come from ranges of it, and of windows
that are about as many as its tokens, each task draws its own samples,
sorts them by their starts and cuts them while the whole stream goes by.  So
neither windows nor their ids are shuffled, and windows stay with their sample
ids' neighbours.  Every ``HELD_SAMPLES`` samples take a pass over the stream, so beyond
``PASS_TOKENS`` windows are dealt to stretches of it instead (``windows.dealt_examples``).

A stream whose rows don't follow each other without gap or overlap (keys of
documents that repeat or are null, blocks that are missing or short) is
not packed; its callers lay it out by joins as before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.fused import map_batches
from tokenmill.session import default_parallelism, delete_scratch, free_memory, scratch_path

ROW_TOKENS = 1 << 19  # ids of a row
HELD_SAMPLES = 1 << 24  # samples that a task draws and sorts, 8 bytes each
LEAST_SAMPLES = 1 << 20  # below this a further task is not worth its pass over the stream
HELD_BYTES = 1 << 27  # ids of examples that a task brings into sample order
BATCH_WINDOWS = 1 << 13  # windows of an Arrow batch
DRAWN_AT_ONCE = 1 << 18
TASK_BLOCK_TOKENS = 1 << 23  # ids whose blocks a task makes
PASS_TOKENS = 1 << 34  # of a stream that every task reads
ROWS = "run long, first long, n long, top long, odd boolean, ids binary"


def pack_ids(ids: np.ndarray) -> bytes:
    """The ids' low bytes, 1, 2 or 4 planes of them, behind the few ids that need more: number of planes, of these ids, places, ids."""
    u = np.ascontiguousarray(ids, np.int32).view(np.uint32)
    for planes in (1, 2, 4):
        at = np.flatnonzero(u >> np.uint32(8 * planes)) if planes < 4 else np.empty(0, np.int64)
        if len(at) * 16 <= len(u):
            break
    out = [bytes([planes]), np.uint32(len(at)).tobytes(), at.astype(np.uint32).tobytes(), u[at].tobytes()]
    return b"".join(out + [(u >> np.uint32(8 * p)).astype(np.uint8).tobytes() for p in range(planes)])


def unpack_ids(packed: bytes | pa.Buffer) -> np.ndarray:
    data = np.frombuffer(packed, np.uint8)
    planes, few = int(data[0]), int.from_bytes(data[1:5].tobytes(), "little")
    at, their = (np.frombuffer(data[5 + 4 * few * k:5 + 4 * few * (k + 1)].tobytes(), np.uint32) for k in (0, 1))
    low = data[5 + 8 * few:].reshape(planes, -1)
    out = low[0].astype(np.uint32)
    for p in range(1, planes):
        out |= low[p].astype(np.uint32) << np.uint32(8 * p)
    out[at] = their
    return out.view(np.int32)


def packed_column(ids_col: str):
    """The packed ids of an array column; null for a null array or one with null ids."""
    @F.arrow_udf(T.BinaryType())
    def pack(ids: pa.Array) -> pa.Array:
        n = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        values, ends = ids.flatten(), np.cumsum(n, dtype=np.int64)
        void = ids.is_null().to_numpy(zero_copy_only=False)
        if values.null_count:
            void = void | (np.bincount(np.repeat(np.arange(len(n)), n)[values.is_null().to_numpy(zero_copy_only=False)], minlength=len(n)) > 0)
        v = (pc.fill_null(values, 0) if values.null_count else values).to_numpy()
        return pa.array([None if no else pack_ids(v[b - k:b]) for k, b, no in zip(n, ends, void, strict=True)], pa.binary())
    return pack(F.col(ids_col))


@dataclass(frozen=True)
class PackedStream:
    """Files and, in the stream's order, first position, length, file, and place in the file of each row."""

    files: list[str]
    lo: np.ndarray
    n: np.ndarray
    file: np.ndarray
    place: np.ndarray
    n_tokens: int
    top: int

    def rows(self, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """``(position, ids)`` of the rows that meet ``[begin, end)``, in order; a row group is read at a time."""
        end = self.n_tokens if end is None else end
        opened, held = None, None
        for i in range(int(np.searchsorted(self.lo, begin, "right")) - 1, len(self.lo)):
            if self.lo[i] >= end:
                break
            if self.file[i] != opened:
                opened, held = self.file[i], None
                source = _opened(self.files[opened])
                meta = source.metadata
                last = np.cumsum([meta.row_group(g).num_rows for g in range(meta.num_row_groups)])
            group = int(np.searchsorted(last, self.place[i], "right"))
            if held is None or held[0] != group:
                held = None
                held = group, source.read_row_group(group, columns=["ids"], use_threads=False)["ids"]
            ids = unpack_ids(held[1][int(self.place[i] - (last[group - 1] if group else 0))].as_buffer())
            if len(ids) != self.n[i]:
                raise ValueError("a row of the stream has changed")
            yield int(self.lo[i]), ids


def _opened(uri: str) -> pq.ParquetFile:
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return pq.ParquetFile(system.open_input_file(path), pre_buffer=False)


def pack_documents(docs: DataFrame, order_cols: Sequence[str], ids_col: str = "ids") -> PackedStream | None:
    """The documents' ids in the order of their keys; None if keys repeat or are null or floating, or ids are null."""
    if any(isinstance(docs.schema[c].dataType, T.FloatType | T.DoubleType) for c in order_cols):
        return None
    spark, keys = docs.sparkSession, list(order_cols)
    # written first: ranges are drawn from a scan of their own, which would make the ids anew
    at = scratch_path(spark, "packed")
    docs.select(*keys, packed_column(ids_col).alias("_packed")).write.parquet(at)
    ranged = spark.read.parquet(at).repartitionByRange(*[F.col(c) for c in keys]).sortWithinPartitions(*keys)
    out = _written(ranged.mapInArrow(_rows_of_documents(len(keys)), ROWS))
    delete_scratch(spark, at)
    return out


def _rows_of_documents(n_keys: int) -> Callable:
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, before, odd = _Rows(TaskContext.get().partitionId(), ROW_TOKENS), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            same = [pc.equal(k.slice(1), k.slice(0, len(k) - 1)) for k in keys]
            equal = same[0]
            for s in same[1:]:
                equal = pc.and_(equal, s)
            first, packed = [k[0].as_py() for k in keys], batch.column(n_keys)
            odd = odd or any(k.null_count for k in keys) or bool(packed.null_count) or first == before or bool(pc.any(equal).as_py())
            before = [k[-1].as_py() for k in keys]
            if not odd:
                for p in packed:
                    yield from rows.add(unpack_ids(p.as_buffer()))
        yield from rows.ended(odd)
        free_memory()
    return lay


class _Rows:
    """Cuts what it is given into rows of ``length`` ids."""

    def __init__(self, run: int, length: int):
        self.run, self.length, self.first, self.held, self.size = run, length, 0, [], 0

    def add(self, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.length:
            whole = np.concatenate(self.held)
            done = self.size - self.size % self.length
            for i in range(0, done, self.length):
                yield self.row(whole[i:i + self.length])
            self.held, self.size = [whole[done:].copy()], self.size - done

    def ended(self, odd: bool = False) -> Iterator[pa.RecordBatch]:
        if self.size or odd:
            yield self.row(np.concatenate(self.held) if self.held else np.empty(0, np.int32), odd)
        self.held, self.size = [], 0

    def row(self, ids: np.ndarray, odd: bool = False) -> pa.RecordBatch:
        top = int(ids.view(np.uint32).max()) if len(ids) else 0
        columns = [pa.array([v], t) for v, t in ((self.run, pa.int64()), (self.first, pa.int64()), (len(ids), pa.int64()), (top, pa.int64()),
                                                 (odd, pa.bool_()), (pack_ids(ids), pa.binary()))]
        self.first += len(ids)
        return pa.RecordBatch.from_arrays(columns, names=["run", "first", "n", "top", "odd", "ids"])


def pack_blocks(blocks: DataFrame, block_size: int, n_tokens: int) -> PackedStream | None:
    """Stored blocks of a stream, without what they hold beyond ``block_size`` ids; None unless they are the stream's, once each and whole."""
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, due, odd = None, None, False
        for batch in batches:
            number, ids = batch.columns
            odd = odd or bool(number.null_count or ids.null_count or ids.flatten().null_count)
            if odd:
                continue
            sizes, values = ids.value_lengths().to_numpy(), ids.flatten().to_numpy()
            for block, size, end in zip(number.to_numpy().tolist(), sizes.tolist(), np.cumsum(sizes, dtype=np.int64).tolist(), strict=True):
                if block != due:
                    if rows is not None:
                        yield from rows.ended()
                    rows = _Rows(block * block_size, ROW_TOKENS)
                yield from rows.add(values[end - size:end - size + min(size, block_size)].copy())
                due = block + 1 if size >= block_size else None
        if rows is not None or odd:
            yield from (rows or _Rows(0, ROW_TOKENS)).ended(odd)
        free_memory()

    out = _written(blocks.select("block_id", "ids").mapInArrow(lay, ROWS), placed=True)
    return out if out is not None and out.n_tokens == n_tokens else None


def _written(rows: DataFrame, placed: bool = False) -> PackedStream | None:
    """``rows`` in files; runs follow each other by their number, which with ``placed`` is the position where they begin."""
    spark = rows.sparkSession
    at = scratch_path(spark, "stream")
    (rows.write.option("parquet.block.size", 1 << 23).option("parquet.block.size.row.check.min", 1)
     .option("parquet.page.size.row.check.min", 1).parquet(at))
    found = spark.read.parquet(at).select("run", "first", "n", "top", "odd", "_metadata.file_path", "_metadata.row_index").collect()
    found.sort(key=lambda r: (r["run"], r["first"], r["n"]))
    if any(r["odd"] for r in found):
        delete_scratch(spark, at)
        return None
    files = sorted({r["file_path"] for r in found})
    number = {f: i for i, f in enumerate(files)}
    run, first, n, file, place = (np.array([v(r) for r in found], np.int64) for v in (
        lambda r: r["run"], lambda r: r["first"], lambda r: r["n"], lambda r: number[r["file_path"]], lambda r: r["row_index"]))
    lo = np.cumsum(n) - n
    try:
        if files:
            _opened(files[0])
    except Exception:  # noqa: BLE001 - the folder is in a store that only Spark reads
        return None
    if placed and (lo != run + first).any():
        delete_scratch(spark, at)
        return None
    return PackedStream(files, lo, n, file, place, int(n.sum()), max((r["top"] for r in found), default=0))


@dataclass(frozen=True)
class Cut:
    """Windows 0 to ``n_samples`` - 1 of a stream; ``draw`` gives the starts of sample ids."""

    stream: PackedStream
    context: int
    n_samples: int
    draw: Callable[[np.ndarray], np.ndarray]

    def windows(self, begin: int, end: int, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``(sample ids, starts, ids, places)`` of samples ``begin`` to ``end`` - 1 in the order of their starts, ``at_once`` at most; a window begins at its place in the ids."""
        ctx, bits = self.context, max(1, int(end - begin - 1).bit_length())
        key = np.empty(end - begin, np.uint64)
        for i in range(0, len(key), DRAWN_AT_ONCE):
            own = np.arange(i, min(len(key), i + DRAWN_AT_ONCE))
            key[own] = self.draw(own + begin).astype(np.uint64) << np.uint64(bits) | own.astype(np.uint64)
        key.sort()
        done, tail = 0, np.empty(0, np.int32)
        for lo, ids in self.stream.rows():
            held = np.concatenate([tail, ids])
            first, whole = lo - len(tail), len(held) - ctx  # starts of windows that are whole
            if whole <= 0:
                tail = held
                continue
            upto = int(np.searchsorted(key, np.uint64((first + whole) << bits)))
            for i in range(done, upto, at_once):
                part = key[i:min(upto, i + at_once)]
                start = (part >> np.uint64(bits)).astype(np.int64)
                yield (part & np.uint64((1 << bits) - 1)).astype(np.int64) + begin, start, held, start - first
            done, tail = upto, held[whole:].copy()
        if done != len(key):
            raise ValueError("blocks of the stream are missing")


def gathered(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` ids at each place, end to end."""
    return np.ndarray(len(ids) - size + 1, f"V{4 * size}", ids, 0, (4,))[at].view(np.int32)


def cut_examples(spark: SparkSession, cut: Cut) -> DataFrame:
    """``sample_id, start, x, y``: of each task the windows of some successive samples, in the order of their starts."""
    per_task = min(HELD_SAMPLES, max(LEAST_SAMPLES, -(-cut.n_samples // (4 * default_parallelism(spark)))))
    ctx = cut.context

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for batch in batches for t in batch.column(0).to_pylist()):
            for sample, start, ids, at in cut.windows(task * per_task, min(cut.n_samples, (task + 1) * per_task), BATCH_WINDOWS):
                ends = pa.array(np.arange(0, len(sample) * ctx + 1, ctx, dtype=np.int32))
                x, y = (pa.ListArray.from_arrays(ends, pa.array(gathered(ids, at + k, ctx))) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(sample), pa.array(start), x, y], names=["sample_id", "start", "x", "y"])
        free_memory()

    tasks = -(-cut.n_samples // per_task)
    out = map_batches(spark.range(0, tasks, 1, tasks), run, "sample_id long, start long, x array<int>, y array<int>")
    out._cut = cut
    return out


def stream_blocks(spark: SparkSession, stream: PackedStream, block_size: int, halo: int, part_blocks: int | None = None) -> DataFrame:
    """``block_id, ids``, ascending in each task; tasks make whole parts of ``part_blocks`` blocks, or one of a few stretches of a part."""
    most = max(1, TASK_BLOCK_TOKENS // block_size)
    n_blocks = -(-stream.n_tokens // block_size)
    if part_blocks is None or part_blocks > most:
        whole = part_blocks or n_blocks or 1
        cuts = [b for p in range(0, n_blocks, whole) for b in range(p, min(p + whole, n_blocks), most)]
    else:
        cuts = list(range(0, n_blocks, most // part_blocks * part_blocks))
    bounds = np.array([*cuts, n_blocks], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for batch in batches for t in batch.column(0).to_pylist()):
            begin, end = int(bounds[task]), int(bounds[task + 1])
            held, first, block = np.empty(0, np.int32), None, begin
            for lo, ids in stream.rows(begin * block_size, min(stream.n_tokens, end * block_size + halo)):
                if first is None:
                    ids = ids[begin * block_size - lo:]
                    first = begin * block_size
                held = np.concatenate([held, ids])
                ready = min(end, block + max(0, (len(held) - halo) // block_size))
                yield from made(block, ready, held)
                held, block = held[(ready - block) * block_size:], ready
            yield from made(block, end, held)
        free_memory()

    def made(begin: int, end: int, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        if end > begin:
            parts = [held[i * block_size:(i + 1) * block_size + halo] for i in range(end - begin)]
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(begin, end)), ids], names=["block_id", "ids"])

    tasks = max(1, len(cuts))
    rows = spark.range(0, tasks if cuts else 0, 1, tasks)
    out = map_batches(rows, run, "block_id long, ids array<int>")
    out._packed = (stream, block_size, halo)
    return out


def cut_batches(spark: SparkSession, cut: Cut, batch_size: int, keep: int) -> DataFrame:
    """``batch_id, x, y`` of samples 0 to ``keep`` - 1: a task cuts the windows of some successive batches and packs them in sample order."""
    size, kind = cut.context + 1, np.uint16 if cut.stream.top < 1 << 16 else np.int32
    n_batches = -(-keep // batch_size)
    held = HELD_BYTES // (size * np.dtype(kind).itemsize)
    per_task = max(1, min(held // batch_size, -(-n_batches // (4 * default_parallelism(spark))))) * batch_size
    at_once = max(1, BATCH_WINDOWS // batch_size) * batch_size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for batch in batches for t in batch.column(0).to_pylist()):
            begin, end = task * per_task, min(keep, (task + 1) * per_task)
            windows = np.empty((end - begin, size), kind)
            for sample, _, ids, at in cut.windows(begin, end, BATCH_WINDOWS):
                windows[sample - begin] = gathered(ids, at, size).reshape(-1, size)
            for i in range(0, len(windows), at_once):
                part = windows[i:i + at_once].astype(np.int32)
                ends = pa.array(np.arange(0, len(part) * (size - 1) + 1, size - 1, dtype=np.int32))
                cuts = pa.array([*range(0, len(part), batch_size), len(part)], pa.int32())
                x, y = (pa.ListArray.from_arrays(cuts, pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(v).ravel())))
                        for v in (part[:, :-1], part[:, 1:]))
                number = np.arange((begin + i) // batch_size, (begin + i) // batch_size + len(cuts) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(number), x, y], names=["batch_id", "x", "y"])
            del windows
        free_memory()

    tasks = -(-keep // per_task)
    return map_batches(spark.range(0, tasks, 1, max(1, tasks)), run, "batch_id bigint, x array<array<int>>, y array<array<int>>")
