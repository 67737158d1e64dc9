"""Sharding into pieces of near-equal bytes by sampled splitters.

Rows are ordered by a key: the hash of the text, the hash of the id, a copy number.
Equal texts are therefore neighbours and share a shard unless a shard boundary
falls among them, and a text that fills a third of the table is cut between its ids.
The copy number is 0 but for rows that repeat both text and id in such numbers
that they outgrow a range, or where a shard must end among them: these rows are
written once with a number each, which cuts them like any other key.

1. the keys and sizes go to a narrow table (one pass over the texts);
2. a size-weighted sample of keys, bounded in number, gives quantile splitters;
3. the ranges are measured exactly, and ranges above twice the mean are
   subdivided from a denser sample of their own;
   if keys of repeated rows must be cut, they are numbered and 2 and 3 done anew;
4. the ranges in which a shard ends are sorted to find the exact end key;
5. every row finds its range by a binary search over the splitters, and is
   numbered inside the range; the range's measured base makes it a slot.

Only splitters and one total per range reach the driver (at most ``MAX_RANGES``).
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.frames import own_columns
from tokenmill.llm.ranges import among, with_range
from tokenmill.session import materialize

MAX_RANGES = 1 << 15
RANGE_BYTES = 128 << 20
SAMPLES_PER_RANGE = 16
OVERHEAD = 8
KEY = ("h", "g", "c")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (none for a null) plus the fixed overhead of a record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _quantiles(keys: list[tuple], weights: list[int], parts: int) -> list[tuple]:
    """Keys at which a weighted, sorted sample passes each of ``parts`` equal shares."""
    total, run, out = sum(weights), 0, []
    for key, weight in zip(keys, weights, strict=True):
        run += weight
        while len(out) < parts - 1 and run * parts > total * (len(out) + 1):
            out.append(key)
    return out


def _sample(keys: DataFrame, every: float, seed: int) -> list[tuple]:
    """(key, weight) of a size-weighted draw, sorted: about one draw for each ``every`` bytes."""
    draw = F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    drawn = keys.withColumn("w", F.floor(F.col("size") / F.lit(every) + draw).cast("long")).filter("w > 0")
    return [((r.h, r.g, r.c), r.w) for r in drawn.groupBy(*KEY).agg(F.sum("w").alias("w")).sort(*KEY).collect()]


def _ranged(keys: DataFrame, bounds: list[tuple]) -> DataFrame:
    return with_range(keys, [F.col(k) for k in KEY], bounds, "range")


def _measure(keys: DataFrame, bounds: list[tuple]) -> tuple[list[int], list[int]]:
    """Bytes and rows of each range."""
    size, rows = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for r in _ranged(keys, bounds).groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        size[r["range"]], rows[r["range"]] = r["size"], r["n"]
    return size, rows


def _splitters(keys: DataFrame, total: int, n_ranges: int, seed: int) -> tuple[list[tuple], list[int]]:
    bounds = _weighted_bounds(keys, total, n_ranges, seed)
    size, _ = _measure(keys, bounds)
    for attempt in range(3):
        mean = total / (len(bounds) + 1)
        full = [i for i, s in enumerate(size) if s > 2 * mean]
        if not full or len(bounds) + 1 >= 2 * MAX_RANGES:
            break
        own = _ranged(keys, bounds).filter(F.col("range").isin(full))
        drawn = _sample(own, mean / (4 * SAMPLES_PER_RANGE), seed + attempt + 1)
        extra = []
        for i in full:
            low = bisect.bisect_left(drawn, (bounds[i - 1],)) if i else 0
            high = bisect.bisect_left(drawn, (bounds[i],)) if i < len(bounds) else len(drawn)
            part = drawn[low:high]
            extra += _quantiles([k for k, _ in part], [w for _, w in part], int(size[i] / mean) + 1)
        finer = sorted({*bounds, *extra})
        if len(finer) == len(bounds):
            break
        bounds = finer
        size, _ = _measure(keys, bounds)
    return bounds, size


def _weighted_bounds(keys: DataFrame, total: int, n_ranges: int, seed: int) -> list[tuple]:
    drawn = _sample(keys, total / (n_ranges * SAMPLES_PER_RANGE), seed)
    return sorted(set(_quantiles([k for k, _ in drawn], [w for _, w in drawn], n_ranges)))


def _targets(size: list[int], n_shards: int) -> list[tuple[int, int, int]]:
    """(range, bytes into it, shard) at which each shard but the first is due."""
    total, run, begins = sum(size), 0, []
    for s in size:
        begins.append(run)
        run += s
    due = [(total * shard // n_shards, shard) for shard in range(1, n_shards)]
    at = [bisect.bisect_right(begins, target) - 1 for target, _ in due]
    return [(r, target - begins[r], shard) for r, (target, shard) in zip(at, due, strict=True)]


def _cuts(wanted: list[tuple[int, int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("r"), F.lit(t).cast("long").alias("t"), F.lit(s).alias("s")) for r, t, s in wanted])


def _repeated(keys: DataFrame, bounds: list[tuple], size: list[int], n_shards: int) -> list[tuple]:
    """(h, g) of repeated rows that fill a range by themselves or among which a shard is due.

    Rows are summed by key before they are ordered, so a key in any number of rows is one row here;
    at most one key for each range and for each shard comes back.
    """
    mean, wanted = sum(size) / len(size), _targets(size, n_shards)
    some = sorted({r for r, _, _ in wanted} | {i for i, s in enumerate(size) if s > 2 * mean})
    order = Window.partitionBy("range").orderBy("h", "g").rowsBetween(Window.unboundedPreceding, 0)
    found = (_ranged(keys, bounds).filter(F.col("range").isin(some))
             .groupBy("range", "h", "g").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
             .withColumn("upto", F.sum("size").over(order)).filter("n > 1")
             .filter((F.col("size") > mean) | F.exists(_cuts(wanted), lambda c: (c["r"] == F.col("range"))
                     & (c["t"] > F.col("upto") - F.col("size")) & (c["t"] < F.col("upto")))))
    return sorted((r.h, r.g) for r in found.select("h", "g").collect())


def _shard_ends(keys: DataFrame, bounds: list[tuple], size: list[int], n_shards: int) -> list[tuple]:
    """First key of each shard but the first: where the running size passes its share of the total."""
    wanted = _targets(size, n_shards)
    inside = _ranged(keys, bounds).filter(F.col("range").isin(sorted({r for r, _, _ in wanted})))
    key_order = Window.partitionBy("range").orderBy(*KEY)
    order = key_order.rowsBetween(Window.unboundedPreceding, 0)
    # a shard begins with the first row whose middle lies behind its target, so with the one row whose
    # middle does while that of the row before does not
    ends = (inside.withColumn("upto", F.sum("size").over(order))
            .withColumn("before", F.coalesce(F.lag("size").over(key_order), F.lit(0)))
            .withColumn("cut", F.explode(F.filter(_cuts(wanted), lambda c: (c["r"] == F.col("range"))
                                                  & (c["t"] * 2 < F.col("upto") * 2 - F.col("size"))
                                                  & (c["t"] * 2 >= (F.col("upto") - F.col("size")) * 2 - F.col("before")))))
            .groupBy(F.col("cut.s").alias("s")).agg(F.min(F.struct(*KEY)).alias("k")).collect())
    found = {e["s"]: tuple(e["k"]) for e in ends}
    # a target behind the middle of its range's last row begins with the next range
    return [found.get(s, bounds[r] if r < len(bounds) else None) for r, _, s in wanted]


def shard_documents(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    seed: int = 17) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes + 8), ``shard`` (0 to ``n_shards``-1) and ``slot``.

    Shards differ by about one document's size; slots count 0, 1, ... without
    gaps in a shard, in key order.  A null text has no bytes (it sorts with the
    empty texts), a null id is a key like any other, repeated rows each take a slot
    and are cut like other rows where a shard ends among them, an empty table gives an empty result, and input
    columns named like an output are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    hashes = [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.xxhash64(F.col(id_col))]
    keys = materialize(docs.select(hashes[0].alias("h"), hashes[1].alias("g"), F.lit(0).cast("long").alias("c"),
                                   text_size(F.col(text_col)).alias("size")), "shard-keys")
    whole = keys.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    kept = own_columns(docs, ("size", "shard", "slot"))
    if not whole["n"]:
        none = F.lit(None)
        return docs.select(*kept, none.cast("long").alias("size"), none.cast("int").alias("shard"), none.cast("long").alias("slot"))
    n_ranges = min(MAX_RANGES, max(16 * n_shards, whole["size"] // RANGE_BYTES + 1))
    bounds, size = _splitters(keys, whole["size"], n_ranges, seed)
    sized = docs.select(*kept, text_size(F.col(text_col)).alias("size"), hashes[0].alias("__h"), hashes[1].alias("__g"))
    out = sized.withColumn("__c", F.lit(0).cast("long"))
    repeated = _repeated(keys, bounds, size, n_shards)
    if repeated:
        # numbers are given once and read back, so no later pass can see others
        theirs = among(sized, [F.col("__h"), F.col("__g")], repeated, "__cut").filter("__cut").drop("__cut")
        numbered = materialize(theirs.withColumn("__c", F.monotonically_increasing_id()), "shard-copies")
        out = (among(out, [F.col("__h"), F.col("__g")], repeated, "__cut").filter("not __cut").drop("__cut")
               .unionByName(numbered))
        keys = (among(keys, [F.col("h"), F.col("g")], repeated, "cut").filter("not cut").drop("cut")
                .unionByName(numbered.select(F.col("__h").alias("h"), F.col("__g").alias("g"), F.col("__c").alias("c"), "size")))
        bounds, size = _splitters(keys, whole["size"], n_ranges, seed)
    ends = _shard_ends(keys, bounds, size, n_shards)
    bounds = sorted({*bounds, *(e for e in ends if e is not None)})
    _, rows = _measure(keys, bounds)
    shards, bases, taken = [], [], {}
    for i in range(len(bounds) + 1):
        low = bounds[i - 1] if i else None
        shard = sum(1 for e in ends if e is not None and low is not None and low >= e)
        shards.append(shard)
        bases.append(taken.get(shard, 0))
        taken[shard] = bases[-1] + rows[i]
    out = with_range(out, [F.col("__h"), F.col("__g"), F.col("__c")], bounds, "__range")
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__h", "__g", "__c", id_col)) - 1
    return out.withColumn("__place", place).select(
        *kept, "size", F.get(F.lit(shards), F.col("__range")).cast("int").alias("shard"),
        (F.get(F.lit(bases), F.col("__range")) + F.col("__place")).cast("long").alias("slot"))
