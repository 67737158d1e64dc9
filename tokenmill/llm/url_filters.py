"""URL rules by a sort-merge range join on reversed-host keys.

``www.example.net`` becomes ``net.example.www.``, so a rule's host covers one
interval of the sorted keys.  Sampled splitters cut the key space, (reversed
host, path, row hash), into ranges of similar row counts; a host of any size is
cut between its paths and rows.  A rule goes to each range that its interval
meets.  In a range, sorted by key, one sweep keeps a stack of the nested rules
that are open; an address looks at that stack only, longest rule first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.ranges import with_range

ROWS_PER_RANGE = 20_000
MAX_RANGES = 4096
SAMPLES_PER_RANGE = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = "\U0010ffff"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of an address; both empty for a null or an address without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, F.lit("://")) + 3), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    path = F.substr(rest, F.length(host) + 1)
    return F.translate(host, UPPER, LOWER), path


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, stack = None, []  # stack: (reversed host, its rules)
        for pdf in batches:
            ranges, keys = pdf["range"].to_numpy(), pdf["rev"].to_numpy()
            kinds, paths = pdf["kind"].to_numpy(), pdf["path"].to_numpy()
            rules, actions = pdf["rule"].to_numpy(), pdf["verdict"].to_numpy()
            out_rule = np.full(len(pdf), None, object)
            out_verdict = np.full(len(pdf), default, object)
            new = np.ones(len(pdf), bool)
            new[1:] = (ranges[1:] != ranges[:-1]) | (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])
            edges = [*np.flatnonzero(new), len(pdf)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if ranges[begin] != at:
                    at, stack = ranges[begin], []
                while stack and not keys[begin].startswith(stack[-1][0]):
                    stack.pop()
                if kinds[begin] == 0:
                    own = list(zip(paths[begin:end], rules[begin:end], actions[begin:end], strict=True))
                    if stack and stack[-1][0] == keys[begin]:  # the host's rules go on from the batch before
                        own = stack.pop()[1] + own
                    stack.append((keys[begin], sorted(own, key=lambda r: (len(r[0]), r[0]))))
                    continue
                part = pd.Series(paths[begin:end])
                for _, own in stack:  # longer rules overwrite shorter ones
                    for path, rule, action in own:
                        fits = part.str.startswith(path).to_numpy(bool)
                        out_rule[begin:end][fits] = rule
                        out_verdict[begin:end][fits] = action
            urls = kinds == 1
            yield pd.DataFrame({"id": pdf["id"][urls], "host": pdf["host"][urls], "path": paths[urls],
                                "rule": out_rule[urls], "verdict": out_verdict[urls]})
    return run


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", seed: int = 5) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (host and path of the rule, or null), ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and
    all subdomains if the page's path begins with the rule's; of several the one
    with the longest host wins, then the longest path.  Pages without a rule get
    ``default``.  A null address, or one without ``://``, has an empty host and
    path.  Equal addresses get equal answers, repeated rows are all answered, an
    empty table gives none, and other columns are ignored.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = urls.select("id", host.alias("host"), path.alias("path"))
    urls = urls.withColumns({"rev": reversed_host(F.col("host")), "salt": F.xxhash64("id", "path")})
    rows = urls.count()
    n_ranges = min(MAX_RANGES, rows // ROWS_PER_RANGE + 1)
    share = min(1.0, n_ranges * SAMPLES_PER_RANGE / max(rows, 1))
    drawn = urls.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = sorted((r.rev, r.path, r.salt) for r in drawn.select("rev", "path", "salt").limit(4 * n_ranges * SAMPLES_PER_RANGE).collect()) \
        if n_ranges > 1 else []
    bounds = sorted({drawn[len(drawn) * i // n_ranges] for i in range(1, n_ranges)}) if drawn else []
    urls = with_range(urls, [F.col("rev"), F.col("path"), F.col("salt")], bounds, "range")
    least = F.lit(-(1 << 63))
    marks = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    marks = marks.withColumn("rev", reversed_host(F.col("host")))
    marks = with_range(marks, [F.col("rev"), F.lit(""), least], bounds, "first")
    marks = with_range(marks, [F.concat("rev", F.lit(TOP)), F.lit(""), least], bounds, "last")
    marks = marks.select("*", F.explode(F.sequence("first", "last")).alias("range"))
    events = urls.select("range", "rev", F.lit(1).alias("kind"), "path", "salt", "id", "host",
                         F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).unionByName(
        marks.select("range", "rev", F.lit(0).alias("kind"), "path", least.alias("salt"), F.lit(None).cast(kind).alias("id"), "host",
                     F.concat("host", "path").alias("rule"), "verdict"))
    swept = (events.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", "rev", "kind", "path", "salt")
             .mapInPandas(_sweep(default), f"id {kind}, host string, path string, rule string, verdict string"))
    return swept.withColumnRenamed("id", id_col)
