"""License notices in documents: MinHash bands over overlapping windows, then exact containment.

Templates are put into classes by length; a class has windows of a power of two
words, at least one and a half times the template, that overlap by three
quarters, so every copy of a template lies whole in some window.  A window that
holds ``containment`` of a template has at least a known Jaccard similarity with
it; the number of bands (of one row each) is chosen so that such a window
collides with the template in some band with the probability ``recall``.  Every
colliding pair is verified on the exact sets of five-word shingles.

Minima of short blocks are merged into those of longer windows, so all window
lengths together cost about twice the shortest.  The windows lie on a grid over
the concatenated texts; verification tells the documents of a window apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import words as W
from tokenmill.llm.frames import schema_with
from tokenmill.session import materialize

SHINGLE = 5
SLICE_BYTES = 4 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Public license texts and the notices by which files refer to them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


@dataclass
class Template:
    license_id: str
    words: int
    shingle: int  # words of a shingle: five, or all of a shorter template
    shingles: np.ndarray  # sorted distinct hashes
    window: int


def _template(license_id: str, text: str | None) -> Template | None:
    w = W.words(pa.array([text], pa.string()), W.NON_WORD)
    n = len(w.hashes)
    if not n:
        return None
    k = min(SHINGLE, n)
    h, whole = W.sequence_hashes(w.hashes, w.bounds, k)
    window = 8
    while window * 2 < 3 * n:
        window *= 2
    return Template(license_id, n, k, np.unique(h[whole]), window)


def bands_for(templates: list[Template], containment: float, recall: float) -> int:
    """Bands of one row such that a window with enough of a template collides with probability ``recall``."""
    least = 1.0
    for t in templates:
        shared = math.ceil(containment * len(t.shingles))
        least = min(least, shared / (len(t.shingles) + t.window - shared))
    return math.ceil(math.log(1 - recall) / math.log(1 - least)) if templates and least < 1 else 1


def _candidates(h: np.ndarray, templates: list[Template], factors: np.ndarray) -> list[tuple[int, int]]:
    """(template, first word of window) of all windows that collide with a template in some band."""
    out = set()
    wanted = {t.window for t in templates}
    for factor in factors:
        blocks = h * factor
        blocks[h == EMPTY] = EMPTY
        stride = 1
        while stride * 4 <= max(wanted):
            if stride * 4 in wanted:  # windows of four blocks, one block apart
                mine = [(i, t) for i, t in enumerate(templates) if t.window == stride * 4]
                padded = np.concatenate([np.full(3, EMPTY), blocks, np.full(3, EMPTY)])
                low = np.minimum(np.minimum(padded[:-3], padded[1:-2]), np.minimum(padded[2:-1], padded[3:]))
                for i, t in mine:
                    out.update((i, int(b - 3) * stride) for b in np.flatnonzero(low == (t.shingles * factor).min()))
            if len(blocks) % 2:
                blocks = np.append(blocks, EMPTY)
            blocks = np.minimum(blocks[::2], blocks[1::2])
            stride *= 2
    return sorted(out)


def scan_words(w: W.Words, templates: list[Template], factors: np.ndarray, containment: float) -> list[tuple]:
    """(text, template, containment, first word, words) of the best match of each template in each text."""
    best: dict[tuple[int, int], tuple] = {}
    owner = w.owner()
    for k in sorted({t.shingle for t in templates}):
        mine = [i for i, t in enumerate(templates) if t.shingle == k]
        h, whole = W.sequence_hashes(w.hashes, w.bounds, k)
        h = h.copy()
        h[~whole] = EMPTY
        for j, at in _candidates(h, [templates[i] for i in mine], factors):
            t = templates[mine[j]]
            begin, end = max(at, 0), min(at + t.window, len(h))
            here = np.flatnonzero(np.isin(h[begin:end], t.shingles)) + begin
            for text in np.unique(owner[here]).tolist():
                own = here[owner[here] == text]
                share = len(np.unique(h[own])) / len(t.shingles)
                first, last = int(own[0]), int(own[-1]) + k
                found = (share, -(first - int(w.bounds[text])), last - first)
                if share >= containment and found > best.get((text, mine[j]), (0.0,)):
                    best[text, mine[j]] = found
    return [(text, i, share, -first, n) for (text, i), (share, first, n) in sorted(best.items())]


def _scan(templates: list[Template], containment: float, recall: float, seed: int):
    bands = bands_for(templates, containment, recall)
    factors = np.random.default_rng(seed).integers(1, 1 << 62, bands, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                found = scan_words(W.words(part.column(1), W.NON_WORD), templates, factors, containment)
                ids = part.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([templates[f[1]].license_id for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()),
                     pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                    names=["id", "license_id", "containment", "first_word", "n_words"])
    return run


def scan_licenses(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  containment: float = 0.8, recall: float = 0.999999, seed: int = 3) -> DataFrame:
    """One row per document and template found: id, ``license_id``, ``containment``, ``first_word``, ``n_words``.

    ``templates`` has ``license_id`` and ``text``; several texts may share an id
    and are reported one by one.  A template is found where a window holds at
    least ``containment`` of its distinct five-word shingles (a shorter template
    is one shingle); of several places the fullest, then the first, is given.
    Null and empty texts hold nothing, null or wordless templates match nothing,
    repeated rows are answered one by one, other columns are ignored.  Templates
    are broadcast in slices of bounded size.
    """
    spark = docs.sparkSession
    if templates is None:
        parts = [TEMPLATES]
    else:
        side = templates.select("license_id", "text").filter("text is not null")
        n = (side.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE_BYTES + 1
        side = materialize(side.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(n))), "templates") if n > 1 else side.withColumn("part", F.lit(0))
        parts = [[(r.license_id, r.text) for r in side.filter(F.col("part") == i).collect()] for i in range(n)]
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = schema_with(docs, id_col, "id", "license_id string, containment double, first_word long, n_words long")
    out = []
    for part in parts:
        ready = [t for t in (_template(*p) for p in part) if t is not None]
        if ready:
            out.append(source.mapInArrow(_scan(ready, containment, recall, seed), schema))
    found = reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)
    return found.withColumnRenamed("id", id_col)
