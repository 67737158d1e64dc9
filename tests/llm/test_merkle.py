import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_cases import CLASHES, SF_SMALL
from pyspark.sql import functions as F

from tokenmill.llm import merkle as M
from tokenmill.llm import queries as Q

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """All levels of a tree of fanout 8 up to a single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        at = i // 8 * 8
        yield level[at:i], level[i + 1:at + 8]
        i //= 8


def brute(rows):
    parts = defaultdict(list)
    for r in rows:
        parts[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: tree([leaf for *_, leaf, _ in sorted(parts[p], key=lambda x: x[:3])]) for p in names}
    top = tree([trees[p][-1][0] for p in names])
    out = []
    for no, p in enumerate(names):
        for i, (*_, leaf, r) in enumerate(sorted(parts[p], key=lambda x: x[:3])):
            proof = [*path(trees[p], i), *path(top, no)]
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf_of(r, text)
            for left, right in proof:
                node = h(*left, node, *right)
            out.append((r.doc_id, leaf, trees[p][-1][0], top[-1][0], h(*[x for left, right in proof for x in left + right]), node, node == top[-1][0]))
    return sorted(out, key=repr)


def made(spark, tmp_path, rows, block_levels):
    df = spark.createDataFrame(rows, SCHEMA)
    df.withColumns({c: F.lit("x") for c in CLASHES}).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, Q.op12_merkle_manifest(spark, str(tmp_path), block_levels).collect()), key=repr), df.collect()


def case(sizes):
    return [(1000 * p + i, f"Text {i % 7} of {lang}" * (i % 3), lang, f"s{i % 2}" if i % 5 else None, i if i % 4 else None)
            for p, (lang, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize(("sizes", "block_levels"), [
    ({"de": 700, "en": 65, None: 8, "fr": 1, "é": 9, "Z": 64, "": 513}, 1),  # ragged ends at every level
    ({f"l{i}": 1 + i * 7 % 30 for i in range(70)}, 1),  # a tree of three levels above the parts
    ({"en": 1300, "xx": 3}, 2),
    ({"en": 40}, 4),
    ({"en": 1}, 4),
])
def test_against_a_plain_tree(spark, tmp_path, sizes, block_levels):
    got, rows = made(spark, tmp_path, case(sizes), block_levels)
    assert got == brute(rows)


def test_nulls_ties_repeated_rows_and_long_texts(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "A", "en", "s", 1), (5, "", "en", None, 0), (5, None, "en", None, 0), (5, "", "en", None, 0),
            (3, "Ä B" * 200_000, "en", "s", 7), (0, "ABC", "fr", "s", 3), *[(9, "SAME", "en", "s", 4)] * 40]
    got, given = made(spark, tmp_path, rows, 1)
    assert got == brute(given)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_empty_table_gives_an_empty_manifest(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert M.merkle_manifest(docs).collect() == []


def test_messages_longer_than_a_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "MESSAGES_PER_ROW", 3)
    got, rows = made(spark, tmp_path, case({"en": 600, "fr": 2}), 1)
    assert got == brute(rows)


def test_proofs_fold_to_the_root_and_only_with_the_row_itself(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = M.merkle_manifest(docs, block_levels=1).withColumn("folded", M.fold(F.col("leaf"), F.col("proof"))).collect()
    assert len(rows) == docs.count() and all(r.folded == r.root and r.claim == r.leaf for r in rows)
    assert len({r.root for r in rows}) == 1
    changed = docs.withColumn("text", F.when(F.col("doc_id") == rows[0].doc_id, F.lit("other")).otherwise(F.col("text")))
    assert M.merkle_manifest(changed, block_levels=2).first().root != rows[0].root


def test_query_on_the_small_table(spark):
    rows = Q.op12_merkle_manifest(spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
