"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text, computed in one pass: densities of three lexicons
(words, and beginnings of four and five letters, that the labelled texts show to
be toxic), the share of lexicon words near a second-person word, hits that only
appear once look-alike characters are undone, and rates of capitals,
punctuation, marks inside words and drawn-out letters.

The labelled rows are split by id: three quarters give the lexicons and the
trees, the rest the calibration.  All are fitted on at most ``max_train`` rows,
a seeded sample; scoring runs over every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import words as W
from tokenmill.llm.frames import own_columns, schema_with
from tokenmill.llm.toxicity_features import FEATURES, KINDS, Lexicon, entry_keys, features
from tokenmill.session import freeing, materialize

MAX_TRAIN = 30_000
LEXICON_ENTRIES = 2_000
LEAST_TOXIC = 4  # labelled toxic texts in which an entry must occur
SLICE_BYTES = 1 << 20


def _with_features(lexicon: Lexicon, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                x = features(part.column(part.schema.get_field_index("text")), lexicon)
                offsets = pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in carried), lists],
                                                 names=[*carried, "features"])
    return run


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either label in which an entry occurs, per slice."""
    for batch in batches:
        for part in W.slices(batch, "text", 8 << 20):
            w = W.words(part.column(part.schema.get_field_index("text")), W.NON_WORD)
            toxic = part.column(part.schema.get_field_index("label")).to_numpy(zero_copy_only=False) > 0
            for k, keys in enumerate(entry_keys(w).values()):
                pairs = np.lexsort((keys, w.owner()))
                key, owner = keys[pairs], w.owner()[pairs]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                new &= key != 0
                distinct, each = np.unique(key[new], return_inverse=True)
                bad = np.bincount(each, weights=toxic[owner[new]], minlength=len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), k, np.int32)), pa.array(distinct.view(np.int64)), pa.array(bad),
                     pa.array(np.bincount(each, minlength=len(distinct)) - bad)], names=["kind", "key", "toxic", "clean"])


def _learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> Lexicon:
    counts = rows.select("text", "label").mapInArrow(freeing(_entry_counts), "kind int, key long, toxic long, clean long") \
        .groupBy("kind", "key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = counts.filter(F.col("toxic") >= LEAST_TOXIC).withColumn("odds", odds).filter("odds > 1.5")
    found: dict[str, np.ndarray] = {}
    for k, kind in enumerate(KINDS):
        top = best.filter(F.col("kind") == k).orderBy(F.desc("odds"), F.desc("toxic"), "key").limit(LEXICON_ENTRIES).collect()
        found[kind] = np.sort(np.array([r.key for r in top], np.int64).view(np.uint64))
    return Lexicon(found)


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   folds: int = 5, max_train: int = MAX_TRAIN, seed: int = 11) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 if the score is 0.5 or more).

    Labels are learned from rows whose crc32(id as text) modulo ``folds`` is not
    0; the id decides the fold and nothing else.  Null labels are skipped, an id
    labelled more than once counts as toxic if any label does.  Null and empty
    texts are scored as texts without words; repeated rows get equal scores;
    with no label, or labels of one kind only, every score is the smoothed share
    of toxic labels; an empty table gives no rows.
    """
    scored = _scored(docs, labels, id_col, text_col, label_col, folds, max_train, seed, [])
    return scored.withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
               folds: int = 5, max_train: int = MAX_TRAIN, seed: int = 11) -> DataFrame:
    """The documents that :func:`score_toxicity` does not reject, all columns kept."""
    scored = _scored(docs, labels, id_col, text_col, label_col, folds, max_train, seed, own_columns(docs))
    return scored.filter("predicted = 0").select("row.*")


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, max_train: int, seed: int,
            carried: list[Column]) -> DataFrame:
    from pyspark.ml.classification import GBTClassifier  # here, so that Python workers need not load them
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter("label is not null and id is not null")
    given = given.filter(crc_fold(F.col("id"), folds) != 0).groupBy("id").agg(F.max(F.col("label").cast("double")).alias("label"))
    given = materialize(given, "toxic-labels")
    share = min(1.0, max_train / max(given.count(), 1))
    sample = given.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = source.join(F.broadcast(sample), "id")  # max_train ids
    rows = materialize(rows.withColumn("calibrate", F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(4)) == 0), "toxic-train")
    share_of = {(r.calibrate, r.label > 0): r["count"] for r in rows.groupBy("calibrate", F.col("label").alias("label")).count().collect()}
    bad, good = share_of.get((False, True), 0), share_of.get((False, False), 0)
    lexicon = _learn_lexicon(rows.filter("not calibrate"), bad, good)
    base = (bad + 1) / (bad + good + 2)
    if carried:
        source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*carried).alias("row"))
    with_row = ["row"] if carried else []
    schema = schema_with(source, "id", "id", "features array<double>")
    if carried:
        schema = T.StructType([schema["id"], T.StructField("row", source.schema["row"].dataType), schema["features"]])
    scored = source.mapInArrow(freeing(_with_features(lexicon, ["id", *with_row])), schema)
    if not bad or not good:
        score = F.lit(base)
    else:
        train = rows.mapInArrow(freeing(_with_features(lexicon, ["label", "calibrate"])), "label double, calibrate boolean, features array<double>")
        train = materialize(train, "toxic-features").withColumn("features", array_to_vector("features"))
        fit = train.filter("not calibrate").withColumn("weight", F.when(F.col("label") > 0, good / bad).otherwise(1.0))
        trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=seed, weightCol="weight", cacheNodeIds=False).fit(fit)
        scored = trees.transform(scored.withColumn("features", array_to_vector("features")))
        scored = scored.select("id", *with_row, vector_to_array("probability")[1].alias("raw"))
        held = trees.transform(train.filter("calibrate")).select("label", vector_to_array("probability")[1].alias("raw"))
        if share_of.get((True, True), 0) and share_of.get((True, False), 0):
            curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(held)
            scored = curve.transform(scored)
            # the raw score keeps its order inside a step of the curve
            score = F.lit(0.98) * F.col("calibrated") + F.lit(0.02) * F.col("raw")
        else:
            score = F.col("raw")
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
    return scored.select("id", *with_row, (crc_fold(F.col("id"), folds) == 0).alias("held_out"),
                         score.cast("double").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
