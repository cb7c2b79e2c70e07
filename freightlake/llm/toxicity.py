"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features of a text are the distinct hashes of its lower-cased words, of pairs of
neighbours, and of pairs with one and with two words between left out, each in
2^BITS places.  FTRL-proximal keeps for each place a rate of its own and an L1
threshold, below which its weight is exactly zero; what is left is a short list
of weights, broadcast for scoring (never more than 2^BITS).

The model is learned from a bounded sample of the labelled rows: the
``TRAIN_ROWS`` rows least by a hash of the id, with their whole texts.  Features are made in parallel; one task learns
from the sample (places of the features, at most 2^BITS for a text of any length), in the order of that hash.  Every row is scored on its whole
text.

Defined results: NULL or empty text has no features and scores the model's base
rate; NULL ids are never learned from and not held out; NULL labels are no
labels; without labels of both kinds every score is the share of label 1 (0
without labels); repeated rows are scored alike; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import id_text, python_workers, stage
from freightlake.llm.minhash import _mix

BITS = 20
TRAIN_ROWS, PASSES = 12_000, 4
WORD = re.compile(r"[^\W_]+")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, by folds; NULL ids have no fold."""
    return F.crc32(id_text(id_col)) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(order, label, text) of the ``rows`` labelled documents that are least by
    a hash of their id.  ``allowed`` selects ids that may be learned from."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & allowed)
             .groupBy(id_col).agg(F.max(label_col).cast("int").alias("__label")))
    texts = (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col), F.col(text_col).alias("__text")))
    order = F.xxhash64(F.lit("sample"), F.col(id_col))
    # ids first, then their texts: only the sample's texts are moved
    chosen = texts.select(id_col).join(known, id_col).distinct().withColumn("__order", order).orderBy("__order").limit(rows)
    chosen = stage(chosen, "sample-ids")
    return (texts.join(F.broadcast(chosen), id_col)  # at most ``rows`` ids
            .groupBy(F.col("__order").alias("order"), F.col("__label").alias("label"))  # one text of a repeated id
            .agg(F.min("__text").alias("text")))


class TextHashes(dict):
    """64-bit hash of each word; keeps a bounded number."""

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(self) < 500_000:
            self[word] = h
        return h


def features(text: str | None, hashes: TextHashes) -> np.ndarray:
    """Places of the text's n-grams and skip-grams, with repeats."""
    found = WORD.findall((text or "").lower())
    if not found:
        return np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    parts = [h]
    with np.errstate(over="ignore"):
        for gap in (1, 2, 3):
            if len(h) > gap:
                parts.append(_mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal for binary features."""

    def __init__(self, size: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step on distinct places."""
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def learn(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) that are not zero; place 2^BITS is the bias."""
    python_workers(sample.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TextHashes()
        for batch in batches:
            made = [np.unique(features(t, hashes)).astype(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array(made, pa.list_(pa.int32()))], names=["order", "label", "at"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = Ftrl((1 << BITS) + 1), []
        for batch in batches:
            at = batch.column("at")
            rows += [(x, np.append(at[k].values.to_numpy(), 1 << BITS)) for k, x in enumerate(batch.column("label").to_pylist())]
        if len({x for x, _ in rows}) < 2:
            rate = float(np.clip(np.mean([x for x, _ in rows]) if rows else 0.0, 1e-15, 1 - 1e-15))
            yield pa.RecordBatch.from_arrays([pa.array([1 << BITS], pa.int32()), pa.array([np.log(rate / (1 - rate))])], names=["at", "w"])
            return
        for _ in range(PASSES):
            for label, at in rows:
                model.learn(at, label)
        w = model.weights(np.arange(len(model.z)))
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(w[used])], names=["at", "w"])

    made = stage(sample.mapInArrow(make, "order long, label int, at array<int>"), "features")
    found = (made.repartition(1).sortWithinPartitions("order", "label")  # one task, TRAIN_ROWS rows
             .mapInArrow(fit, "at int, w double").collect())
    return np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``."""
    spark = docs.sparkSession
    python_workers(spark)
    sent = spark.sparkContext.broadcast(model)  # at most 2^BITS + 1 weights
    given = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = f"`{id_col}` {given.schema[0].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights = TextHashes(), np.zeros((1 << BITS) + 1)
        weights[sent.value[0]] = sent.value[1]
        used = weights != 0
        for batch in batches:
            out = np.empty(batch.num_rows)
            for k, text in enumerate(batch.column("__text").to_pylist()):
                at = features(text, hashes)
                out[k] = weights[np.unique(at[used[at]])].sum() + weights[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))], names=[id_col, "score"])

    return given.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, held: int = 2, cut: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score, predicted.  Rows of
    fold ``held`` are never learned from."""
    sample = labelled_sample(docs, labels, label_col, fold(id_col, folds) != held, TRAIN_ROWS, id_col, text_col)
    scored = score(docs, learn(sample), id_col, text_col)
    return scored.select(id_col, F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
