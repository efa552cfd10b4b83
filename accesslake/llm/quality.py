"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

A text's features are its distinct 1- and 2-grams of tokens (runs of letters
and digits, runs of marks; case kept), hashed into ``2**BITS`` cells with one
value 1/sqrt(count) each, plus a bias.  Training follows the regularised
leader one labelled text at a time; scoring is a sparse dot product per text.

The fit reads at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hash of their doc_id), so one task can hold their features and the weights
(``2**BITS`` floats) have a fixed size: they are the only thing broadcast.
Scoring covers every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of, tuned
from .words import MARKS, shingles, word_hashes

BITS = 18
TRAIN_ROWS = 16_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 8.0, 1.0, 0.001, 0.0
THRESHOLD = 0.3


def features(texts: pa.Array, bits: int = BITS):
    """Yields each text's sorted distinct feature cells (uint32); cell 0 is the bias."""
    starts, h = word_hashes(texts, MARKS, fold=False)
    pair_starts, pairs = shingles(starts, h, 2)
    one, two = (h >> np.uint64(64 - bits)).astype(np.uint32), (pairs >> np.uint64(64 - bits)).astype(np.uint32)
    zero = np.zeros(1, np.uint32)
    for i in range(len(starts) - 1):
        yield np.unique(np.concatenate([zero, one[starts[i]:starts[i + 1]], two[pair_starts[i]:pair_starts[i + 1]]]))


def ftrl(rows: list[tuple[np.ndarray, float]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes of per-coordinate FTRL-proximal updates over (cells, label)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for cells, label in rows:
            zi, ni, x = z[cells], n[cells], 1 / np.sqrt(len(cells))
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w.sum() * x, -35, 35))) - label) * x
            z[cells] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[cells] = ni + g * g
    return weights(z, n).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from ``labels`` (doc_id, label); rows with a null doc_id or label are left out.

    Repeated labels of one doc_id all count.  Without any labelled row the
    weights are zero (every score 0.5).
    """
    tuned(docs.sparkSession)
    sample = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["label"].cast("double").alias("label"))
              .where("doc_id is not null and label is not null")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows))

    def cells(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array([c.tobytes() for c in features(b.column("text"))], pa.binary())],
                names=["doc_id", "label", "cells"])

    def train(batches):
        rows = []
        for b in batches:
            rows += list(zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(), b.column("cells").to_pylist()))
        rows.sort(key=lambda r: (hash((r[0], 0x5BD1)), r[1], r[2]))
        w = ftrl([(np.frombuffer(c, np.uint32), y) for _, y, c in rows])
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["weights"])

    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    found = text.join(sample, "doc_id").mapInArrow(cells, "doc_id long, label double, cells binary")
    got = found.repartition(1).mapInArrow(train, "weights binary").collect()
    return np.frombuffer(got[0][0], np.float32) if got else np.zeros(1 << BITS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` and score: the probability of label 1 (a null text scores as the empty one)."""
    tuned(docs.sparkSession)
    bits, shared = len(weights).bit_length() - 1, docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for b in batches:
            dots = np.array([w[c].sum() / np.sqrt(len(c)) for c in features(b.column(b.num_columns - 1), bits)], np.float64)
            s = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())], names=[*b.schema.names[:-1], "score"])

    kept = docs.select(*(docs[c] for c in columns), text_of(docs).alias("_text"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def held_out(doc_id: F.Column) -> F.Column:
    """The fifth of the rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; fitted on the labelled rows outside the held-out fifth."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))
    out = score(docs, fit(docs, known))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
