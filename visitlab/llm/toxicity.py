"""Toxicity score: FTRL-proximal logistic regression over hashed word n-grams
and skip-grams.

Features of a text are the distinct hashes of its words, word pairs, and pairs
with one or two words between them, in ``DIM`` slots. Training walks over a
bounded sample of labelled texts in a fixed random order with per-coordinate
learning rates; the L1 term keeps a coordinate at exactly zero until its
gradients outweigh the noise, so the model is a short list of (slot, weight)
pairs with at most ``DIM`` entries: small enough to broadcast at any data size.

Defined results: a null or empty text has no features and scores the bias; a
null label takes no part in training; repeated documents count as often as they
occur; without both classes among the labels the model is the base rate (0.5
without any label). Whole texts are read in training and in scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import tokens
from .common import keeps, lean, materialize

#: Feature slots. The model has at most so many weights.
DIM = 1 << 20
#: Most labelled documents that training reads: those with the smallest hash.
SAMPLE = 10_000
EPOCHS, ALPHA, BETA, L2 = 4, 0.3, 1.0, 0.5
#: L1 in units of the standard deviation of a pure-noise gradient sum.
L1_NOISE = 0.5
#: Word places that make up one feature.
GRAMS = ((0,), (0, 1), (0, 2), (0, 3))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, slot) of every gram of every text; repeats included."""
    words, _ = tokens.alnum_words(texts)
    docs, slots = [], []
    for salt, places in enumerate(GRAMS):
        h, at = tokens.windows(words.hash, words.doc, places, salt)
        docs.append(words.doc[at])
        slots.append((h & np.uint64(DIM - 1)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(slots)


def fit(examples: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, alpha: float = ALPHA,
        noise: float = L1_NOISE) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over examples given as arrays of distinct slots: slots with
    a weight, their weights, the bias."""
    n_rows, positive = len(labels), sum(labels)
    if not 0 < positive < n_rows:
        rate = (positive + 0.5) / (n_rows + 1)
        return np.empty(0, np.int64), np.empty(0), float(np.log(rate / (1 - rate)))
    rate = positive / n_rows
    l1 = noise * np.sqrt(n_rows * rate * (1 - rate))
    z, n = np.zeros(DIM), np.zeros(DIM)
    bias, bias_n = float(np.log(rate / (1 - rate))), 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((BETA + np.sqrt(ni)) / alpha + L2))

    for _ in range(epochs):
        for slots, y in zip(examples, labels, strict=True):
            zi, ni = z[slots], n[slots]
            w = weights(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35)))
            g = p - y
            root = np.sqrt(ni + g * g)
            z[slots] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[slots] = ni + g * g
            bias_n += g * g
            bias -= alpha * g / (BETA + np.sqrt(bias_n))
    w = weights(z, n)
    kept = np.flatnonzero(w)
    return kept, w[kept], bias


@lean()
def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples, labels = [], []
    for batch in batches:
        texts, y = tokens.texts_of(batch["text"]), batch["toxic"].to_pylist()
        for lo, hi in tokens.chunks(texts):
            doc, slot = features(texts[lo:hi])
            pairs = np.unique(doc * DIM + slot)
            cut = np.searchsorted(pairs, np.arange(hi - lo + 1) * DIM)
            slots = (pairs & (DIM - 1)).astype(np.int32)
            examples += [slots[cut[i]:cut[i + 1]] for i in range(hi - lo)]
        labels += y
    slots, weights, bias = fit(examples, labels)
    yield pa.RecordBatch.from_pydict({"slot": pa.array([-1, *slots.tolist()], pa.int64()),
                                      "weight": pa.array([bias, *weights.tolist()], pa.float64())})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Model table (slot, weight); slot -1 is the bias.

    ``labels`` (doc_id, toxic 0/1) are the rows that training may use; of them
    the ``sample`` with the smallest hash of doc_id do."""
    order = F.xxhash64("doc_id", F.lit(8))
    chosen = (labels.where("doc_id is not null and toxic in (0, 1)")
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(order, "doc_id").limit(sample))
    # at most `sample` rows of two numbers: a proven bound for the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one task: FTRL is sequential; at most `sample` documents reach it
    ordered = rows.select("text", "toxic", order.alias("o"), "doc_id").repartition(1).sortWithinPartitions("o", "doc_id")
    return materialize(ordered.mapInArrow(_train, "slot long, weight double"), "toxicity-model")


def _weights(model: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    rows = model.toPandas()  # at most DIM + 1 rows of two numbers
    bias = float(rows.loc[rows["slot"] == -1, "weight"].sum())
    rows = rows[rows["slot"] >= 0]
    return rows["slot"].to_numpy(), rows["weight"].to_numpy(), bias


_DENSE: dict[int, np.ndarray] = {}


def score(texts: list[bytes], slots: np.ndarray, values: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    key = hash((slots.tobytes(), values.tobytes()))
    if key not in _DENSE:
        _DENSE.clear()
        keeps("toxicity", _DENSE.clear)
        _DENSE[key] = np.zeros(DIM)
        _DENSE[key][slots] = values
    dense = _DENSE[key]
    total = np.full(len(texts), bias)
    for lo, hi in tokens.chunks(texts):
        doc, slot = features(texts[lo:hi])
        used = np.flatnonzero(dense[slot])
        pairs = np.unique(doc[used] * DIM + slot[used])
        total[lo:hi] += np.bincount(pairs >> 20, dense[pairs & (DIM - 1)], hi - lo)
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score_table(docs: DataFrame, model: DataFrame, column: str = "score") -> DataFrame:
    """``docs`` with a score column of its text. A column of that name is replaced."""
    of = docs.sparkSession.sparkContext.broadcast(_weights(model))
    base = docs.drop(column)
    schema = StructType([*base.schema.fields, StructField(column, DoubleType())])

    @lean("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(column, pa.array(score(tokens.texts_of(batch["text"]), *of.value), pa.float64()))

    return base.mapInArrow(run, schema)
