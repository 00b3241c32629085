"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learnt by
FTRL-proximal (per-coordinate rates, L1 sparsity); the few non-zero weights are broadcast."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import BITS, SAMPLE_ROWS, averaged, in_order, labelled_features, word_grams
from .texts import free_columns, q

#: Slot of the intercept, which carries no L1 penalty.
BIAS = 1 << BITS
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 8.0, 0.0, 6


@dataclass
class ToxicityModel:
    """Sparse weights: slots (sorted) and values, and the intercept. ``rows`` is the number
    of rows learnt from; with none every score is 0."""

    slots: np.ndarray
    values: np.ndarray
    bias: float
    rows: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.slots] = self.values
        return out


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def _ftrl(table: pa.Table) -> pa.Table:
    y, rows = in_order(table)
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(EPOCHS):
        for label, own in zip(y, rows, strict=True):
            own = np.append(own, BIAS)
            zi, ni = z[own], n[own]
            l1 = np.full(len(own), L1)
            l1[-1] = 0
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0, -(zi - np.sign(zi) * l1) / ((BETA + root) / ALPHA + L2))
            g = _sigmoid(float(w.sum())) - (1.0 if label else 0.0)
            z[own] += g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[own] += g * g
    l1 = np.full(BIAS + 1, L1)
    l1[BIAS] = 0
    w = np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    at = np.flatnonzero(w)
    return pa.table({"shard": pa.array(np.full(len(at), table.column("shard")[0].as_py(), np.int32)),
                     "slot": pa.array(at.astype(np.int32)), "weight": pa.array(w[at])})


def train_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", text_col: str = "text",
                   id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most about ``sample_rows`` labelled rows that are not held out: each of
    a few hash shards runs FTRL over its own rows, the weights are averaged."""
    rows = labelled_features(docs, labels, target, word_grams, text_col, id_col, sample_rows)
    parts = rows.groupBy("shard").applyInArrow(_ftrl, "shard int, slot int, weight double")
    weights = averaged(parts, BIAS + 1)
    at = np.flatnonzero(weights[:BIAS])
    return ToxicityModel(at, weights[at], float(weights[BIAS]), int(weights.any()))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", carry: list[str] | None = None,
                   out: str = "score") -> DataFrame:
    """``carry`` (default: all columns) and ``out``, the probability of label 1 (0 to 1).

    Every row gets a score; an empty or null text has only the intercept's. Without any
    labelled row the score is 0. The whole text counts, whatever its length."""
    kept = free_columns(docs, [out]) if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast((model.dense(), model.bias, model.rows))

    @F.arrow_udf("double")  # only texts go to Python, only scores come back
    def score(texts: pa.Array) -> pa.Array:
        weights, bias, rows = shared.value
        each = texts.cast(pa.binary()) if rows else []
        return pa.array([_sigmoid(bias + float(weights[word_grams(x.as_py())].sum())) for x in each] or [0.0] * len(texts), pa.float64())

    return docs.select(*[q(c) for c in kept], score(q(text_col).cast("string")).alias(out))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               threshold: float = 0.5, model: ToxicityModel | None = None) -> DataFrame:
    """``docs`` (its columns) without the rows that score ``threshold`` or more."""
    model = model or train_toxicity(docs, labels, text_col=text_col, id_col=id_col)
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index(text_col)
    kept = score_toxicity(plain, model, f"__c{at}", out="__score").filter(F.col("__score") < threshold)
    return kept.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
