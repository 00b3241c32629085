"""Quality: ordinal cumulative-link regression on graded ratings. One weight vector over
hashed text, shared by all grades, and ordered thresholds between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import BITS, SAMPLE_ROWS, averaged, in_order, labelled_features, scored, style_grams
from .texts import free_columns

ALPHA, BETA, L1, EPOCHS = 1.0, 1.0, 8.0, 8
#: Rate of the thresholds; power of a grade's rarity in the weight of its rows.
RATE, BALANCE = 0.3, 0.5
ADDED = ("expected_grade", "tail_probability", "grade")


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - f(text)), f the sum of the weights of the
    text's slots. L1 leaves most weights 0, so that the few words and habits that tell a
    grade are not drowned by the many that tell nothing."""

    weights: np.ndarray
    thresholds: np.ndarray

    def cumulative(self, slots: np.ndarray) -> np.ndarray:
        return _sigmoid(self.thresholds - float(self.weights[slots].sum()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def gradient(thresholds: np.ndarray, f: float, grade: int) -> tuple[float, np.ndarray]:
    """Of -log P(grade), by f and by each threshold."""
    # P(y = k) = s[k + 1] - s[k] with s of the two thresholds around k
    s = np.concatenate(([0.0], _sigmoid(thresholds - f), [1.0]))
    p = max(s[grade + 1] - s[grade], 1e-9)
    d = s * (1 - s)
    by_t = np.zeros(len(thresholds))
    if grade < len(thresholds):
        by_t[grade] -= d[grade + 1] / p
    if grade > 0:
        by_t[grade - 1] += d[grade] / p
    return (d[grade + 1] - d[grade]) / p, by_t


def _fit(grades: int):
    def run(table: pa.Table) -> pa.Table:
        y, rows = in_order(table)
        size = 1 << BITS
        z, n = np.zeros(size), np.zeros(size)
        # start where the share of grades up to k puts each threshold
        share = np.clip([(y <= k).mean() for k in range(grades - 1)], 0.01, 0.99)
        t = np.log(share / (1 - share))
        t2 = np.ones(grades - 1)
        count = np.maximum(np.bincount(y, minlength=grades), 1)
        weight = (len(y) / (grades * count)) ** BALANCE

        def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
            return np.where(np.abs(zi) <= L1, 0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA))

        for _ in range(EPOCHS):
            for grade, own in zip(y, rows, strict=True):
                zi, ni = z[own], n[own]
                w = weights(zi, ni)
                g, dt = gradient(t, float(w.sum()), grade)
                g, dt = weight[grade] * g, np.clip(weight[grade] * dt, -2, 2)
                z[own] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
                n[own] += g * g
                t2 += dt * dt
                t = np.maximum.accumulate(t - RATE * dt / np.sqrt(t2))  # thresholds stay ordered
        w = weights(z, n)
        at = np.flatnonzero(w)
        slots = np.concatenate((at, size + np.arange(grades - 1))).astype(np.int32)
        return pa.table({"shard": pa.array(np.full(len(slots), table.column("shard")[0].as_py(), np.int32)),
                         "slot": pa.array(slots), "weight": pa.array(np.concatenate((w[at], t)))})

    return run


def train_quality(docs: DataFrame, ratings: DataFrame, target: str, grades: int, text_col: str = "text",
                  id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Learn grades 0 .. ``grades`` - 1 from at most about ``sample_rows`` rated rows that
    are not held out; hash shards learn side by side, their parameters are averaged. A mean
    of ordered thresholds is ordered. Without rated rows all weights are 0 and the
    thresholds even."""
    rows = labelled_features(docs, ratings, target, style_grams, text_col, id_col, sample_rows)
    rows = rows.filter((F.col("y") >= 0) & (F.col("y") < grades))
    parts = rows.groupBy("shard").applyInArrow(_fit(grades), "shard int, slot int, weight double")
    all_weights = averaged(parts, (1 << BITS) + grades - 1)
    weights, thresholds = all_weights[: 1 << BITS], all_weights[1 << BITS:]
    if not all_weights.any():
        thresholds = np.arange(grades - 1) - (grades - 2) / 2
    return OrdinalModel(weights.astype(np.float32), thresholds)


def score_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", carry: Sequence[str] | None = None,
                  min_grade: int = 1) -> DataFrame:
    """``carry`` (default: all columns) with ``expected_grade``, ``tail_probability``
    (of grade ``min_grade`` or better) and ``grade`` (the likeliest), for every row; an
    empty or null text is scored by what emptiness says."""
    kept = free_columns(docs, ADDED) if carry is None else list(carry)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def score(slots: np.ndarray) -> tuple[float, float, float]:
        below = OrdinalModel(*shared.value).cumulative(slots)
        each = np.diff(np.concatenate(([0.0], below, [1.0])))
        tail = 1.0 - (below[min_grade - 1] if min_grade else 0.0)
        return float((each * np.arange(len(each))).sum()), float(tail), float(each.argmax())

    out = scored(docs, kept, text_col, ["expected_grade", "tail_probability", "__grade"], score, style_grams)
    return out.withColumn("grade", F.col("__grade").cast("int")).drop("__grade")


def graded(quality: Column, toxic: Column) -> Column:
    """Three grades from the two binary labels: 0 poor, 1 good text with toxic content,
    2 good and clean; null without a quality label."""
    return F.when(quality == 0, 0).when((quality == 1) & (F.coalesce(toxic, F.lit(0)) == 1), 1).when(quality == 1, 2)
