"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Byte n-grams (ASCII case folded) are hashed to a fixed number of features.  A
feature of a text is 0 where the n-gram is absent and else the logarithm of the
ratio of its smoothed document frequencies in the two labels; the vector is
scaled to length one.  A logistic regression, fitted by AdaGrad, weighs them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import sample
from cadastra.llm.arrow import score_texts
from cadastra.llm.common import remainder, table
from cadastra.llm.zdict import sigmoid

#: Bound of the sample: labelled texts of each label and characters of each.
PER_LABEL, CHARS = 2048, 16384
BITS, ORDERS, EPOCHS, RIDGE, STEP = 18, (3, 4, 5), 6, 1e-4, 0.3
THRESHOLD = 0.7
_MIX, _SPREAD = np.uint32(0x85EBCA6B), np.uint32(0x9E3779B1)


def _fold() -> np.ndarray:
    code = np.arange(256, dtype=np.uint32)
    code[65:91] += 32
    return (code + np.uint32(1)) * np.uint32(0xC2B2AE35)


class ToxicityModel:
    def __init__(self, clean: list[str], toxic: list[str], n_clean: int, n_toxic: int):
        """n_clean, n_toxic: all training labels, for the share of toxic texts."""
        self.fold = _fold()
        self.seen = np.zeros(1 << BITS, bool)
        self.bias = math.log((n_toxic + 1) / (n_clean + 1))
        self.square = self.value = np.zeros(1 << BITS)
        if not clean or not toxic:
            return
        y = np.array([0.0] * len(clean) + [1.0] * len(toxic))
        x = [self.present(t) for t in (*clean, *toxic)]
        count = np.ones((2, 1 << BITS))
        for p, label in zip(x, y, strict=True):
            count[int(label)][p] += 1
        ratio = np.log(count[1] / (len(toxic) + 2)) - np.log(count[0] / (len(clean) + 2))
        w, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
        b, b_squares = 0.0, 1e-6
        scaled = [ratio[p] / math.sqrt(max(1e-9, float((ratio[p] ** 2).sum()))) for p in x]
        for epoch in range(EPOCHS):
            for k in np.random.RandomState(epoch).permutation(len(x)):
                p, f = x[k], scaled[k]
                e = sigmoid(float(f @ w[p]) + b) - y[k]
                g = e * f + RIDGE * w[p]
                squares[p] += g * g
                w[p] -= STEP * g / np.sqrt(squares[p])
                b_squares += e * e
                b -= STEP * e / math.sqrt(b_squares)
        self.square, self.value = ratio * ratio, ratio * w
        # the sample is even where labels exceed its bound; the share of toxic texts is that of all training labels
        self.bias = b + math.log(n_toxic / n_clean) - math.log(len(toxic) / len(clean))

    def present(self, text: str) -> np.ndarray:
        """Distinct hashed n-grams of the whole text."""
        h = self.fold[np.frombuffer(b" %s " % text.encode(), np.uint8)]
        v = h
        for k in range(2, ORDERS[-1] + 1):
            if len(h) < 2:
                break
            h = h[:-1] * _MIX + v[k - 1 :]
            if k in ORDERS:
                self.seen[(h * _SPREAD) >> np.uint32(32 - BITS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found

    def score(self, text: str) -> float:
        p = self.present(text)
        return sigmoid(float(self.value[p].sum()) / math.sqrt(max(1e-9, float(self.square[p].sum()))) + self.bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Fit on labels 0 and 1; with no usable label of one kind, every score is the share of label 1 (one added to each count)."""
    labels = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in labels.groupBy(label).count().collect()}
    found = sample.texts(docs, sample.chosen(labels, key, label, PER_LABEL), key, text, CHARS)
    clean, toxic = ([t for _, t in found.get(x, [])] for x in "01")
    return ToxicityModel(clean, toxic, counts.get(0, 0), counts.get(1, 0))


def score(docs: DataFrame, model: ToxicityModel, keep: list, text: str = "text") -> DataFrame:
    """The columns `keep` with score (0 to 1).  A null text counts as empty; repeated rows each get their score; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        return lambda t: (m.score(t),)

    return score_texts(docs, keep, text, "score double", make)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder("doc_id", 3) != 1))
    out = score(docs, model, [F.col("doc_id"), (remainder("doc_id", 3) == 1).alias("held_out")])
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
