"""Quality by compression: dictionaries of good and of bad labelled text, and a calibrated score.

A text is compressed, in chunks, with a zstandard raw-content dictionary built
from texts labelled bad and with one from texts labelled good.  The difference
of the sizes, divided by the larger, says which kind it is more like.  Logistic
calibration turns it, with the compression ratios that say how much the
difference can mean, into the probability of label 1.  Dictionaries and calibration use
different halves of the sample, so that no text is measured against itself.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import sample
from cadastra.llm.arrow import score_texts
from cadastra.llm.common import remainder, table
from cadastra.llm.zdict import Dictionaries, logistic, sigmoid

#: Bound of the sample: labelled texts of each label and characters of each; bytes of each dictionary.
PER_LABEL, CHARS, DICT_BYTES = 1024, 8192, 110_000
THRESHOLD = 0.3


class QualityModel:
    def __init__(self, bad: list[str], good: list[str], n_bad: int, n_good: int):
        """n_bad, n_good: all training labels, for the share of good texts; texts alternate between the halves."""
        self.dictionaries = Dictionaries({"0": bad[::2], "1": good[::2]}, DICT_BYTES)
        x = [self.features(t) for t in (*bad[1::2], *good[1::2])]
        if not bad[1::2] or not good[1::2]:
            self.weights = [0.0] * 4 + [math.log((n_good + 1) / (n_bad + 1))]
            return
        y = np.array([0.0] * len(bad[1::2]) + [1.0] * len(good[1::2]))
        w = logistic(np.array(x), y)
        w[-1] += math.log(n_good / n_bad) - math.log(len(good[1::2]) / len(bad[1::2]))
        self.weights = [float(v) for v in w]

    def features(self, text: str) -> list[float]:
        raw = text.encode()
        bad, good = self.dictionaries.sizes(raw)
        n = max(1, len(raw))
        return [(bad - good) / max(1, bad, good), good / n, min(bad, good) / n, math.log(n)]

    def score(self, text: str) -> float:
        return sigmoid(sum(a * b for a, b in zip([*self.features(text), 1.0], self.weights, strict=True)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> QualityModel:
    """Fit on labels 0 and 1; with no usable label of one kind, the score is the share of label 1 (one added to each count)."""
    labels = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in labels.groupBy(label).count().collect()}
    picked = sample.chosen(labels, key, label, PER_LABEL)
    found = sample.texts(docs, picked, key, text, CHARS)
    bad, good = ([t for _, t in found.get(x, [])] for x in "01")
    return QualityModel(bad, good, counts.get(0, 0), counts.get(1, 0))


def score(docs: DataFrame, model: QualityModel, keep: list, text: str = "text") -> DataFrame:
    """The columns `keep` with score (0 to 1).  A null text counts as empty; repeated rows each get their score; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        return lambda t: (m.score(t),)

    return score_texts(docs, keep, text, "score double", make)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder("doc_id", 5) != 0))
    out = score(docs, model, [F.col("doc_id"), (remainder("doc_id", 5) == 0).alias("held_out")])
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
