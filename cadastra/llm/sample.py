"""Bounded, repeatable samples of labelled texts for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that a sample has at most: with many labels, each has fewer and shorter texts.
MOST_CHARS = 64 << 20


def bounds(labels: int, per_label: int, chars: int) -> tuple[int, int]:
    """Texts of each label, and characters of each, that a sample of so many labels takes."""
    share = max(1, MOST_CHARS // max(1, labels))
    fewer = max(1, min(per_label, share // chars))
    return fewer, min(chars, max(1, share // fewer))


def chosen(keys: DataFrame, key: str, label: str, per_label: int) -> list[tuple[str, int]]:
    """(label, hash) of up to per_label keys of each label.

    Keys are dealt to per_label slots by their hash and the smallest hash of
    each slot is taken: one aggregation with map-side combining, whatever
    share of the rows a label has.  Null keys and labels are left out.
    """
    h = F.xxhash64(F.col(key))
    rows = (
        keys.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .select(F.col(label).cast("string").alias("label"), h.alias("h"), F.pmod(h, F.lit(per_label)).alias("slot"))
        .groupBy("label", "slot")
        .agg(F.min("h").alias("h"))
        .select("label", "h")
        .collect()
    )
    return sorted((r.label, r.h) for r in rows)


def texts(docs: DataFrame, picked: list[tuple[str, int]], key: str, text: str, chars: int, label: str | None = None) -> dict[str, list[tuple[int, str]]]:
    """Label: (hash, piece of text) in order of hash, for the chosen keys.

    A piece is at most `chars` characters of a fitting text, from a place that
    its hash chooses; the whole sample is bounded by the number of chosen keys times that.  Of rows that repeat a
    key, the one with the smallest text serves.
    """
    spark = docs.sparkSession
    out: dict[str, list[tuple[int, str]]] = {x: [] for x, _ in picked}
    if not picked:
        return out
    want = spark.createDataFrame(picked, "label string, h long")
    place = F.pmod(F.xxhash64(F.col(text)), F.greatest(F.lit(1), F.length(text) - chars + 1)).cast("int") + 1
    have = docs.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(key)).alias("h"), F.substring(F.col(text), place, F.lit(chars)).alias("piece"), *([F.col(label).cast("string").alias("label")] if label else []))
    rows = have.join(F.broadcast(want), ["label", "h"] if label else ["h"]).groupBy("label", "h").agg(F.min("piece").alias("piece")).collect()
    for r in sorted(rows, key=lambda r: (r.label, r.h)):
        out[r.label].append((r.h, r.piece))
    return out
