"""Fingerprints: equality, order, insertion and deletion, likeness; edited texts against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from cadastra.llm import multiset as ms


def test_homomorphism(spark):
    a, b = "One line.\nTwo lines!\n", "Three.\nFour?\n"
    rows = spark.createDataFrame([(a, b, a + b, b + a, "Two lines!\nOne line.\n")], "a string, b string, ab string, ba string, swapped string")
    for c in rows.columns:
        rows = ms.with_vector(rows, c, f"v_{c}")
    r = rows.select("v_ab", "v_ba", "v_a", "v_swapped", ms.add(F.col("v_a"), F.col("v_b")).alias("sum"), ms.subtract(F.col("v_ab"), F.col("v_b")).alias("rest")).first()
    assert r.v_ab == r.v_ba == r["sum"] and r.v_a == r.rest == r.v_swapped and r.v_a != r.v_ab


def test_edited_texts(spark, shared):
    texts = {1: "😀abc. def\nghi", 2: None, 3: "", 4: "x" * 70_000 + ".", 5: "same. text.", 6: "same. text.", None: "last one here"}
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, v string")
    rows = {r.doc_id: r for r in ms.compare_with_edited(docs, shared).collect()}
    order = [6, 5, 4, 3, 2, 1, None]
    for at, k in enumerate(order):
        own, after = texts[k] or "", texts[order[(at + 1) % len(order)]] or ""
        n = len(own)
        edited = own[: n - n // 2] + after[: n // 2]
        assert rows[k].n_chars == n and rows[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (rows[k].fingerprint == rows[k].edited_fingerprint) == (own == edited)
        assert 0 <= rows[k].near_edited <= 1 and 0 <= rows[k].near_next <= 1
    assert rows[6].fingerprint == rows[5].fingerprint and rows[6].near_next == 1 and rows[2].fingerprint == rows[3].fingerprint


def test_likeness_follows_shared_paragraphs(spark, shared):
    lines = [f"sentence number {i} of this text.\n" for i in range(200)]
    other = [f"something else {i}.\n" for i in range(200)]
    docs = spark.createDataFrame([(2, "".join(lines)), (1, "".join(lines[:150] + other[:50])), (0, "".join(other))], "doc_id long, text string")
    rows = {r.doc_id: r for r in ms.compare_with_edited(docs, shared).collect()}
    assert 0.55 < rows[2].near_next < 0.95 and rows[0].near_next < 0.3


def test_one_row_and_none(spark, shared):
    one = ms.compare_with_edited(spark.createDataFrame([(3, "abcd")], "doc_id long, text string"), f"{shared}/a").first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
    assert ms.compare_with_edited(spark.createDataFrame([], "doc_id long, text string"), f"{shared}/b").count() == 0


def plain_vector(text: str) -> list[int]:
    """Lane by lane, as the module's docstring says."""
    parts = re.findall(ms.PIECE, text)
    seeds = [xxhash.xxh64_intdigest(struct.pack("<i", k), seed=42) for k in range(ms.WIDE + ms.SIGN_HASHES)]
    hashes = [[xxhash.xxh64_intdigest(p.encode(), seed=s) for p in parts] for s in seeds]
    lanes = [len(parts), *(sum(h & ms.ALL for h in one) & ms.ALL for one in hashes[: ms.WIDE])]
    return lanes + [sum(h >> j & ms.SPREAD for h in one) & ms.ALL for one in hashes[ms.WIDE :] for j in range(ms.FIELD_BITS)]


def plain_likeness(v: list[int], w: list[int]) -> float:
    def signs(x):
        return [2 * (lane >> ms.FIELD_BITS * k & ms.FIELD) - x[0] for k in range(ms.FIELDS) for lane in x[1 + ms.WIDE :]]

    a, b = signs(v), signs(w)
    both = sum(x * x for x in a) + sum(x * x for x in b)
    return 1.0 if v == w else min(1.0, max(0.0, 2 * sum(x * y for x, y in zip(a, b, strict=True)) / both if both else 0.0))


@pytest.mark.parametrize("parts", ["1", "4", "23"])
def test_against_plain_version(spark, shared, parts):
    """Null and repeated keys, repeated rows, and more ranges than rows in some."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["One. ", "two!\n", "three ", "é?", "\n"]) for _ in range(rng.randrange(12))) for _ in range(40)]
    rows = [(rng.choice([None, None, *range(30)]), t) for t in texts] + [(7, "same. row."), (7, "same. row."), (7, "same. row."), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted(map(tuple, ms.compare_with_edited(docs, shared).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def hash_of(t):
        h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
        return h - (1 << 64) if h >> 63 else h

    order = sorted({(ms.NO_KEY if k is None else k, hash_of(t), t or "") for k, t in rows}, reverse=True)
    at = {x: i for i, x in enumerate(order)}
    want = []
    for k, t in rows:
        t = t or ""
        after = order[(at[ms.NO_KEY if k is None else k, hash_of(t), t] + 1) % len(order)][2]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        v, e, n = plain_vector(t), plain_vector(edited), plain_vector(after)
        form = ["".join(f"{x:015x}" for x in y) for y in (v, e)]
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), *form, plain_likeness(v, e), plain_likeness(v, n)))
    want.sort(key=repr)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for x, y in zip(got, want, strict=True):
        assert x[5:] == pytest.approx(y[5:])
