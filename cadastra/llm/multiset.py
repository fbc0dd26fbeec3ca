"""Document fingerprints by a homomorphic multiset hash.

A text is tiled into paragraphs: lines, cut further at sentence ends and after
PIECE_CHARS characters.  Each paragraph is hashed to a wide vector, and the
fingerprint is the sum of the vectors modulo 2^60 in each lane.  So it doesn't
depend on the order of paragraphs, two fingerprints add up to that of the two
texts together, and a paragraph is inserted or deleted by adding or
subtracting its vector, without the rest of the text.

Lanes: the number of paragraphs; WIDE lanes of 60-bit hashes, which settle
equality; NEAR lanes, each of three 20-bit fields that count in how many
paragraphs a hash bit is set.  The bits are random signs, so the inner product
of two signed field vectors estimates how many paragraphs two texts share.

Everything is a column expression: no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.llm.common import shared_dir, stored, table

PIECE_CHARS, WIDE, SIGN_HASHES, FIELD_BITS, FIELDS = 256, 6, 2, 20, 3
PIECE = rf"[^.!?\n]{{1,{PIECE_CHARS}}}[.!?\n]*|[.!?\n]+"
#: Stands for a null key: the least, so that it comes last in descending order.
NO_KEY = -(1 << 63)
LANE_BITS = FIELD_BITS * FIELDS
ALL, FIELD = (1 << LANE_BITS) - 1, (1 << FIELD_BITS) - 1
SPREAD = sum(1 << (FIELD_BITS * k) for k in range(FIELDS))
LANES = 1 + WIDE + SIGN_HASHES * FIELD_BITS


def paragraphs(text: Column) -> Column:
    """Array of the parts that tile the text; empty for null or empty text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))


def _hashes(parts: Column, seed: int) -> Column:
    return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))


def _total(hashes: str, shift: int, mask: int) -> Column:
    def step(total: Column, h: Column) -> Column:
        bits = F.shiftrightunsigned(h, shift) if shift else h
        return (total + bits.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(ALL))

    return F.aggregate(hashes, F.lit(0).cast("long"), step)


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the column `out`: array of LANES longs, the sum of the paragraphs' vectors.

    Paragraphs and hashes are columns of their own on the way, so that each is
    worked out once however many lanes read it.
    """
    keep = df.columns
    cut = df.withColumn("__parts", paragraphs(F.col(text)))
    seeds = range(WIDE + SIGN_HASHES)
    hashed = cut.select(*keep, F.size("__parts").cast("long").alias("__n"), *(_hashes(F.col("__parts"), k).alias(f"__h{k}") for k in seeds))
    lanes = [F.col("__n"), *(_total(f"__h{k}", 0, ALL) for k in seeds[:WIDE])]
    lanes += [_total(f"__h{k}", j, SPREAD) for k in seeds[WIDE:] for j in range(FIELD_BITS)]
    return hashed.select(*keep, F.array(*lanes).alias(out))


def add(a: Column, b: Column) -> Column:
    """Fingerprint vector of both multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(ALL)))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint vector of a without the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(ALL)))


def text_form(v: Column) -> Column:
    """The vector as fixed-width hexadecimal text."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), LANE_BITS // 4, "0")), "")


def _field(near: Column, n: Column, k: int) -> Column:
    return F.transform(near, lambda x: (F.shiftrightunsigned(x, FIELD_BITS * k).bitwiseAND(F.lit(FIELD)) * 2 - n).cast("double"))


def signed(v: Column) -> Column:
    """Sums of random signs, one for each field."""
    n = F.get(v, F.lit(0)).bitwiseAND(F.lit(FIELD))
    near = F.slice(v, 2 + WIDE, SIGN_HASHES * FIELD_BITS)
    return F.flatten(F.array(*(_field(near, n, k) for k in range(FIELDS))))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(v: Column, w: Column, v_signed: Column, w_signed: Column) -> Column:
    """Share of common paragraphs, 2 |A and B| / (|A| + |B|), as estimated from two fingerprints: 0 to 1, and 1 for equal ones."""
    both = _dot(v_signed, v_signed) + _dot(w_signed, w_signed)
    share = F.when(both > 0, F.lit(2.0) * _dot(v_signed, w_signed) / both).otherwise(0.0)
    return F.when(v == w, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `fp_vector` (array of long) and `fingerprint` (text); a null text counts as empty."""
    return with_vector(docs, text, "fp_vector").withColumn("fingerprint", text_form(F.col("fp_vector")))


def ranges(keys: DataFrame, parts: int) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """The least and the largest (k, h) of up to `parts` ranges of about as many keys each, in ascending order."""
    dealt = keys.select("k", "h").repartitionByRange(parts, "k", "h").groupBy(F.spark_partition_id().alias("range"))
    me = F.struct("k", "h")
    found = dealt.agg(F.min(me).alias("least"), F.max(me).alias("most")).collect()
    return sorted((tuple(r.least), tuple(r.most)) for r in found) or [((0, 0), (0, 0))]


def _pairs(of: list[tuple[int, int]]) -> Column:
    return F.array(*(F.struct(F.lit(k).cast("long").alias("k"), F.lit(h).cast("long").alias("h")) for k, h in of))


def with_range(base: DataFrame, cut: list[tuple[tuple[int, int], tuple[int, int]]]) -> DataFrame:
    """base, whose (k, h) are distinct, with the number of the range of each row and `lent`, false.

    The last row of each range comes once more, lent to the range after it
    (that of the last range to the first), where it stands before all others.
    """
    me, n = F.struct("k", "h"), len(cut)
    starts, step = [least for least, _ in cut[1:]], max(1, math.isqrt(n))
    # first among every step-th border, then among those between two of them
    large = F.size(F.filter(_pairs(starts[step - 1 :: step]), lambda x: x <= me)) if starts else F.lit(0)
    small = F.size(F.filter(F.slice(_pairs(starts), F.col("__large") * step + 1, step), lambda x: x <= me)) if starts else F.lit(0)
    placed = base.withColumn("__large", large).withColumn("range", F.col("__large") * step + small).drop("__large")
    own = F.struct(F.col("range"), F.lit(False).alias("lent"))
    end = F.get(_pairs([most for _, most in cut]), F.col("range"))
    more = F.struct(F.pmod(F.col("range") + 1, F.lit(n)).alias("range"), F.lit(True).alias("lent"))
    each = placed.select(*base.columns, F.explode(F.when(me == end, F.array(own, more)).otherwise(F.array(own))).alias("at"))
    return each.select("at.range", "at.lent", *base.columns)


def compare_with_edited(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness to each other and to the next document.

    The edited text has its last floor(n/2) code points replaced by the first
    as many of the next document in descending order of key; the last
    document's next is the first.  A null text is empty; null keys come last;
    rows that share a key are ordered by a hash of their text, and rows equal
    in both count as one document, each of them returned.  An empty table
    gives no rows.

    Keys alone are read first, to cut their order into ranges, as many as there
    are shuffle partitions.  Then texts are shuffled once, to their ranges; in a
    range, the next document is the row before, in ascending order.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(body).alias("h"), body.alias("text"))
    keys = stored(base.groupBy("k", "h").agg(F.count(F.lit(1)).alias("copies")), f"{path}/keys")
    copies = keys.where("copies > 1")
    repeated = not copies.isEmpty()
    if repeated:
        base = base.groupBy("k", "h").agg(F.max("text").alias("text"))
    cut = ranges(keys, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = with_range(base, cut).repartition("range").sortWithinPartitions("range", F.col("lent").desc(), "k", "h")
    own = with_vector(sorted_rows, "text", "v")
    w = Window.partitionBy("range").orderBy(F.col("lent").desc(), "k", "h")
    both = own.select("*", F.lag("text").over(w).alias("next"), F.lag("v").over(w).alias("next_v")).where(~F.col("lent"))
    n = F.length("text")
    kept = F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int"))
    given = F.substring("next", F.lit(1), F.floor(n / 2).cast("int"))
    edited = both.select("k", "h", n.cast("long").alias("n_chars"), "v", "next_v", F.concat(kept, given).alias("edited"))
    hashed = with_vector(edited, "edited", "edited_v")
    signs = hashed.select("k", "h", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "v", "next_v", "edited_v", signed(F.col("v")).alias("s"), signed(F.col("next_v")).alias("next_s"), signed(F.col("edited_v")).alias("edited_s"))
    c = F.col
    out = signs.select(
        "k",
        "h",
        F.nullif(c("k"), F.lit(NO_KEY)).alias(key),
        "n_chars",
        "edited_sha256",
        text_form(c("v")).alias("fingerprint"),
        text_form(c("edited_v")).alias("edited_fingerprint"),
        likeness(c("v"), c("edited_v"), c("s"), c("edited_s")).alias("near_edited"),
        likeness(c("v"), c("next_v"), c("s"), c("next_s")).alias("near_next"),
    )
    if repeated:
        times = copies.select("k", "h", F.sequence(F.lit(2), F.col("copies")).alias("more"))
        again = out.join(times, ["k", "h"]).withColumn("more", F.explode("more")).drop("more")
        out = out.unionByName(again)
    return out.drop("k", "h")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(table(spark, sf_dir, "documents"), shared_dir(spark))


