"""Benchmark decontamination by spaced-seed hashing.

Texts are cut into tokens: lower-cased runs of letters and digits.  A seed is
a fixed mask laid over neighbouring tokens: it hashes the tokens at some places
and ignores those between, so that a replaced token there leaves the hash as it
is.  Every seed of every document is looked up among those of the benchmark; a
hit fixes how the item lies in the document.  The item is then compared along
that diagonal, token by token: the overlap counts if within some WINDOW
neighbouring tokens at least NEED agree.  The masks are chosen so that whatever
so counts has a hit by some mask.  Items shorter than SPAN are looked up whole,
by the hash of all their tokens.

Only DataFrame functions are used.  Of a document, nothing is moved but its
hits; texts are read again for documents that have any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import shared_dir, stored, table

#: Fixed masks, as the places of the pairs of neighbouring tokens that are hashed: 110110011, 1100011011, 1111011 and 111100011.
PAIRS = ((0, 3, 7), (0, 5, 8), (0, 2, 5), (0, 2, 7))
SPAN = max(p[-1] for p in PAIRS) + 2
#: Neighbouring tokens that are judged together, and how many of them must agree.
WINDOW, NEED = 12, 10
#: Benchmark seeds up to which they are sent to every executor (about 100 bytes each there); more are joined by shuffling.
MOST_SEEDS = 1_000_000
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Hashes of the tokens, in order; empty for null or empty text."""
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def _pairs(h: Column) -> Column:
    n = F.size(h) - 1
    return F.when(n > 0, F.zip_with(F.slice(h, 1, F.greatest(n, F.lit(1))), F.slice(h, 2, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<long>"))


def _placed(last: Column, seed) -> Column:
    """Array of (at, seed(at)) for places from 0 to last; empty where last is negative."""
    one = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(i.alias("at"), seed(i).alias("seed")))
    return F.when(last >= 0, one).otherwise(F.array().cast("array<struct<at: int, seed: bigint>>"))


def _seeds(pairs: Column, mask: tuple[int, ...], number: int) -> Column:
    return _placed(F.size(pairs) - 1 - mask[-1], lambda i: F.xxhash64(F.lit(number), *(F.get(pairs, i + p) for p in mask)))


def _wholes(h: Column, n: int) -> Column:
    """Seeds of all runs of n tokens; numbered apart from the masks."""
    return _placed(F.size(h) - n, lambda i: F.xxhash64(F.lit(len(PAIRS) + n), *(F.get(h, i + j) for j in range(n))))


def seeds(rows: DataFrame, keep: list[str], short: list[int]) -> DataFrame:
    """rows with the column h (token hashes) as (keep, at, seed): one row for each mask, and each length in `short`, and place."""
    paired = rows.select(*keep, "h", _pairs(F.col("h")).alias("p"))
    lists = F.concat(*(_seeds(F.col("p"), m, k) for k, m in enumerate(PAIRS)), *(_wholes(F.col("h"), n) for n in short))
    return paired.select(*keep, F.explode(lists).alias("s")).select(*keep, "s.at", "s.seed")


def overlaps(docs: DataFrame, benchmark: DataFrame, path: str, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(k, th, item, matched): rows of docs (by key and hash of text) with an overlap, and the most tokens that agree along one diagonal.

    Null and empty texts have no tokens.  Items of fewer than SPAN tokens must
    occur whole, token by token: so little agrees by chance.  Items between SPAN
    and WINDOW tokens are judged whole, at the same share.  A null key is kept as it is;
    rows equal in key and text are one document.
    """
    items = stored(benchmark.select(F.col(item).alias("item"), tokens(F.col(item_text)).alias("h")).where(F.size("h") > 0).distinct(), f"{path}/items")
    long, size = items.where(F.size("h") >= SPAN).select("item", "h"), F.size("h")
    short = sorted(r.n for r in items.where(size < SPAN).select(size.alias("n")).distinct().collect())
    wanted = seeds(long, ["item"], [])
    for n in short:
        wanted = wanted.unionByName(items.where(size == n).select("item", F.explode(_wholes(F.col("h"), n)).alias("s")).select("item", "s.at", "s.seed"))
    wanted = stored(wanted.distinct(), f"{path}/seeds")
    few = wanted.limit(MOST_SEEDS + 1).count() <= MOST_SEEDS
    wanted = wanted.select("item", F.col("at").alias("item_at"), "seed")
    base = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    own = seeds(base.select("k", "th", tokens(F.col("text")).alias("h")), ["k", "th"], short)
    hits = own.join(F.broadcast(wanted) if few else wanted, "seed")
    cases = stored(hits.select("k", "th", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), f"{path}/cases")

    keys = cases.select("k", "th").distinct()
    some = base.join(keys, base.k.eqNullSafe(keys.k) & (base.th == keys.th), "left_semi")
    hashed = some.select("k", "th", tokens(F.col("text")).alias("h"))
    where = cases.select(F.col("k").alias("ck"), F.col("th").alias("cth"), "item", "shift")
    laid = hashed.join(where, F.col("k").eqNullSafe(F.col("ck")) & (F.col("th") == F.col("cth"))).join(items.select(F.col("item").alias("i"), F.col("h").alias("ih")), F.col("item").eqNullSafe(F.col("i")))
    start = F.greatest(F.lit(0), F.col("shift"))
    skipped = F.greatest(F.lit(0), -F.col("shift"))
    length = F.least(F.size("h") - start, F.size("ih") - skipped)
    agree = F.zip_with(F.slice("h", start + 1, length), F.slice("ih", skipped + 1, length), lambda a, b: (a == b).cast("int"))
    lined = laid.select("k", "th", "item", F.size("ih").alias("n"), agree.alias("agree"))
    window = F.least(F.lit(WINDOW), F.col("n"))
    need = F.when(F.col("n") < SPAN, F.col("n")).otherwise(F.ceil(window * NEED / WINDOW))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("agree") - window + 1)), lambda i: F.aggregate(F.slice("agree", i, window), F.lit(0), lambda s, x: s + x)))
    judged = lined.select("k", "th", "item", F.aggregate("agree", F.lit(0), lambda s, x: s + x).alias("matched"), (best >= need).alias("found"))
    return judged.where("found").groupBy("k", "th", "item").agg(F.max("matched").alias("matched"))


def flagged(found: DataFrame) -> DataFrame:
    """One row for each document with an overlap: k, th, n_items, items (ids, comma-joined in order), matched (the most tokens)."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_set("item")), lambda i: i.cast("string")), ",")
    return found.groupBy("k", "th").agg(F.count_distinct("item").alias("n_items"), ids.alias("items"), F.max("matched").alias("matched"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shared_dir(spark))
    return flagged(found).select(F.col("k").alias("doc_id"), "n_items", "items", "matched")
