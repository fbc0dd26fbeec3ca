"""Group context: shares, scores, ranks and thresholds of a row within its group, and filling gaps from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Accuracy of the sketch that encloses a median: its ranks are off by a part in SKETCH at most.
SKETCH = 4000


def share_of(df: DataFrame, by: str, matches: Column, out: str, least: int = 1, without_self: bool = False) -> DataFrame:
    """Share of the rows of the group that match; null below the least size and without a key."""
    hit = F.coalesce(matches, F.lit(False)).cast("int")
    sums = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("__n"), F.sum(hit).alias("__m"))
    joined = df.join(sums, by, "left")
    n, m = (F.col("__n") - 1, F.col("__m") - hit) if without_self else (F.col("__n"), F.col("__m"))
    return joined.withColumn(out, F.when((F.col("__n") >= least) & (n > 0), m / n)).drop("__n", "__m")


def zscore(df: DataFrame, by: str, value: Column, out: str) -> DataFrame:
    """Distance from the group's mean in population standard deviations; null where those are 0."""
    v = df.withColumn("__v", value)
    stats = v.groupBy(by).agg(F.avg("__v").alias("__mean"), F.nullif(F.stddev_pop("__v"), F.lit(0.0)).alias("__sd"))
    return v.join(stats, by, "left").withColumn(out, (F.col("__v") - F.col("__mean")) / F.col("__sd")).drop("__v", "__mean", "__sd")


def percentile(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """Average rank over the number of stated values.  Equal values are counted first, then ranked: groups are not sorted row by row."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(by).orderBy(value)
    below = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("__n").over(Window.partitionBy(by))
    ranks = counts.select(by, value, ((below - F.col("__n") + (F.col("__n") + 1) / 2) / total).alias(out))
    return df.join(ranks, [by, value], "left")


def median_of(df: DataFrame, value: str, out: str) -> DataFrame:
    """One row with the exact median of all stated values; null where there is none.

    A sketch gives two values that enclose it; what lies below them is counted, and only the values between them, a share of
    4 / SKETCH of the rows, are ranked in one place.  Where the sketch missed, that side is left open.
    """
    v = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    near = v.agg(F.percentile_approx("v", F.array(F.lit(0.5 - 2 / SKETCH), F.lit(0.5 + 2 / SKETCH)), F.lit(SKETCH)).alias("q")).select(F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    seen = v.join(F.broadcast(near)).agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("lo")).alias("below"), F.count_if(F.col("v") <= F.col("hi")).alias("upto"))
    i, j = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    low = F.col("below") <= i
    span = seen.select(i.alias("i"), j.alias("j"), F.when(low, F.col("lo")).alias("lo"), F.when(F.col("upto") > j, F.col("hi")).alias("hi"), F.when(low, F.col("below")).otherwise(0).alias("below"))
    within = v.join(F.broadcast(span)).where((F.col("lo").isNull() | (F.col("v") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") <= F.col("hi"))))
    counts = within.groupBy("v", "i", "j", "below").agg(F.count(F.lit(1)).alias("n"))
    upto = F.col("below") + F.sum("n").over(Window.orderBy("v"))
    ranked = counts.select("v", "i", "j", upto.alias("upto"))
    return ranked.agg((0.5 * F.min(F.when(F.col("upto") > F.col("i"), F.col("v"))) + 0.5 * F.min(F.when(F.col("upto") > F.col("j"), F.col("v")))).alias(out))


def cohort_threshold(df: DataFrame, by: str, value: str, floor: float, fraction: float, least: int, fallback: float, out: str) -> DataFrame:
    """Value over its group's threshold max(floor, fraction * mean); in groups of fewer than `least` the fallback is the threshold."""
    stats = df.groupBy(by).agg(F.avg(value).alias("__mean"), F.count(value).alias("__n"))
    limit = F.when(F.col("__n") >= least, F.greatest(F.lit(floor), F.col("__mean") * fraction)).otherwise(F.lit(fallback))
    return df.join(stats, by, "left").withColumn(out, F.col(value) / limit).drop("__mean", "__n")


def rank_in(df: DataFrame, by: str, value: str, row_id: str, out: str, qualifies: Column | None = None) -> DataFrame:
    """1 for the largest value; nulls last, ties by id; null for rows that don't qualify or have no group."""
    ok = F.col(by).isNotNull() & (F.lit(True) if qualifies is None else F.coalesce(qualifies, F.lit(False)))
    w = Window.partitionBy(by, ok).orderBy(F.col(value).desc_nulls_last(), F.col(row_id))
    return df.withColumn(out, F.when(ok, F.row_number().over(w)))


def impute(df: DataFrame, by: str, value: str, statistic: str, least: int = 1, marker: str = "imputed") -> DataFrame:
    """Gaps filled with the group's mean, median, least, largest, or smallest most frequent value; {value}_source says `imputed`."""
    stat = {"mean": F.avg(value), "median": F.median(value), "mode": F.mode(F.col(value), True), "min": F.min(value), "max": F.max(value)}[statistic]
    stats = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.when(F.count(value) >= least, stat).alias("__fill"))
    joined = df.join(stats, by, "left")
    filled = F.coalesce(F.col(value), F.col("__fill"))
    return joined.withColumn(f"{value}_source", F.when(F.col(value).isNull() & F.col("__fill").isNotNull(), F.lit(marker))).withColumn(value, filled).drop("__fill")


def value_map(columns: list[Column], mapping: dict[tuple, float], default: float | None, missing: float | None) -> Column:
    """Graded mapping of several columns; `missing` where one is null."""
    key = F.concat_ws("\u0001", *(c.cast("string") for c in columns))
    table = F.create_map(*(F.lit(x) for k, v in mapping.items() for x in ("\u0001".join(map(str, k)), v)))
    absent = columns[0].isNull()
    for c in columns[1:]:
        absent = absent | c.isNull()
    return F.when(absent, F.lit(missing)).otherwise(F.coalesce(F.try_element_at(table, key), F.lit(default)))


def minimum(*columns: Column) -> Column:
    """The least, null if any is null."""
    absent = columns[0].isNull()
    for c in columns[1:]:
        absent = absent | c.isNull()
    return F.when(~absent, F.least(*columns))


def impute_rate(df: DataFrame, value: str, size: str, tiers: list[tuple[str, list[str], int]], cap: float | None = None) -> DataFrame:
    """Gaps filled with size times the rate (sum of values over sum of sizes) of the first tier whose group has enough donors.

    tiers: (name, keys, least number of donors), finest first; cap: the most a filled value may be.  {value}_source has the tier's
    name.  Rates are one row for each group; rows that no tier reaches keep their gap.
    """
    donors = df.where(F.col(value).isNotNull() & (F.col(size) > 0))
    out, rates = df, []
    for k, (name, keys, least) in enumerate(tiers):
        rate = donors.groupBy(*keys).agg((F.sum(value) / F.sum(size)).alias(f"__rate{k}"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).drop("__n")
        out = out.join(rate, keys, "left")
        rates.append((name, F.col(f"__rate{k}")))
    filled = F.coalesce(*(r for _, r in rates)) * F.col(size)
    filled = F.least(filled, F.lit(cap)) if cap is not None else filled
    label = F.coalesce(*(F.when(r.isNotNull(), F.lit(name)) for name, r in rates))
    out = out.withColumn(f"{value}_source", F.when(F.col(value).isNull() & filled.isNotNull(), label))
    return out.withColumn(value, F.coalesce(F.col(value), filled)).drop(*(f"__rate{k}" for k in range(len(tiers))))
