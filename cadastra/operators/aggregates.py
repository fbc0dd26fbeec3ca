"""Aggregations by group, as a registry of columns asks for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(c: str, order: Column) -> Column:
    """First stated value in an order: pandas-like `first`, which skips nulls, made independent of row order."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def reduce_column(c: str, how: str, order: Column) -> Column:
    """One column reduced: sum gives null where nothing is stated; agree gives a value only if all agree."""
    x = F.col(c)
    if how in ("sum", "min", "max", "mean"):
        return {"sum": F.sum, "min": F.min, "max": F.max, "mean": F.avg}[how](x)
    if how == "first":
        return first_by(c, order)
    if how == "last":
        return F.max_by(x, F.when(x.isNotNull(), order))
    if how == "agree":
        return F.when((F.min(x) == F.max(x)), F.min(x))
    if how == "count":
        return F.count(x)
    if how == "nunique":
        return F.count_distinct(x)
    if how == "mode":
        return F.mode(x, True)
    if how == "join_nonnull":
        pairs = F.array_sort(F.collect_list(F.when(x.isNotNull(), F.struct(order.alias("o"), x.cast("string").alias("v")))))
        return F.nullif(F.array_join(F.transform(pairs, lambda p: p["v"]), " + "), F.lit(""))
    if how == "distinct":
        # a value's copies are dropped as they come, and only its first place is kept at the end
        pairs = F.array_sort(F.collect_set(F.when(x.isNotNull(), F.struct(order.alias("o"), x.cast("string").alias("v")))))
        return F.nullif(F.array_join(F.array_distinct(F.transform(pairs, lambda p: p["v"])), " | "), F.lit(""))
    if how == "list":
        return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), x.alias("v")))), lambda p: p["v"])
    raise ValueError(f"unknown reduction: {how}")


def aggregate_rows(df: DataFrame, by: list[str], how: dict[str, str], order: Column, rename: dict[str, str] | None = None) -> DataFrame:
    """One row for each key; rows with a null in the key are dropped, columns without a rule are too."""
    named = rename or {}
    kept = df.dropna(subset=by)
    return kept.groupBy(*by).agg(*(reduce_column(c, h, order).alias(named.get(c, c)) for c, h in how.items()))


def weighted(c: str, weight: str, how: str) -> Column:
    """mean: over stated values, null where their weights add up to 0; sum: value times weight, 0 where nothing is stated."""
    v, w = F.col(c), F.col(weight)
    total = F.coalesce(F.sum(v * w), F.lit(0.0))
    if how == "sum":
        return total
    return F.try_divide(F.sum(v * w), F.nullif(F.sum(F.when(v.isNotNull(), w)), F.lit(0.0)))


def weighted_mode(df: DataFrame, by: str, value: str, weight: str, order: list[Column], out: str) -> DataFrame:
    """Adds to every row its group's value of the largest total weight; ties go to the value seen first.

    Weights below 0 and missing ones count 0; where all of a group are 0, its stated rows count 1 each.
    Sums are made for each key and value before anything is compared, so a hot key is one row for each of its values.
    """
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    stated = df.where(F.col(by).isNotNull() & F.col(value).isNotNull())
    sums = stated.groupBy(by, value).agg(F.sum(w).alias("__w"), F.count(F.lit(1)).alias("__n"), F.min(F.struct(*order)).alias("__o"))
    totals = sums.groupBy(by).agg(F.sum("__w").alias("__all"))
    weighed = sums.join(totals, by).withColumn("__rank", F.struct((-F.when(F.col("__all") > 0, F.col("__w")).otherwise(F.col("__n").cast("double"))).alias("w"), F.col("__o").alias("o")))
    best = weighed.groupBy(by).agg(F.min_by(value, "__rank").alias(out))
    return df.join(best, by, "left")


def unique_suffix(df: DataFrame, column: str, order: list[Column], out: str, first_too: bool = True, separator: str = "-") -> DataFrame:
    """Repeated values get -1, -2, ...; with first_too also the first of them, else the first stays bare and others count from 1."""
    w = Window.partitionBy(column)
    n, k = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order))
    number = k if first_too else k - 1
    return df.withColumn(out, F.when((n > 1) & (number > 0), F.concat(F.col(column).cast("string"), F.lit(separator), number)).otherwise(F.col(column).cast("string")))


def normal_id(c: Column) -> Column:
    """Upper case; runs of other characters than letters and digits become `-`; blank and all-zero ids are null."""
    t = F.regexp_replace(F.regexp_replace(F.upper(c.cast("string")), "[^A-Z0-9]+", "-"), "^-+|-+$", "")
    return F.when(~t.rlike("^[0-]*$"), t)


def require_unique(df: DataFrame, *key: str) -> DataFrame:
    """df itself; raises if a key repeats."""
    again = df.groupBy(*key).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"key {key} repeats: {again[0].asDict()}")
    return df


def distinct_join(df: DataFrame, by: list[str], column: str, order: Column, out: str, separator: str = " | ") -> DataFrame:
    """Distinct values of a column by key, joined in order of first appearance; repeated values are dropped before any list is made."""
    stated = df.where(F.col(column).isNotNull()).dropna(subset=by)
    once = stated.groupBy(*by, F.col(column).cast("string").alias("__v")).agg(F.min(order).alias("__o"))
    listed = F.array_sort(F.collect_list(F.struct("__o", "__v")))
    return once.groupBy(*by).agg(F.array_join(F.transform(listed, lambda p: p["__v"]), separator).alias(out))


def join_addresses(df: DataFrame, by: list[str], column: str, order: Column, out: str) -> DataFrame:
    """Addresses by key, joined by ' + ' in order; of those that differ in their unit or in case only, the first one."""
    from cadastra.functions.addresses import without_unit

    stated = df.where(F.trim(column) != "").dropna(subset=by)
    once = stated.groupBy(*by, F.lower(without_unit(F.col(column))).alias("__base")).agg(F.min(F.struct(order.alias("o"), F.col(column).alias("v"))).alias("__first"))
    return once.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("__first")), lambda p: p["v"]), " + ").alias(out))
