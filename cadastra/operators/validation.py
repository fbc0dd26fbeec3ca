"""Validation of predicted against reference classes and values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) over rows that state both."""
    return df.dropna(subset=[truth, predicted]).groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class: support, precision, recall and f1; null where undefined."""
    cells = confusion(df, truth, predicted)
    rows = cells.select(F.col(truth).alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("called"), F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0).alias("hit"))
    columns = cells.select(F.col(predicted).alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit"))
    sums = rows.unionByName(columns).groupBy("label").agg(F.sum("actual").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    p, r = F.try_divide("hit", "called"), F.try_divide("hit", "support")
    return sums.select("label", "support", p.alias("precision"), r.alias("recall"), F.try_divide(2 * F.col("hit"), F.col("support") + F.col("called")).alias("f1"))


def kappa(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: n, accuracy, expected agreement, Cohen's kappa."""
    cells = confusion(df, truth, predicted).withColumnsRenamed({truth: "t", predicted: "p"})
    rows = cells.groupBy(F.col("t").alias("c")).agg(F.sum("n").alias("rn"))
    columns = cells.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("cn"))
    expected = rows.join(columns, "c").agg(F.coalesce(F.sum(F.col("rn") * F.col("cn")), F.lit(0)).alias("e"))
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    both = total.join(F.broadcast(expected))
    po, pe = F.col("hit") / F.col("n"), F.col("e") / (F.col("n") * F.col("n"))
    return both.select("n", po.alias("accuracy"), pe.alias("expected"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


def mcnemar(df: DataFrame, truth: str, a: str, b: str) -> DataFrame:
    """One row: how often only a, and only b, is right, and the statistic with continuity correction."""
    right_a, right_b = F.col(a) == F.col(truth), F.col(b) == F.col(truth)
    counts = df.dropna(subset=[truth, a, b]).agg(F.count_if(right_a & ~right_b).alias("only_a"), F.count_if(~right_a & right_b).alias("only_b"))
    d = F.abs(F.col("only_a") - F.col("only_b")) - 1
    return counts.select("only_a", "only_b", F.try_divide((d * d).cast("double"), F.col("only_a") + F.col("only_b")).alias("statistic"))


def binned_error(df: DataFrame, key: str, width: int, truth: str, predicted: str) -> DataFrame:
    """Per bin of a numeric column: n, bias and mean absolute error."""
    bins = df.dropna(subset=[key, truth, predicted]).withColumn("bin", (F.floor(F.col(key) / width) * width).cast("long"))
    e = F.col(predicted) - F.col(truth)
    return bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"))


def cumulative_shares(df: DataFrame, by: str, year: str, part: str, whole: str) -> DataFrame:
    """(by, year, share): running sum of parts by year over the whole, at most 1."""
    yearly = df.groupBy(by, year).agg(F.sum(part).alias("__part"), F.max(whole).alias("__whole"))
    run = F.sum("__part").over(Window.partitionBy(by).orderBy(year).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return yearly.select(by, year, F.least(F.lit(1.0), F.try_divide(run, F.col("__whole"))).alias("share"))
