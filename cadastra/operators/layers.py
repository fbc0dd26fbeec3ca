"""Yearly 0/1 layers of pixels, derived from one another.  Null is a pixel without observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def equals(band: Column, value) -> Column:
    """1 where the band has the value."""
    return (band == F.lit(value)).cast("int")


def but_not(a: Column, b: Column) -> Column:
    """1 where a is 1 and b isn't, an unobserved b included."""
    return F.when(a.isNotNull(), ((a == 1) & ~b.eqNullSafe(F.lit(1))).cast("int"))


def any_year(values: Column) -> Column:
    """Aggregate: 1 where any layer is 1, null only where all are."""
    return F.max(equals(values, 1))


def cover_less_loss(cover: Column, loss_year: Column, year: Column | int, offset: int = 2000) -> Column:
    """1 where the start's cover is 1 and no loss is stated up to the year; loss_year counts from offset, 0 or null is none."""
    lost = F.coalesce((loss_year > 0) & (loss_year <= F.lit(year) - offset), F.lit(False))
    return F.when(cover.isNotNull(), ((cover == 1) & ~lost).cast("int"))


def transitions(layers: DataFrame, pixel: Sequence[str], year: str, value: str, before, after, out: str) -> DataFrame:
    """1 where a pixel had `before` in the year before and has `after` now; null where either year is without observation."""
    own = Window.partitionBy(*pixel).orderBy(year)
    last = F.when(F.lag(year).over(own) == F.col(year) - 1, F.lag(value).over(own))
    both = last.isNotNull() & F.col(value).isNotNull()
    return layers.withColumn(out, F.when(both, ((last == F.lit(before)) & (F.col(value) == F.lit(after))).cast("int")))


def never_regained(layers: DataFrame, pixel: Sequence[str], year: str, value: str, out: str) -> DataFrame:
    """1 where a pixel is 1 and was so in every year since the first, or since the last year without observation.

    A year without a row is one without observation.  One row for each pixel
    and year; one shuffle by pixel.
    """
    own = Window.partitionBy(*pixel).orderBy(year)
    gap = F.col(value).isNull() | ~F.coalesce(F.lag(year).over(own) == F.col(year) - 1, F.lit(True))
    runs = layers.withColumn("__gap", gap.cast("int")).withColumn("__run", F.sum("__gap").over(own))
    within = Window.partitionBy(*pixel, "__run").orderBy(year)
    state = F.when(F.col(value).isNotNull(), F.min(equals(F.col(value), 1)).over(within))
    return runs.withColumn(out, state).drop("__gap", "__run")
