"""Boxes, points and raster pixels: grid-keyed joins with exact tests, overlay areas, zonal and focal statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators import overlays as ov
from cadastra.operators.overlays import BOX


def area(prefix: str = "") -> Column:
    a, b, c, d = (F.col(f"{prefix}{x}") for x in BOX)
    return (c - a) * (d - b)


def _boxes(df: DataFrame, side: str, *others: str) -> DataFrame:
    return df.select(*others, *(F.col(c).alias(f"{side}_{c}") for c in BOX))


def _common() -> Column:
    return (F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin")) * (F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin"))


def overlay(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float, how: str = "intersection", digits: int | None = None) -> DataFrame:
    """(left id, right id, area, iou) of pairs that intersect and don't merely touch; rounded to `digits`, once for equal boxes.

    Pairs meet in grid cells of their level (`overlays.meeting_places`): a box lies in a few cells however large it is, and equal
    ones meet once.  identity adds the left boxes that meet none, with their area and null iou.
    """
    fit = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    met = ov.meeting_places(ov.places(_boxes(left, "a", left_id), "a"), ov.places(_boxes(right, "b", right_id), "b"), size)
    inter = _common()
    measured = met.select("a__rows", "b__rows", fit(inter).alias("area"), fit(F.try_divide(inter, area("a_") + area("b_") - inter)).alias("iou"))
    pairs = ov.each(measured).select(left_id, right_id, "area", "iou")
    if how == "intersection":
        return pairs
    alone = left.join(met.select(*(F.col(f"a_{c}").alias(c) for c in BOX)).distinct(), list(BOX), "left_anti")
    nothing = F.lit(None).cast(right.schema[right_id].dataType)
    return pairs.unionByName(alone.select(left_id, nothing.alias(right_id), fit(area()).alias("area"), F.lit(None).cast("double").alias("iou")))


def covered_shares(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float, digits: int) -> DataFrame:
    """`shares` of each box of left by those of right, areas rounded to `digits`: equal boxes are met once, and no pair of rows is made."""
    a = _boxes(left, "a").distinct()
    b = _boxes(right, "b", right_id).groupBy(*(f"b_{c}" for c in BOX)).agg(F.min(right_id).alias("b_first"), F.count(F.lit(1)).alias("b_n"))
    pairs = ov.meeting_places(a, b, size).withColumn("area", F.round(_common(), digits))
    largest = F.min(F.struct((-F.col("area")).alias("a"), F.col("b_first").alias("r")))["r"]
    best = pairs.groupBy(*(F.col(f"a_{c}").alias(c) for c in BOX)).agg(F.sum(F.col("area") * F.col("b_n")).alias("covered"), largest.alias("dominant"))
    return left.select(left_id, *BOX).join(best, list(BOX), "left").select(left_id, F.coalesce(F.least(F.lit(1.0), F.try_divide(F.col("covered"), area())), F.lit(0.0)).alias("share"), "dominant")


def shares(pairs: DataFrame, entities: DataFrame, entity_id: str, reference_id: str) -> DataFrame:
    """(entity, share, dominant): covered share of the own area, at most 1, and the reference of the largest overlap, ties to the smaller id."""
    sums = pairs.groupBy(entity_id, reference_id).agg(F.sum("area").alias("area"))
    best = sums.groupBy(entity_id).agg(F.sum("area").alias("covered"), F.min_by(reference_id, F.struct((-F.col("area")).alias("a"), F.col(reference_id).alias("r"))).alias("dominant"))
    own = entities.select(entity_id, area().alias("own"))
    return own.join(best, entity_id, "left").select(entity_id, F.coalesce(F.least(F.lit(1.0), F.try_divide("covered", "own")), F.lit(0.0)).alias("share"), "dominant")


def points_in_boxes(points: DataFrame, boxes: DataFrame, point_id: str, box_id: str, size: float) -> DataFrame:
    """(point, box): the smallest box that holds the point, ties to the smaller id."""
    b = _boxes(boxes, "b", box_id).groupBy(*(f"b_{c}" for c in BOX)).agg(F.min(box_id).alias("b_id"))
    return ov.smallest_at(points, ov.at_points(ov.point_places(points), b, size), point_id, area("b_"), box_id)


def nearest(points: DataFrame, targets: DataFrame, point_id: str, target_id: str, reach: float) -> DataFrame:
    """(point, target, distance): the nearest target within reach, ties to the smaller id.

    Cells are as wide as the reach, so the nine around a target hold all points in question.  Points and targets of one place are met once.
    """
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    cell = lambda c: F.floor(F.col(c) / reach).cast("long")
    placed = points.select(point_id, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    a = placed.select("x", "y").dropna().distinct().select("x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    b = targets.groupBy(F.col("x").alias("tx"), F.col("y").alias("ty")).agg(F.min(target_id).alias("t")).select("*", cell("tx").alias("gx"), cell("ty").alias("gy"))
    b = b.select("*", around.alias("dx")).select("*", around.alias("dy")).select("tx", "ty", "t", (F.col("gx") + F.col("dx")).alias("cx"), (F.col("gy") + F.col("dy")).alias("cy"))
    d = F.sqrt(F.pow(F.col("x") - F.col("tx"), 2) + F.pow(F.col("y") - F.col("ty"), 2))
    close = ov.dealt(a, b, ["cx", "cy"], ["x", "y"], ["tx", "ty"]).withColumn("distance", d).where(F.col("distance") <= reach)
    best = close.groupBy("x", "y").agg(F.min(F.struct("distance", "t")).alias("m"))
    return placed.join(best, ["x", "y"]).groupBy(point_id).agg(F.min("m").alias("m")).select(point_id, F.col("m.t").alias(target_id), F.col("m.distance").alias("distance"))


def zonal(pixels: DataFrame, boxes: DataFrame, box_id: str, value: str, size: float) -> DataFrame:
    """Per box: number, mean, least and largest of the pixels whose centre (x, y) it holds, half-open.  Pixels of one place are added up first, equal boxes met once."""
    v = F.col(value)
    stated = pixels.where(v.isNotNull()).select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), value).dropna()
    sums = stated.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(v.cast("double")).alias("s"), F.min(v).alias("low"), F.max(v).alias("high"))
    met = ov.at_points(sums, _boxes(boxes, "b").distinct(), size).where((F.col("x") < F.col("b_xmax")) & (F.col("y") < F.col("b_ymax")))
    together = [F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")]
    of_box = met.groupBy(*(F.col(f"b_{c}").alias(c) for c in BOX)).agg(*together)
    found = boxes.select(box_id, *BOX).join(of_box, list(BOX)).groupBy(box_id).agg(*together)
    return found.select(box_id, "n", (F.col("s") / F.col("n")).alias("mean"), "low", "high")


def focal_coverage(pixels: DataFrame, radius: int, value: str, out: str) -> DataFrame:
    """Percent of 1 among the valid 0/1 pixels (row, col) within a circle of pixels, centre included; null without any.

    Every valid pixel is sent to the places it counts for and summed there, with partial sums before the shuffle.
    """
    offsets = [(r, c) for r in range(-radius, radius + 1) for c in range(-radius, radius + 1) if r * r + c * c <= radius * radius]
    near = F.explode(F.array(*(F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in offsets)))
    valid = pixels.where(F.col(value).isin(0, 1)).select("row", "col", value, near.alias("o"))
    sums = valid.groupBy((F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col")).agg((100.0 * F.sum(value) / F.count(F.lit(1))).alias(out))
    return pixels.select("row", "col").join(sums, ["row", "col"], "left")


def quadkey(lat: Column, lon: Column, zoom: int) -> Column:
    """Quadtree key of the map tile that holds a point."""
    n = float(2**zoom)
    s = F.sin(F.radians(F.greatest(F.lit(-85.05112878), F.least(F.lit(85.05112878), lat))))
    x = F.floor(F.least(F.lit(n - 1), F.greatest(F.lit(0.0), (lon + 180) / 360 * n))).cast("long")
    y = F.floor(F.least(F.lit(n - 1), F.greatest(F.lit(0.0), (0.5 - F.ln((1 + s) / (1 - s)) / (4 * 3.141592653589793)) * n))).cast("long")
    digits = [F.shiftright(x, k).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, k).bitwiseAND(F.lit(1)) for k in range(zoom - 1, -1, -1)]
    return F.concat(*(d.cast("string") for d in digits))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371008.8) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
