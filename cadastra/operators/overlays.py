"""Joins of boxes and shapes by place, with a bounded number of grid cells for each, and what follows from their overlaps.

A box belongs to the level whose cells are as wide as it or wider, so it lies
in four of them at most, however large it is.  Two boxes meet in the cells of
the wider one's level, into which the other is lifted; so no small box is
multiplied because others are large.

Equal places are met once, however many rows lie there, and the rows of a cell
go in blocks, each against each of the other side; so neither towers of rows
on one lot nor a few crowded cells end up in a few tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import shapes as sh

BOX = ("xmin", "ymin", "xmax", "ymax")
#: Pixels along the side of a tile that is laid over zones at once.
TILE = 64
#: Rows of a block of a cell; rows of equal places that are held in one.
BLOCK, ALIKE = 4096, 1024


def _levels(df: DataFrame, side: str, unit: float) -> DataFrame:
    width = F.greatest(F.col(f"{side}_xmax") - F.col(f"{side}_xmin"), F.col(f"{side}_ymax") - F.col(f"{side}_ymin"))
    return df.withColumn(f"{side}_level", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(width / unit, F.lit(1.0))))).cast("int"))


def _celled(df: DataFrame, side: str, unit: float, level: Column) -> DataFrame:
    """A row for each cell of the level that a box touches."""
    cell = F.lit(unit) * F.pow(F.lit(2.0), F.col("level"))

    def span(axis: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(f"{side}_{axis}min") / cell).cast("long"), F.floor(F.col(f"{side}_{axis}max") / cell).cast("long")))

    return df.withColumn("level", level).where("level is not null").withColumn("cx", span("x")).withColumn("cy", span("y"))


def tasks(df: DataFrame) -> int:
    """Number of tasks for what takes long for its few bytes, which Spark would put together by size."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def dealt(a: DataFrame, b: DataFrame, on: list[str], of_a: list[str], of_b: list[str]) -> DataFrame:
    """a and b joined by equal keys, in blocks of BLOCK rows of a key, each against each of the other side; of: what tells a side's rows apart."""

    def weight(df: DataFrame, side: str) -> Column:
        return F.sum(F.size(f"{side}__rows") if f"{side}__rows" in df.columns else F.lit(1))

    cells = a.groupBy(*on).agg(weight(a, "a").alias("__na")).join(b.groupBy(*on).agg(weight(b, "b").alias("__nb")), on)
    cells = cells.select(*on, *(F.ceil(F.col(f"__n{s}") / BLOCK).cast("long").alias(f"__n{s}") for s in "ab"))
    n, every = tasks(a), [*on, "__a", "__b"]

    def blocks(df: DataFrame, of: list[str], own: str, other: str) -> DataFrame:
        placed = df.join(cells, on).withColumn(f"__{own}", F.pmod(F.xxhash64(*of), F.col(f"__n{own}"))).withColumn(f"__{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"__n{other}") - 1)))
        return placed.drop("__na", "__nb").repartition(n, *every)

    return blocks(a, of_a, "a", "b").join(blocks(b, of_b, "b", "a"), every).drop("__a", "__b")


def places(df: DataFrame, side: str) -> DataFrame:
    """A row for each place, which are the columns named a_... (b_...), with the other columns of the rows that lie there, ALIKE of them at most."""
    own = [c for c in df.columns if c.startswith(f"{side}_")]
    alike = df.groupBy(*own).agg(F.collect_list(F.struct(*(c for c in df.columns if c not in own))).alias("__all"))
    parts = F.transform(F.sequence(F.lit(1), F.size("__all"), F.lit(ALIKE)), lambda i: F.slice("__all", i, F.lit(ALIKE)))
    return alike.select(*own, F.posexplode(parts).alias(f"{side}__part", f"{side}__rows"))


def each(pairs: DataFrame) -> DataFrame:
    """A row for each row of the places of a pair, whose columns come after those of the pair."""
    for side in ("a", "b"):
        if f"{side}__rows" in pairs.columns:
            pairs = pairs.select(*(c for c in pairs.columns if not c.startswith(f"{side}__")), F.inline(f"{side}__rows"))
    return pairs


def _levels_of(df: DataFrame, side: str) -> list[int]:
    return sorted(r[0] for r in df.select(f"{side}_level").distinct().collect())


def meeting_places(left: DataFrame, right: DataFrame, unit: float) -> DataFrame:
    """All pairs of places (`places`, or other rows that differ) whose boxes have area in common; unit: width of the least cells.

    The levels that occur, a few dozen numbers, are collected.  Rows without a box meet nothing.
    """
    a = _levels(left.dropna(subset=[f"a_{c}" for c in BOX]), "a", unit)
    b = _levels(right.dropna(subset=[f"b_{c}" for c in BOX]), "b", unit)
    of_a, of_b = _levels_of(a, "a"), _levels_of(b, "b")
    x0, y0 = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    cell = F.lit(unit) * F.pow(F.lit(2.0), F.col("level"))
    # the cell of the intersection's lower left corner alone reports a pair
    met = (x0 < F.least("a_xmax", "b_xmax")) & (y0 < F.least("a_ymax", "b_ymax")) & (F.floor(x0 / cell) == F.col("cx")) & (F.floor(y0 / cell) == F.col("cy"))

    def lifted(side: str, to: list[int], strictly: bool) -> Column:
        own = F.col(f"{side}_level")
        return F.explode(F.filter(F.array(*map(F.lit, to)).cast("array<int>"), lambda x: x > own if strictly else x >= own))

    def join(p: DataFrame, q: DataFrame) -> DataFrame:
        return dealt(p, q, ["level", "cx", "cy"], [c for c in left.columns if c != "a__rows"], [c for c in right.columns if c != "b__rows"]).where(met)

    wide_a = join(_celled(a, "a", unit, F.col("a_level")), _celled(b, "b", unit, lifted("b", of_a, False)))
    wide_b = join(_celled(a, "a", unit, lifted("a", of_b, True)), _celled(b, "b", unit, F.col("b_level")))
    return wide_a.unionByName(wide_b).drop("level", "cx", "cy", "a_level", "b_level")


def meeting(left: DataFrame, right: DataFrame, unit: float) -> DataFrame:
    """All pairs of rows whose boxes (a_xmin .. a_ymax, b_xmin .. b_ymax) have area in common.

    What follows from the places alone, the columns named a_... and b_..., is better worked out between `meeting_places` and `each`.
    """
    return each(meeting_places(places(left, "a"), places(right, "b"), unit))


def with_box(df: DataFrame, shape: str, side: str) -> DataFrame:
    b = sh.bounds(F.col(shape))
    return df.withColumn("__b", b).select("*", *(F.col("__b")[c].alias(f"{side}_{c}") for c in BOX)).drop("__b")


def overlay_shapes(left: DataFrame, right: DataFrame, left_id: str, right_id: str, unit: float, shape: str = "shape", how: str = "intersection", digits: int | None = None) -> DataFrame:
    """(left id, right id, area, iou, share): pairs of shapes that have area in common; share is that of the left shape.

    identity adds, for each left shape, a row without right id for what no right shape covers, where that is more than a
    millionth of it, with null iou; right shapes are taken not to overlap each other there.  Measures are rounded to `digits`, once
    for equal shapes.
    """
    a, b = _shapes(left, left_id, left_id, shape, "a"), _shapes(right, right_id, right_id, shape, "b")
    met = _overlaps_of(a, b, unit).where("o.both > 0")
    fit = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    iou = F.try_divide(F.col("o.both"), F.col("o.first") + F.col("o.second") - F.col("o.both"))
    measured = met.withColumns({"area": fit(F.col("o.both")), "iou": fit(iou), "share": fit(F.try_divide("o.both", "o.first"))})
    pairs = each(measured.select("a__rows", "b__rows", "area", "iou", "share")).select(left_id, right_id, "area", "iou", "share")
    if how == "intersection":
        return pairs
    covered = met.groupBy(F.col("a_shape").alias("__shape")).agg((F.sum(F.col("o.both") * F.size("b__rows") * F.size("a__rows"))).alias("covered"))
    own = left.select(left_id, F.col(shape).alias("__shape"), sh.area(F.col(shape)).alias("own"))
    n = own.groupBy("__shape").agg(F.count(F.lit(1)).alias("__n"))
    rest = own.join(covered.join(n, "__shape").select("__shape", (F.col("covered") / F.col("__n")).alias("covered")), "__shape", "left").withColumn("area", F.col("own") - F.coalesce("covered", F.lit(0.0)))
    rest = rest.where(F.col("area") > 1e-6 * F.col("own"))
    nothing = F.lit(None).cast(right.schema[right_id].dataType)
    return pairs.unionByName(rest.select(left_id, nothing.alias(right_id), fit(F.col("area")).alias("area"), F.lit(None).cast("double").alias("iou"), fit(F.col("area") / F.col("own")).alias("share")))


def _shapes(df: DataFrame, key: str, name: str, shape: str, side: str) -> DataFrame:
    """The places of a table of shapes."""
    return places(with_box(df.select(F.col(key).alias(name), F.col(shape).alias(f"{side}_shape")), f"{side}_shape", side), side)


def _overlaps_of(a: DataFrame, b: DataFrame, unit: float) -> DataFrame:
    """Pairs of places of shapes whose boxes meet, with their areas as o (first, second, both)."""
    return meeting_places(a, b, unit).withColumn("o", sh.overlap_areas("a_shape", "b_shape"))


def overlapping(df: DataFrame, key: str, unit: float, least: float = 1.0, shape: str = "shape") -> DataFrame:
    """(first, second, area, iou, of_smaller) of the rows of one table that overlap by `least` at least; first < second."""
    met = _overlaps_of(_shapes(df, key, "first", shape, "a"), _shapes(df, key, "second", shape, "b"), unit).where(F.col("o.both") >= least)
    union = F.col("o.first") + F.col("o.second") - F.col("o.both")
    of_smaller = F.try_divide("o.both", F.least("o.first", "o.second"))
    return each(met.select("a__rows", "b__rows", F.col("o.both").alias("area"), F.try_divide("o.both", union).alias("iou"), of_smaller.alias("of_smaller"))).where("first < second").select("first", "second", "area", "iou", "of_smaller")


def without_overlaps(df: DataFrame, key: str, unit: float, ratio: float = 0.5, shape: str = "shape") -> DataFrame:
    """df without the smaller (then the later) of each two rows of which one covers more than `ratio` of the smaller.

    A row goes if it loses to any row, whether or not that one loses to another.  Equal shapes are compared as one, of which
    the first key decides: all of a shape lose to a larger one, and those behind the first key of one of their size to that.
    """
    keyed = df.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(shape).alias("__shape"))
    alike = keyed.groupBy("__shape").agg(F.min("__key").alias("__first")).withColumn("__size", sh.area(F.col("__shape")))
    a, b = (with_box(alike.select(F.col("__shape").alias(f"{s}_shape"), F.col("__first").alias(f"{s}_first"), F.col("__size").alias(f"{s}_size")), f"{s}_shape", s) for s in "ab")
    won = _overlaps_of(a, b, unit).where(F.try_divide("o.both", F.least("o.first", "o.second")) > ratio)
    verdict = won.groupBy(F.col("a_shape").alias("__shape")).agg(F.max(F.col("a_size") < F.col("b_size")).alias("__all"), F.min(F.when(F.col("a_size") == F.col("b_size"), F.col("b_first"))).alias("__least"))
    lost = keyed.join(verdict, "__shape").where(F.col("__all") | (F.col("__key") > F.col("__least"))).select(F.col("__key").alias(key)).distinct()
    return df.join(lost, key, "left_anti")


def points_in_shapes(points: DataFrame, zones: DataFrame, point_id: str, zone_id: str, unit: float, shape: str = "shape") -> DataFrame:
    """(point, zone): the smallest shape that holds the point, ties to the smaller id."""
    shapes = zones.groupBy(F.col(shape).alias("b_shape")).agg(F.min(zone_id).alias("b_id")).withColumn("b_size", sh.area(F.col("b_shape")))
    inside = at_points(point_places(points), with_box(shapes, "b_shape", "b"), unit).where(sh.held("b_shape", "x", "y"))
    return smallest_at(points, inside, point_id, F.col("b_size"), zone_id)


def point_places(points: DataFrame) -> DataFrame:
    """The places (x, y) at which points lie."""
    return points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).dropna().distinct()


def at_points(points: DataFrame, boxes: DataFrame, unit: float) -> DataFrame:
    """Pairs of a row of points (x, y, ...), which differ in their place, and a row of boxes (b_xmin .. b_ymax, ...) that holds it, edges included."""
    b = _levels(boxes.dropna(subset=[f"b_{c}" for c in BOX]), "b", unit)
    a = points.select("*", *(F.col(c[0]).alias(f"a_{c}") for c in BOX))
    level = F.explode(F.array(*map(F.lit, _levels_of(b, "b"))).cast("array<int>"))
    held = F.col("x").between(F.col("b_xmin"), F.col("b_xmax")) & F.col("y").between(F.col("b_ymin"), F.col("b_ymax"))
    met = dealt(_celled(a, "a", unit, level), _celled(b, "b", unit, F.col("b_level")), ["level", "cx", "cy"], ["x", "y"], boxes.columns).where(held)
    return met.select(*points.columns, *boxes.columns)


def smallest_at(points: DataFrame, pairs: DataFrame, point_id: str, size: Column, out: str) -> DataFrame:
    """(point, b_id): of the pairs of places and b_id, that of the smallest size, ties to the smaller id, for all points that lie there."""
    best = pairs.groupBy("x", "y").agg(F.min(F.struct(size.alias("size"), F.col("b_id").alias("id"))).alias("__m"))
    placed = points.select(point_id, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).join(best, ["x", "y"])
    return placed.groupBy(point_id).agg(F.min("__m")["id"].alias(out))


def dissolve(df: DataFrame, key: str, agree: list[str], order: Column, shape: str = "shape") -> DataFrame:
    """One row for each key with the union of its shapes; the columns of `agree` keep their value where all rows state the same, else null.

    A union is the rings of all its parts.  Null keys and shapes are left out.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(shape).isNotNull())
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(shape).alias("s")))), lambda p: p["s"])
    return rows.groupBy(key).agg(F.flatten(parts).alias(shape), *(F.when(F.min(c) == F.max(c), F.min(c)).alias(c) for c in agree))


def corridors(df: DataFrame, elongation: float, length: float, shape: str = "shape") -> DataFrame:
    """df's rows that are long and thin: by the rectangle of equal area and perimeter, longer than `length` and `elongation` times as long as wide."""
    half, a = sh.perimeter(F.col(shape)) / 4, sh.area(F.col(shape))
    root = F.sqrt(F.greatest(half * half - a, F.lit(0.0)))
    out = df.withColumn("corridor_length", half + root).withColumn("corridor_width", half - root)
    return out.where((F.col("corridor_length") > length) & (F.col("corridor_length") > elongation * F.col("corridor_width")))


STATISTICS = ("count", "sum", "mean", "min", "max", "stdev", "variety", "majority", "minority", "median")


def zonal_statistics(pixels: DataFrame, zones: DataFrame, zone_id: str, value: str, size: float, x0: float = 0.0, y0: float = 0.0, shape: str = "shape") -> DataFrame:
    """Per zone, over the pixels (row, col, value) that it covers, each weighed by the covered share: STATISTICS.

    A pixel (row, col) is the square of width `size` whose lower left corner is (x0 + col * size, y0 + row * size).  Null values
    don't count.  variety: distinct values; majority, minority: of the largest and least weight, ties to the smaller value;
    median: the least value up to which half of the weight lies.  Zones that cover no pixel have a count of 0 and else nulls.
    Pixels are gathered by tiles of TILE squared; a zone meets the tiles of its box, equal ones once, and one row for each of its
    values is kept.
    """
    tile = lambda c: F.floor(F.col(c) / TILE).cast("long")
    tiles = pixels.where(F.col(value).isNotNull()).groupBy(tile("row").alias("ty"), tile("col").alias("tx")).agg(F.collect_list(F.struct("row", "col", F.col(value).cast("double").alias("v"))).alias("p"))
    b = with_box(zones.select(F.col(shape).alias("zone")).distinct(), "zone", "z").dropna(subset=["z_xmin"])
    span = lambda lo, hi, at: F.explode(F.sequence(F.floor((F.col(lo) - at) / (size * TILE)).cast("long"), F.floor((F.col(hi) - at) / (size * TILE)).cast("long")))
    met = b.withColumn("tx", span("z_xmin", "z_xmax", x0)).withColumn("ty", span("z_ymin", "z_ymax", y0)).join(tiles, ["tx", "ty"])
    # of a tile, a zone takes along what its box touches
    touches = lambda k, at, lo, hi: (at + k * size <= F.col(hi)) & (at + (k + 1) * size >= F.col(lo))
    near = F.filter("p", lambda q: touches(q["col"], x0, "z_xmin", "z_xmax") & touches(q["row"], y0, "z_ymin", "z_ymax"))
    met = met.select("zone", near.alias("p")).where(F.size("p") > 0).repartition(tasks(zones))
    covered = sh.covered_values("zone", F.col("p.row").cast("array<double>"), F.col("p.col").cast("array<double>"), F.col("p.v"), F.lit(x0), F.lit(y0), F.lit(size))
    found = met.select("zone", covered.alias("c")).join(zones.select(zone_id, F.col(shape).alias("zone")), "zone")
    each = found.select(zone_id, F.explode("c").alias("c")).groupBy(zone_id, F.col("c.value").alias("v")).agg(F.sum("c.weight").alias("w"))
    from pyspark.sql.window import Window

    run = F.sum("w").over(Window.partitionBy(zone_id).orderBy("v"))
    half = F.sum("w").over(Window.partitionBy(zone_id)) / 2
    each = each.withColumn("over", F.when(run >= half - 1e-12, F.col("v")))
    w, v = F.col("w"), F.col("v")
    mean = F.sum(w * v) / F.sum(w)
    found = each.groupBy(zone_id).agg(
        F.sum(w).alias("count"), F.sum(w * v).alias("sum"), mean.alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.sqrt(F.greatest(F.sum(w * v * v) / F.sum(w) - mean * mean, F.lit(0.0))).alias("stdev"), F.count(v).alias("variety"),
        F.min(F.struct((-w).alias("w"), v.alias("v")))["v"].alias("majority"), F.min(F.struct(w.alias("w"), v.alias("v")))["v"].alias("minority"), F.min("over").alias("median"),
    )
    return zones.select(zone_id).join(found, zone_id, "left").withColumn("count", F.coalesce("count", F.lit(0.0))).withColumn("variety", F.coalesce("variety", F.lit(0)))


def pixel_at(points: DataFrame, pixels: DataFrame, point_id: str, value: str, size: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """(point, value) of the pixel that holds each point; null outside."""
    placed = points.select(point_id, F.floor((F.col("y") - y0) / size).cast("long").alias("row"), F.floor((F.col("x") - x0) / size).cast("long").alias("col"))
    return placed.join(pixels.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), value), ["row", "col"], "left").select(point_id, value)


def largest_overlap(pairs: DataFrame, left_id: str, ties: list[Column]) -> DataFrame:
    """Of each left id, the pair of the largest area; ties by the given order."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(left_id).orderBy(F.col("area").desc(), *ties)
    return pairs.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
