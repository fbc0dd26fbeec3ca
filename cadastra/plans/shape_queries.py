"""Queries of polygons, on diamonds and boxes made of the tables' numbers.

A diamond |x - cx| + |y - cy| <= r is an upright square in u = x + y, v = x - y,
so SQL can state exact overlaps of shapes that aren't upright.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import shapes as sh
from cadastra.operators import overlays as ov
from cadastra.plans.catalogue import load, query

c = F.col


def _diamond(x, y, r):
    return F.array(F.array(x + r, y, x, y + r, x - r, y, x, y - r, x + r, y))


def _parts(spark, d):
    x, y, r = c("p_partkey") % 97 * 1.0, c("p_partkey") % 89 * 1.0, c("p_size") / 10 + 0.5
    return load(spark, d, "part").select(c("p_partkey").alias("a"), "p_brand", _diamond(x, y, r).alias("shape"))


def _lots(spark, d):
    x, y = c("s_suppkey") * 13 % 100 * 1.0, c("s_suppkey") * 7 % 90 * 1.0
    return load(spark, d, "supplier").select(c("s_suppkey").alias("b"), "s_nationkey", _diamond(x, y, c("s_suppkey") % 7 * 6 + 3.0).alias("shape"))


PARTS = "(select p_partkey as a, p_brand, cast(p_partkey % 97 as double) as x, cast(p_partkey % 89 as double) as y, cast(p_size / 10 + 0.5 as double) as r from part)"
LOTS = "(select s_suppkey as b, s_nationkey, cast(s_suppkey * 13 % 100 as double) as x, cast(s_suppkey * 7 % 90 as double) as y, cast(s_suppkey % 7 * 6 + 3 as double) as r from supplier)"
SPAN = "(least(p.x {0} p.y + p.r, l.x {0} l.y + l.r) - greatest(p.x {0} p.y - p.r, l.x {0} l.y - l.r))"
MET = f"(select a, b, p.r as pr, l.r as lr, greatest(0, {SPAN.format('+')}) * greatest(0, {SPAN.format('-')}) / 2 as area from {PARTS} p join {LOTS} l on {SPAN.format('+')} > 0 and {SPAN.format('-')} > 0)"


@query(
    "shape_measures",
    f"""select a, round(2 * r * r, 6) as area, round(4 * sqrt(2.0) * r, 6) as perimeter, round(x, 6) as cx, round(y, 6) as cy, round(x - r, 6) as xmin, round(y + r, 6) as ymax, 4 as vertices, cast(16 as double) as thinness, '' as defects,
    round(2 * r * r / 10000, 9) as ha, round(2 * r * r / 4046.8564224, 9) as acre from {PARTS}""",
)
def shape_measures(spark, d):
    g = c("shape")
    b, m = sh.bounds(g), sh.centroid(g)
    return _parts(spark, d).select(
        "a", F.round(sh.area(g), 6).alias("area"), F.round(sh.perimeter(g), 6).alias("perimeter"), F.round(m["x"], 6).alias("cx"), F.round(m["y"], 6).alias("cy"), F.round(b["xmin"], 6).alias("xmin"),
        F.round(b["ymax"], 6).alias("ymax"), sh.vertices(g).alias("vertices"), F.round(sh.thinness(g), 6).alias("thinness"), F.array_join(sh.defects(g), ",").alias("defects"),
        F.round(sh.convert_area(sh.area(g), "m2", "ha"), 9).alias("ha"), F.round(sh.convert_area(sh.area(g), "m2", "acre"), 9).alias("acre"),
    )


@query("shape_overlay", f"select a, b, round(area, 6) as area, round(area / (2 * pr * pr + 2 * lr * lr - area), 6) as iou, round(area / (2 * pr * pr), 6) as share from {MET} where area > 0")
def shape_overlay(spark, d):
    return ov.overlay_shapes(_parts(spark, d), _lots(spark, d), "a", "b", 4.0, digits=6)


@query("shape_overlay_boxes_of_all_sizes", """with b as (select p_partkey as a, cast(p_partkey % 97 as double) as x, cast(p_partkey % 89 as double) as y, cast(case when p_partkey % 50 = 0 then 90 else p_size / 20 + 0.5 end as double) as w from part), m as (select a.a as first, b.a as second, (least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * (least(a.y + a.w, b.y + b.w) - greatest(a.y, b.y)) as area, a.w as v, b.w as w
    from b a join b on a.a < b.a and least(a.x + a.w, b.x + b.w) > greatest(a.x, b.x) and least(a.y + a.w, b.y + b.w) > greatest(a.y, b.y)) select first, second, round(area, 6) as area from m where area >= 0.25""")
def shape_overlay_boxes_of_all_sizes(spark, d):
    x, y = c("p_partkey") % 97 * 1.0, c("p_partkey") % 89 * 1.0
    w = F.when(c("p_partkey") % 50 == 0, 90.0).otherwise(c("p_size") / 20 + 0.5)
    rows = load(spark, d, "part").select(c("p_partkey").alias("a"), x.alias("x"), y.alias("y"), w.alias("w"))
    a, b = (rows.select(c("a").alias(k), *(e.alias(f"{s}_{n}") for n, e in (("xmin", c("x")), ("ymin", c("y")), ("xmax", c("x") + c("w")), ("ymax", c("y") + c("w"))))) for k, s in (("first", "a"), ("second", "b")))
    area = (F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin")) * (F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin"))
    met = ov.meeting_places(ov.places(a, "a"), ov.places(b, "b"), 1.0).where(area >= 0.25).select("a__rows", "b__rows", F.round(area, 6).alias("area"))
    return ov.each(met).where("first < second").select("first", "second", "area")


@query(
    "shape_identity",
    "with l as (select s_suppkey as a, cast(s_suppkey * 11 as double) as x, cast(10 as double) as w from supplier), n as (select n_nationkey as b, cast(n_nationkey * 20 as double) as x from nation), m as (select a, b, (least(l.x + w, n.x + 15) - greatest(l.x, n.x)) * 10 as area from l join n on least(l.x + w, n.x + 15) > greatest(l.x, n.x)) "
    "select a, b, round(area, 6) as area from m union all select l.a, null, round(100 - coalesce(s, 0), 6) from l left join (select a, sum(area) as s from m group by 1) t on t.a = l.a where 100 - coalesce(s, 0) > 1e-4",
)
def shape_identity(spark, d):
    left = load(spark, d, "supplier").select(c("s_suppkey").alias("a"), sh.box(c("s_suppkey") * 11.0, F.lit(0.0), c("s_suppkey") * 11.0 + 10, F.lit(10.0)).alias("shape"))
    right = load(spark, d, "nation").select(c("n_nationkey").alias("b"), sh.box(c("n_nationkey") * 20.0, F.lit(0.0), c("n_nationkey") * 20.0 + 15, F.lit(12.0)).alias("shape"))
    return ov.overlay_shapes(left, right, "a", "b", 10.0, how="identity").select("a", "b", F.round("area", 6).alias("area"))


@query("shape_dissolve", "select s_nationkey, case when count(distinct s_suppkey % 2) = 1 then min(s_suppkey % 2) end as parity, round((max(x) - min(x)) * 10 + 100, 6) as area from (select *, cast(row_number() over (partition by s_nationkey order by s_suppkey) * 7 as double) as x from supplier) group by 1")
def shape_dissolve(spark, d):
    """Boxes that overlap their neighbours: the union's area counts places once."""
    from pyspark.sql.window import Window

    x = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) * 7.0
    rows = load(spark, d, "supplier").withColumn("x", x).select("s_nationkey", "s_suppkey", (c("s_suppkey") % 2).alias("parity"), sh.box(c("x"), F.lit(0.0), c("x") + 10, F.lit(10.0)).alias("shape"))
    return ov.dissolve(rows, "s_nationkey", ["parity"], c("s_suppkey")).select("s_nationkey", "parity", F.round(sh.union_area("shape"), 6).alias("area"))


@query("points_in_shapes", f"select event_id, arg_min(b, (r, b)) as b from (select event_id, event_id * 31 % 1000 / 10 + 0.05 as px, event_id * 17 % 900 / 10 + 0.013 as py from events) join {LOTS} on abs(px - x) + abs(py - y) < r group by 1")
def points_in_shapes(spark, d):
    points = load(spark, d, "events").select("event_id", (c("event_id") * 31 % 1000 / 10 + 0.05).alias("x"), (c("event_id") * 17 % 900 / 10 + 0.013).alias("y"))
    return ov.points_in_shapes(points, _lots(spark, d), "event_id", "b", 4.0)


@query("shape_without_overlaps", f"with p as (select s_suppkey as b, s_suppkey % 40 * 5.0 as x, s_suppkey % 5 + 4.0 as w from supplier) select b from p where not exists (select 1 from p q where q.b <> p.b and least(p.x + p.w, q.x + q.w) - greatest(p.x, q.x) > 0.5 * least(p.w, q.w) * least(p.w, q.w) / least(p.w, q.w) and (q.w > p.w or (q.w = p.w and q.b < p.b)))")
def shape_without_overlaps(spark, d):
    x, w = c("s_suppkey") % 40 * 5.0, c("s_suppkey") % 5 + 4.0
    rows = load(spark, d, "supplier").select(c("s_suppkey").alias("b"), sh.box(x, F.lit(0.0), x + w, w).alias("shape"))
    return ov.without_overlaps(rows, "b", 4.0).select("b")


PIXELS = "(select l_orderkey % 60 as r, l_partkey % 70 as c, cast(min(l_quantity) as double) as v from lineitem group by 1, 2)"
ZONES = "(select s_suppkey as b, cast(s_suppkey * 13 % 50 + 0.3 as double) as x0, cast(s_suppkey * 7 % 50 + 0.6 as double) as y0, cast(s_suppkey * 13 % 50 + 5.05 as double) as x1, cast(s_suppkey * 7 % 50 + 3.2 as double) as y1 from supplier)"


@query(
    "zonal_fractional",
    f"""with w as (select b, v, (least(x1, c + 1) - greatest(x0, c)) * (least(y1, r + 1) - greatest(y0, r)) as w from {ZONES} join {PIXELS} on least(x1, c + 1) > greatest(x0, c) and least(y1, r + 1) > greatest(y0, r)), s as (select b, v, sum(w) as w from w group by 1, 2)
    select s_suppkey as b, round(coalesce(sum(w), 0), 5) as "count", round(sum(w * v), 4) as "sum", round(sum(w * v) / sum(w), 5) as mean, min(v) as "min", max(v) as "max", count(v) as variety, round(sqrt(greatest(sum(w * v * v) / sum(w) - power(sum(w * v) / sum(w), 2), 0)), 4) as stdev from supplier left join s on b = s_suppkey group by 1""",
)
def zonal_fractional(spark, d):
    pixels = load(spark, d, "lineitem").groupBy((c("l_orderkey") % 60).alias("row"), (c("l_partkey") % 70).alias("col")).agg(F.min("l_quantity").alias("v"))
    s = c("s_suppkey")
    zones = load(spark, d, "supplier").select(s.alias("b"), sh.box(s * 13 % 50 + 0.3, s * 7 % 50 + 0.6, s * 13 % 50 + 5.05, s * 7 % 50 + 3.2).alias("shape"))
    out = ov.zonal_statistics(pixels, zones, "b", "v", 1.0)
    return out.select("b", F.round("count", 5).alias("count"), F.round("sum", 4).alias("sum"), F.round("mean", 5).alias("mean"), "min", "max", "variety", F.round("stdev", 4).alias("stdev"))


@query("pixel_at_points", f"select event_id, v from (select event_id, event_id * 31 % 800 / 10 as x, event_id * 17 % 700 / 10 as y from events) left join {PIXELS} on r = floor(y) and c = floor(x)")
def pixel_at_points(spark, d):
    pixels = load(spark, d, "lineitem").groupBy((c("l_orderkey") % 60).alias("row"), (c("l_partkey") % 70).alias("col")).agg(F.min("l_quantity").alias("v"))
    points = load(spark, d, "events").select("event_id", (c("event_id") * 31 % 800 / 10).alias("x"), (c("event_id") * 17 % 700 / 10).alias("y"))
    return ov.pixel_at(points, pixels, "event_id", "v", 1.0)


@query("shape_corridors", "with p as (select p_partkey as a, cast(p_size * 10 as double) as l, cast(p_partkey % 5 + 1 as double) as w from part) select a, round(greatest(l, w), 6) as corridor_length, round(least(l, w), 6) as corridor_width from p where greatest(l, w) > 50 and greatest(l, w) > 20 * least(l, w)")
def shape_corridors(spark, d):
    rows = load(spark, d, "part").select(c("p_partkey").alias("a"), sh.box(F.lit(0.0), F.lit(0.0), c("p_size") * 10.0, c("p_partkey") % 5 + 1.0).alias("shape"))
    return ov.corridors(rows, 20, 50).select("a", F.round("corridor_length", 6).alias("corridor_length"), F.round("corridor_width", 6).alias("corridor_width"))


@query("shape_pieces", f"select b, round(2 * r * r, 6) as area, true as bounded from {LOTS}")
def shape_pieces(spark, d):
    """Shapes of many points cut into pieces of few, which make up the whole again."""
    r, n = c("s_suppkey") % 7 * 6 + 3.0, 40
    x, y = c("s_suppkey") * 13 % 100 * 1.0, c("s_suppkey") * 7 % 90 * 1.0
    corners = [(1, 0), (0, 1), (-1, 0), (0, -1), (1, 0)]
    points = [(a[0] + (b[0] - a[0]) * k / n, a[1] + (b[1] - a[1]) * k / n) for a, b in zip(corners, corners[1:], strict=False) for k in range(n)] + [(1, 0)]
    ring = F.array(*(e for p, q in points for e in (x + r * p, y + r * q)))
    rows = load(spark, d, "supplier")
    cut = rows.repartition(ov.tasks(rows), "s_suppkey").select(c("s_suppkey").alias("b"), F.explode(sh.subdivided(F.array(ring), F.lit(30))).alias("piece"))
    return cut.groupBy("b").agg(F.round(F.sum(sh.area(c("piece"))), 6).alias("area"), (F.max(sh.vertices(c("piece"))) <= 30).alias("bounded"))


DIGITS = "'23456789CFGHJMPQRVWX'"
_OLC = " || ".join(f"substr({DIGITS}, cast(({v} // {20**k}) % 20 as int) + 1, 1)" + (" || '+'" if (k, v) == (1, "x") else "") for k in range(4, -1, -1) for v in ("y", "x"))


@query(
    "location_codes",
    f"with p as (select event_id, (event_id * 137 % 17000) / 100 - 85 + 0.00003 as lat, (event_id * 911 % 36000) / 100 - 180 + 0.00003 as lon from events), g as (select *, cast(floor((lat + 90) * 8000) as bigint) as y, cast(floor((lon + 180) * 8000) as bigint) as x from p) "
    f"select event_id, {_OLC} as code, round((y + 0.5) / 8000 - 90, 7) as lat, round((x + 0.5) / 8000 - 180, 7) as lon from g",
)
def location_codes(spark, d):
    lat, lon = (c("event_id") * 137 % 17000) / 100 - 85 + 0.00003, (c("event_id") * 911 % 36000) / 100 - 180 + 0.00003
    rows = load(spark, d, "events").select("event_id", sh.location_code(lat, lon).alias("code"))
    at = sh.location_of(c("code"))
    return rows.select("event_id", "code", F.round(at["lat"], 7).alias("lat"), F.round(at["lon"], 7).alias("lon"))


@query("shape_ids", "select count(*) as n, count(*) as n_codes from (select distinct s_suppkey % 50 from supplier)")
def shape_ids(spark, d):
    """Shapes that differ by less than the grid share an id; building codes too."""
    s = c("s_suppkey") % 50
    x, y = s * 0.3 + 1.0000001 + c("s_suppkey") * 1e-11, s * 0.2 + 2.0000001
    rows = load(spark, d, "supplier").select(sh.box(x, y, x + 0.01, y + 0.02).alias("shape"))
    return rows.agg(F.count_distinct(sh.shape_id(c("shape"))).alias("n"), F.count_distinct(sh.building_code(c("shape"))).alias("n_codes"))
