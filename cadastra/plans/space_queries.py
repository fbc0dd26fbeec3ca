"""Queries of boxes, points and rasters, on shapes made of the tables' numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import geometry as ge
from cadastra.plans.catalogue import load, query

c = F.col


def _boxes(spark, d):
    x, y = c("p_partkey") % 97 * 1.0, c("p_partkey") % 89 * 1.0
    return load(spark, d, "part").select(c("p_partkey").alias("a"), x.alias("xmin"), y.alias("ymin"), (x + c("p_size") / 10 + 1).alias("xmax"), (y + c("p_size") / 20 + 1).alias("ymax"))


def _lots(spark, d):
    x, y = c("s_suppkey") * 13 % 100 * 1.0, c("s_suppkey") * 7 % 90 * 1.0
    return load(spark, d, "supplier").select(c("s_suppkey").alias("b"), x.alias("xmin"), y.alias("ymin"), (x + 6).alias("xmax"), (y + 5).alias("ymax"))


def _points(spark, d):
    return load(spark, d, "events").select("event_id", (c("event_id") * 31 % 1000 / 10).alias("x"), (c("event_id") * 17 % 900 / 10).alias("y"), "value")


BOXES = "(select p_partkey as a, p_partkey % 97 * 1.0 as x0, p_partkey % 89 * 1.0 as y0, p_partkey % 97 + p_size / 10 + 1 as x1, p_partkey % 89 + p_size / 20 + 1 as y1 from part)"
LOTS = "(select s_suppkey as b, s_suppkey * 13 % 100 * 1.0 as u0, s_suppkey * 7 % 90 * 1.0 as v0, s_suppkey * 13 % 100 + 6.0 as u1, s_suppkey * 7 % 90 + 5.0 as v1 from supplier)"
POINTS = "(select event_id, event_id * 31 % 1000 / 10 as x, event_id * 17 % 900 / 10 as y, value from events)"
MET = f"(select a, b, (least(x1, u1) - greatest(x0, u0)) * (least(y1, v1) - greatest(y0, v0)) as area, (x1 - x0) * (y1 - y0) as own, 30.0 as lot from {BOXES} join {LOTS} on least(x1, u1) > greatest(x0, u0) and least(y1, v1) > greatest(y0, v0))"


@query("overlay_intersection", f"select a, b, round(area, 6) as area, round(area / (own + lot - area), 6) as iou from {MET}")
def overlay_intersection(spark, d):
    return ge.overlay(_boxes(spark, d), _lots(spark, d), "a", "b", 8.0, digits=6)


@query("overlay_shares", f"with m as (select a, sum(area) as s, max(own) as own, arg_min(b, (-round(area, 9), b)) as dominant from {MET} group by 1) select p_partkey as a, round(coalesce(least(1.0, s / own), 0.0), 6) as share, dominant from part left join m on a = p_partkey")
def overlay_shares(spark, d):
    return ge.covered_shares(_boxes(spark, d), _lots(spark, d), "a", "b", 8.0, digits=9).withColumn("share", F.round("share", 6))


@query("overlay_identity", f"select a, b, round(area, 6) as area from {MET} union all select a, null, round((x1 - x0) * (y1 - y0), 6) from {BOXES} where a not in (select a from {MET})")
def overlay_identity(spark, d):
    return ge.overlay(_boxes(spark, d), _lots(spark, d), "a", "b", 8.0, how="identity", digits=6).select("a", "b", "area")


@query("points_in_boxes", f"select event_id, min(b) as b from {POINTS} join {LOTS} on x between u0 and u1 and y between v0 and v1 group by 1")
def points_in_boxes(spark, d):
    return ge.points_in_boxes(_points(spark, d), _lots(spark, d), "event_id", "b", 8.0)


@query(
    "nearest_point",
    f"with n as (select event_id, b, round(sqrt(power(x - u0, 2) + power(y - v0, 2)), 9) as dist from {POINTS} join {LOTS} on sqrt(power(x - u0, 2) + power(y - v0, 2)) <= 5) select event_id, arg_min(b, (dist, b)) as b, round(min(dist), 6) as distance from n group by 1",
)
def nearest_point(spark, d):
    corners = _lots(spark, d).select("b", c("xmin").alias("x"), c("ymin").alias("y"))
    return ge.nearest(_points(spark, d), corners, "event_id", "b", 5.0).withColumn("distance", F.round("distance", 6))


@query("zonal_stats", f"select b, count(*) as n, round(avg(value), 9) as mean, min(value) as low, max(value) as high from {LOTS} join {POINTS} on x >= u0 and x < u1 and y >= v0 and y < v1 group by 1")
def zonal_stats(spark, d):
    return ge.zonal(_points(spark, d), _lots(spark, d), "b", "value", 8.0).withColumn("mean", F.round("mean", 9))


def _pixels(spark, d):
    return load(spark, d, "part").select((c("p_partkey") / 50).cast("int").alias("row"), (c("p_partkey") % 50).cast("int").alias("col"), F.when(c("p_size") % 11 != 0, c("p_size") % 2).alias("v"))


@query(
    "raster_focal",
    """with p as (select cast(trunc(p_partkey / 50) as int) as r, cast(p_partkey % 50 as int) as c, case when p_size % 11 <> 0 then p_size % 2 end as v from part)
    select a.r as row, a.c as col, round(100.0 * sum(b.v) / count(b.v), 6) as coverage from p a left join p b on power(a.r - b.r, 2) + power(a.c - b.c, 2) <= 4 and b.v is not null group by 1, 2""",
)
def raster_focal(spark, d):
    return ge.focal_coverage(_pixels(spark, d), 2, "v", "coverage").withColumn("coverage", F.round("coverage", 6))


@query(
    "quadkeys",
    f"""with p as (select event_id, y - 45 as lat, x - 50 as lon from {POINTS}), t as (select event_id, cast(floor(least(511, greatest(0, (lon + 180) / 360 * 512))) as bigint) as tx,
    cast(floor(least(511, greatest(0, (0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 512))) as bigint) as ty from p)
    select event_id, {" || ".join(f"cast(((tx >> {k}) & 1) + 2 * ((ty >> {k}) & 1) as varchar)" for k in range(8, -1, -1))} as quadkey from t""",
)
def quadkeys(spark, d):
    """Map tile of each event's point, taken as degrees."""
    return _points(spark, d).select("event_id", ge.quadkey(c("y") - 45, c("x") - 50, 9).alias("quadkey"))
