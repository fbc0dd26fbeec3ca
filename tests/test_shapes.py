"""Exact areas of shapes against closed forms and counted points; codes, cutting, decoding."""

from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import shapes as sh
from cadastra.operators import overlays as ov


def ring(*points):
    return [float(v) for p in (*points, points[0]) for v in p]


SQUARE = [ring((0, 0), (2, 0), (2, 2), (0, 2))]
HOLED = [*SQUARE, ring((0.5, 0.5), (0.5, 1.5), (1.5, 1.5), (1.5, 0.5))]
STAR = [ring(*((3 * math.cos(math.pi * k / 5), 3 * math.sin(math.pi * k / 5)) if k % 2 == 0 else (math.cos(math.pi * k / 5), math.sin(math.pi * k / 5)) for k in range(10)))]


def test_overlap_of_simple_shapes():
    shifted = [[v + 1 for v in SQUARE[0]]]
    assert sh.overlap(SQUARE, shifted) == pytest.approx((4, 4, 1))
    assert sh.overlap(HOLED, shifted) == pytest.approx((3, 4, 0.75))
    assert sh.overlap(SQUARE + shifted, []) == pytest.approx((7, 0, 0))
    assert sh.overlap(SQUARE, [ring((2, 0), (3, 0), (3, 1), (2, 1))])[2] == pytest.approx(0)
    assert sh.overlap([], []) == (0, 0, 0) and sh.overlap(SQUARE, SQUARE) == pytest.approx((4, 4, 4))


def test_overlap_against_counted_points():
    rng = random.Random(3)
    for _ in range(6):
        a = [[v + rng.uniform(-1, 1) * (i % 2) for i, v in enumerate(STAR[0])]]
        a[0][-2:] = a[0][:2]
        dx, dy = rng.uniform(-2, 2), rng.uniform(-2, 2)
        b = [[v + (dx if i % 2 == 0 else dy) for i, v in enumerate(STAR[0])]]
        n = 400
        at = (np.arange(n) + 0.5) / n * 14 - 7
        x, y = (m.ravel() for m in np.meshgrid(at, at))
        inside = []
        for s in (a, b):
            wind = np.zeros(len(x), int)
            p = np.array(s[0]).reshape(-1, 2)
            for (x0, y0), (x1, y1) in zip(p[:-1], p[1:], strict=True):
                side = (x1 - x0) * (y - y0) - (x - x0) * (y1 - y0)
                wind += ((y0 <= y) & (y1 > y) & (side > 0)).astype(int) - ((y0 > y) & (y1 <= y) & (side < 0))
            inside.append(wind != 0)
        cell = (14 / n) ** 2
        want = [inside[0].sum() * cell, inside[1].sum() * cell, (inside[0] & inside[1]).sum() * cell]
        assert sh.overlap(a, b) == pytest.approx(want, abs=0.15)


def test_coverage_adds_up_to_the_area():
    rows, cols = (m.ravel() for m in np.meshgrid(np.arange(40), np.arange(40), indexing="ij"))
    w = sh.coverage(STAR, -5.0, -5.0, 0.25, rows.astype(float), cols.astype(float))
    assert w.sum() * 0.25**2 == pytest.approx(sh.overlap(STAR, [])[0]) and w.max() <= 1 + 1e-9 and w.min() >= 0


def test_pieces_and_simpler_lines():
    circle = [np.array([(math.cos(t), math.sin(t)) for t in [2 * math.pi * k / 500 for k in range(500)] + [0.0]])]
    cut = sh.pieces(circle, 40)
    assert sum(sh.overlap(p, [])[0] for p in cut) == pytest.approx(sh.overlap([circle[0].ravel().tolist()], [])[0])
    assert all(sum(len(r) // 2 - 1 for r in p) <= 40 for p in cut) and len(cut) > 10
    few = sh.simpler(circle[0], 0.01)
    assert len(few) < 60 and np.abs(np.hypot(*few.T) - 1).max() < 1e-9


def test_well_known_binary():
    def polygon(*rings):
        out = struct.pack("<BII", 1, 3, len(rings))
        for r in rings:
            out += struct.pack(f"<I{len(r)}d", len(r) // 2, *r)
        return out

    backwards = [v for p in reversed(list(zip(SQUARE[0][::2], SQUARE[0][1::2], strict=True))) for v in p]
    assert sh.overlap(sh.from_wkb(polygon(backwards)), [])[0] == pytest.approx(4) and sh.from_wkb(polygon(SQUARE[0])) == SQUARE
    assert sh.overlap(sh.from_wkb(polygon(SQUARE[0], HOLED[1])), [])[0] == pytest.approx(3)
    many = struct.pack("<BII", 1, 6, 2) + polygon(SQUARE[0]) + polygon([v + 5 for v in SQUARE[0]])
    assert sh.overlap(sh.from_wkb(many), [])[0] == pytest.approx(8)
    assert sh.from_wkb(None) is None and sh.from_wkb(struct.pack("<BIdd", 1, 1, 0.0, 0.0)) is None


def test_columns_of_null_empty_and_bad_shapes(spark):
    rows = spark.createDataFrame([(0, None), (1, []), (2, HOLED), (3, [[0.0, 0.0, 1.0, 0.0, 1.0, 1.0]])], "i int, g array<array<double>>")
    g = F.col("g")
    out = {r.i: r for r in rows.select("i", sh.area(g).alias("a"), sh.bounds(g).alias("b"), sh.present(g).alias("p"), sh.defects(g).alias("d"), sh.area(sh.mended(g)).alias("m"), sh.holds(g, F.lit(1.0), F.lit(1.0)).alias("h"), sh.union_area("g").alias("u")).collect()}
    assert out[0].a is None and out[0].b is None and out[0].p is False and out[0].u is None
    assert out[1].a == 0 and out[1].b is None and out[1].p is False and out[1].d == ["no_area"]
    assert out[2].a == 3 and out[2].b.xmax == 2 and out[2].d == [] and out[2].h is False and out[2].u == pytest.approx(3)
    assert out[3].d == ["open_ring", "few_points"] and out[3].m == 0.5


def test_known_location_codes(spark):
    rows = spark.createDataFrame([(47.365590, 8.524997), (20.3701125, 2.7821875), (-41.2730625, 174.7859375)], "lat double, lon double")
    codes = [r[0] for r in rows.select(sh.location_code(F.col("lat"), F.col("lon"))).collect()]
    assert codes == ["8FVC9G8F+6X", "7FG49QCJ+2V", "4VCPPQGP+Q9"]


def test_meeting_finds_all_pairs_once(spark):
    rng = random.Random(1)
    boxes = [(i, x := rng.uniform(-50, 50), y := rng.uniform(-50, 50), x + rng.choice([0.1, 1, 5, 60]), y + rng.choice([0.1, 1, 5, 60])) for i in range(120)] + [(120, None, None, None, None), (121, 0.0, 0.0, 0.0, 5.0)]
    a = spark.createDataFrame(boxes, "i int, a_xmin double, a_ymin double, a_xmax double, a_ymax double")
    b = spark.createDataFrame(boxes, "j int, b_xmin double, b_ymin double, b_xmax double, b_ymax double")
    got = sorted((r.i, r.j) for r in ov.meeting(a, b, 0.5).select("i", "j").collect())
    whole = [x for x in boxes if x[1] is not None]
    want = sorted((p[0], q[0]) for p in whole for q in whole if max(p[1], q[1]) < min(p[3], q[3]) and max(p[2], q[2]) < min(p[4], q[4]))
    assert got == want


def test_many_pairs_at_once_equal_one_by_one():
    rng = np.random.default_rng(4)

    def shape(n):
        at = np.sort(rng.uniform(0, 2 * np.pi, n))
        r = rng.uniform(0.3, 2, n)
        return [ring(*zip((r * np.cos(at)).tolist(), (r * np.sin(at) + rng.uniform(-1, 1)).tolist(), strict=True))]

    pairs = [(shape(int(rng.integers(3, 14))), shape(int(rng.integers(3, 14))) + shape(4)) for _ in range(60)] + [(shape(30), shape(30)), ([], shape(5)), ([], []), (SQUARE, HOLED), (SQUARE, SQUARE)]
    assert sh.overlaps(pairs) == pytest.approx(np.array([sh.overlap(a, b) for a, b in pairs]), abs=1e-9)


def test_equal_places_meet_once(spark):
    """Towers of rows on few places: pairs of places are worked out, rows are put to them afterwards."""
    rows = spark.range(3000).select(F.col("id").alias("i"), (F.col("id") % 3).cast("double").alias("a_xmin"), F.lit(0.0).alias("a_ymin"), ((F.col("id") % 3) + 1.5).alias("a_xmax"), F.lit(1.0).alias("a_ymax"))
    right = rows.where("i < 2500").select(F.col("i").alias("j"), *(F.col(f"a_{c}").alias(f"b_{c}") for c in ov.BOX))
    met = ov.meeting_places(ov.places(rows, "a"), ov.places(right, "b"), 1.0)
    assert met.count() == 7 and ov.each(met).count() == ov.meeting(rows, right, 1.0).count()
    of = [sum(1 for k in range(2500) if k % 3 == m) for m in range(3)]
    assert ov.each(met).count() == 1000 * (of[0] + of[1] + sum(of) + of[1] + of[2])
    big = ov.places(spark.range(2500).select("id", *(F.lit(v).alias(f"a_{c}") for c, v in zip(ov.BOX, (0.0, 0.0, 1.0, 1.0), strict=True))), "a")
    assert sorted(len(r[0]) for r in big.select("a__rows").collect()) == [2500 - 2 * ov.ALIKE, ov.ALIKE, ov.ALIKE]


def test_crowded_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ov, "BLOCK", 4)
    a = spark.range(40).select(F.lit(0).alias("k"), F.col("id").alias("i"))
    b = spark.range(30).select(F.lit(0).alias("k"), F.col("id").alias("j"))
    out = ov.dealt(a, b, ["k"], ["i"], ["j"])
    assert out.distinct().count() == out.count() == 1200
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_plain_overlaps_are_used_and_exact():
    rng = np.random.default_rng(2)
    boxes = [[ring((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1))] for x, y in ((0, 0), (1, 0), (0.5, 0.25), (0, 1))]
    diamonds = [[[x + r, 0.0, x, r, x - r, 0.0, x, -r, x + r, 0.0]] for x, r in ((0.0, 1.0), (2.0, 1.0), (0.5, 0.5))]
    turned = lambda: sorted(rng.uniform(0, 2 * np.pi, 6))
    pairs = [(p, q) for group in (boxes, diamonds) for p in group for q in group]
    for _ in range(200):
        p, q = ([ring(*((x + math.cos(t), y + math.sin(t)) for t in turned()))] for x, y in rng.uniform(-0.8, 0.8, (2, 2)))
        pairs.append((p, q))
    want = np.array([sh.overlap(a, b) for a, b in pairs])
    assert sh.overlaps(pairs) == pytest.approx(want, abs=1e-9)
    assert sh.overlaps([(boxes[0], boxes[1]), (diamonds[0], diamonds[1]), (boxes[0], boxes[3])])[:, 2].tolist() == [0, 0, 0]
    crossed = sh._crossed_overlaps
    try:
        sh._crossed_overlaps = None
        sh.overlaps(pairs)
    finally:
        sh._crossed_overlaps = crossed


def test_overlays_without_pairs_of_rows(spark):
    from cadastra.operators import geometry as ge

    boxes = spark.createDataFrame([(i, float(i % 3), 0.0, i % 3 + 1.5, 1.0) for i in range(12)] + [(12, 50.0, 0.0, 51.0, 1.0), (13, None, 0.0, 1.0, 1.0)], "i int, xmin double, ymin double, xmax double, ymax double")
    lots = spark.createDataFrame([(j, float(j % 2), 0.0, j % 2 + 1.0, 0.5) for j in range(9, 0, -1)], "j int, xmin double, ymin double, xmax double, ymax double")
    want = ge.shares(ge.overlay(boxes, lots, "i", "j", 1.0), boxes, "i", "j")
    assert sorted(map(tuple, ge.covered_shares(boxes, lots, "i", "j", 1.0, 9).collect())) == sorted(map(tuple, want.collect()))
    both = ge.overlay(boxes, lots, "i", "j", 1.0, how="identity")
    assert sorted((r.i, r.area) for r in both.where("j is null").collect() if r.i < 13) == [(2, 1.5), (5, 1.5), (8, 1.5), (11, 1.5), (12, 1.0)] and both.where("i = 13").count() == 1


def test_losers_among_equal_shapes(spark):
    shapes = [(k, [ring((x, 0), (x + w, 0), (x + w, 1), (x, 1))]) for k, x, w in ((5, 0, 4), (3, 0, 4), (9, 0, 4), (1, 3, 4), (7, 0.5, 3), (2, 0.5, 4), (8, 90, 1))]
    df = spark.createDataFrame([*shapes, (None, shapes[0][1])], "k int, shape array<array<double>>")
    assert sorted(r.k for r in ov.without_overlaps(df, "k", 1.0).collect() if r.k) == [1, 2, 8]
    assert df.count() == 8 and ov.without_overlaps(df, "k", 1.0).where("k is null").count() == 1


def test_points_of_one_place_are_met_once(spark):
    from cadastra.operators import geometry as ge

    points = spark.range(600).select(F.col("id").alias("p"), (F.col("id") % 4 * 1.0).alias("x"), F.lit(1.0).alias("y"), F.col("id").cast("double").alias("v"))
    boxes = spark.createDataFrame([(j, 0.0 if j % 2 else 2.0, 0.0, 3.0, 2.0) for j in range(8, 0, -1)] + [(20, -100.0, -100.0, 100.0, 100.0)], "j int, xmin double, ymin double, xmax double, ymax double")
    places = ov.point_places(points)
    assert ov.at_points(places, boxes.select(*(F.col(c).alias(f"b_{c}") for c in ov.BOX)).distinct(), 1.0).count() == 4 + 2 + 4
    got = {r.p % 4: r.j for r in ge.points_in_boxes(points, boxes, "p", "j", 1.0).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 2}
    zones = {r.j: (r.n, r["mean"], r.low, r.high) for r in ge.zonal(points, boxes, "j", "v", 1.0).collect()}
    assert zones[1] == zones[3] == (450, pytest.approx(299.0), 0.0, 598.0) and zones[2][0] == 150 and zones[20][0] == 600
    near = {r.p % 4: (r.j, r.distance) for r in ge.nearest(points, boxes.select("j", F.col("xmin").alias("x"), F.col("ymin").alias("y")), "p", "j", 2.0).collect()}
    assert near == {0: (1, 1.0), 1: (1, pytest.approx(2**0.5)), 2: (2, 1.0), 3: (2, pytest.approx(2**0.5))}
    shaped = boxes.select("j", sh.box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")).alias("shape"))
    assert {r.p % 4: r.j for r in ov.points_in_shapes(points, shaped, "p", "j", 1.0).collect()} == {0: 1, 1: 1, 2: 2, 3: 20}
    held = shaped.crossJoin(places).select(sh.held("shape", "x", "y").alias("h"), sh.holds(F.col("shape"), F.col("x"), F.col("y")).alias("w")).collect()
    assert all(r.h == r.w for r in held)


def test_equal_zones_are_laid_over_pixels_once(spark):
    pixels = spark.range(10000).select((F.col("id") / 100).cast("int").alias("row"), (F.col("id") % 100).cast("int").alias("col"), (F.col("id") % 5).alias("v"))
    zones = spark.range(50).select(F.col("id").alias("z"), sh.box(F.col("id") % 1 + 10.5, F.lit(60.0), F.lit(14.0), F.lit(66.0)).alias("shape"))
    out = ov.zonal_statistics(pixels, zones, "z", "v", 1.0)
    assert out.select("count").distinct().collect() == [(21.0,)] and out.count() == 50
    assert "Aggregate [zone" in out._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_are_cut_in_many_tasks(spark, sf_dir):
    from cadastra.plans import catalogue

    assert "RepartitionByExpression" in catalogue.queries()["shape_pieces"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    line = np.array([(0.0, 0.0), (4, 0), (4, 4), (2, -1), (0, 4), (0, 0)])
    assert sh.clipped(line, 1, 1.0, True).tolist() == [[4, 1], [4, 4], [2.8, 1], [1.2, 1], [0, 4], [0, 1], [4, 1]]
