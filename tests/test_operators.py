"""Edges of joins, aggregations and tables: nulls, ties, empty groups, repeated keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.operators import aggregates as ag
from cadastra.operators import geometry as ge
from cadastra.operators import groups as gr
from cadastra.operators import links as ln
from cadastra.operators import sales as sa
from cadastra.operators import tables as tb
from cadastra.plans import recipe as rc
from cadastra.sources import readers, store

c = F.col


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_reductions(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("a", 2, 5.0, "x"), ("a", 3, 7.0, "y"), ("b", 1, None, None), (None, 1, 1.0, "z")], "k string, pos int, v double, t string")
    out = ag.aggregate_rows(df, ["k"], {"v": "sum", "t": "distinct"}, c("pos"))
    assert rows(out, "k", "v", "t") == [("a", 12.0, "x | y"), ("b", None, None)]
    first = df.where("k is not null").groupBy("k").agg(ag.reduce_column("t", "first", c("pos")).alias("f"), ag.reduce_column("t", "agree", c("pos")).alias("g"), ag.weighted("v", "pos", "mean").alias("m"), ag.weighted("v", "pos", "sum").alias("s"))
    assert rows(first, "k", "f", "g", "m", "s") == [("a", "x", None, 31 / 5, 31.0), ("b", None, None, None, 0.0)]


def test_weighted_mode_ties_and_zero_weights(spark):
    df = spark.createDataFrame([("a", "p", 1.0, 1), ("a", "q", 1.0, 2), ("b", "r", -5.0, 3), ("b", "s", None, 4), ("b", "s", 0.0, 5), (None, "t", 9.0, 6), ("c", None, 1.0, 7)], "k string, v string, w double, pos int")
    assert rows(ag.weighted_mode(df, "k", "v", "w", [c("pos")], "best"), "pos", "best") == [(1, "p"), (2, "p"), (3, "s"), (4, "s"), (5, "s"), (6, None), (7, None)]


def test_ids(spark):
    df = spark.createDataFrame([(1, "a b#"), (2, "--"), (3, "000"), (4, None), (5, "A-B")], "i int, v string")
    out = df.select("i", ag.normal_id(c("v")).alias("v"))
    assert rows(out, "v") == sorted([("A-B",), (None,), (None,), (None,), ("A-B",)], key=str)
    with pytest.raises(ValueError):
        ag.require_unique(out.where("v is not null"), "v")


def test_as_of_labels_and_ties(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 5), (3, None, 10), (4, "a", None), (5, "z", 1), (6, "a", 12)], "i int, k string, at int")
    right = spark.createDataFrame([("a", 10, 1.0), ("a", 10, 2.0), ("a", 7, 3.0), (None, 1, 9.0), ("a", None, 8.0)], "k string, year int, v double")
    back = ln.as_of(left, right, ["k"], "at", "year", ["v"])
    assert rows(back, "i", "v", "match_type") == [(1, 2.0, "exact"), (2, None, None), (3, None, "no_key"), (4, None, "no_date"), (5, None, None), (6, 2.0, "backward_fallback")]
    ahead = ln.as_of(left, right, ["k"], "at", "year", ["v"], "forward")
    assert rows(ahead, "i", "v", "match_type") == [(1, 1.0, "exact"), (2, 3.0, "forward_fallback"), (3, None, "no_key"), (4, None, "no_date"), (5, None, None), (6, None, None)]


def test_link_by_id_overwrites_only_with_majority(spark):
    spine = spark.createDataFrame([(1, "old"), (2, None), (3, " ")], "k int, v string")
    few = spark.createDataFrame([(1, "new")], "k int, v string")
    most = spark.createDataFrame([(1, "new"), (3, "new")], "k int, v string")
    assert rows(ln.link_by_id(spine, few, "k", {"v": "min"}, F.lit(0)), "k", "v") == [(1, "old"), (2, None), (3, None)]
    assert rows(ln.link_by_id(spine, most, "k", {"v": "min"}, F.lit(0)), "k", "v") == [(1, "new"), (2, None), (3, "new")]


def test_apportionment_keeps_totals(spark):
    links = spark.createDataFrame([("f", "x", 1.0), ("f", "y", 3.0), ("g", "x", None), ("h", "x", 0.0), ("h", "y", 0.0)], "f string, c string, area double")
    shares = ln.apportion_shares(links, "f", "area")
    assert rows(shares, "f", "c", "share") == [("f", "x", 0.25), ("f", "y", 0.75), ("g", "x", 1.0), ("h", "x", 0.5), ("h", "y", 0.5)]
    values = spark.createDataFrame([("f", 10.0), ("g", 4.0), ("h", 2.0)], "f string, v double")
    assert rows(ln.apportion_values(shares, values, "f", "c", "v"), "c", "v") == [("x", 7.5), ("y", 8.5)]


def test_cascade_needs_a_unique_reference(spark):
    df = spark.createDataFrame([(1, "p", None), (2, "q", "t"), (3, None, "t")], "i int, a string, b string")
    one = spark.createDataFrame([("p", 10), ("q", 11), ("q", 12)], "a string, r int")
    two = spark.createDataFrame([("t", 20)], "b string, r int")
    assert rows(ln.cascade(df, "i", [("first", one, "a", "r"), ("second", two, "b", "r")], "hit"), "i", "hit", "link_method") == [(1, 10, "first"), (2, 20, "second"), (3, 20, "second")]


def test_components(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (7, 7), (None, 3)], "a int, b int")
    out = dict(rows(ln.chained_components(edges, "a", "b", f"file://{tmp_path}"), "node", "component"))
    assert {out[i] for i in range(21)} == {0} and out[100] == out[101] == 100


def test_sales(spark):
    df = spark.createDataFrame([(1, "a-1", 2000, 1, 5.0, "x"), (2, "A1", 2000, 2, 5.0, "y"), (3, None, 2000, 2, 5.0, None)], "i int, doc string, y int, m int, price double, book string")
    assert rows(sa.first_of_document(df, ["doc"], [c("i")]), "i") == [(1,), (3,)]
    keyed = df.withColumn("k", F.lit("t"))
    assert rows(sa.double_closings(keyed, ["k"], "y", "m", "price", ["book"], [c("i")]), "i", "double_closing") == [(1, True), (2, True), (3, False)]
    assert rows(sa.minted_ids(df, F.lit("US"), "doc", ["price"], [c("i")], "id"), "i", "id")[:2] == [(1, "US-A-1"), (2, "US-A1")]
    prices = spark.createDataFrame([("u", p) for p in [1.0] * 50 + [50000.0] * 50 + [None] * 10] + [("v", 7e5)], "u string, p double")
    assert rows(sa.nominal_price_floor(prices, "u", "p"), "u", "floor") == [("u", 1.0), ("v", 0.0)]


def test_groups(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "a", 3.0), (4, "b", 2.0), (5, None, 9.0), (6, "a", None)], "i int, k string, v double")
    assert rows(gr.percentile(df, "k", "v", "p"), "i", "p")[:4] == [(1, 1 / 3), (2, 2.5 / 3), (3, 2.5 / 3), (4, 1.0)]
    assert rows(gr.zscore(df, "k", c("v"), "z").where("i = 4"), "z") == [(None,)]
    assert rows(gr.impute(df, "k", "v", "mode").where("i = 6"), "v", "v_source") == [(3.0, "imputed")]
    assert rows(gr.rank_in(df, "k", "v", "i", "r"), "i", "r") == [(1, 3), (2, 1), (3, 2), (4, 1), (5, None), (6, 4)]


def test_tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "i int, p string")
    assert rows(tb.differences(a, a.distinct()), "i", "side") == [(1, "left")]
    assert rows(tb.replace_partitions(a, spark.createDataFrame([(9, "x")], "i int, p string"), "p"), "i") == [(2,), (9,)]
    scope = spark.createDataFrame([("US-MA-X",), ("US-MAX",), ("US",), (None,)], "a string")
    assert rows(scope, tb.covers(F.lit("US-MA"), c("a"))) == [(False,), (False,), (False,), (True,)]


def test_boxes_that_touch_dont_overlap(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, -5.0, -5.0, -1.0, -1.0)], "a int, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame([(1, 10.0, 0.0, 20.0, 10.0), (2, 5.0, 5.0, 15.0, 15.0), (3, -4.0, -4.0, 1.0, 1.0)], "b int, xmin double, ymin double, xmax double, ymax double")
    for size in (1.0, 7.0, 100.0):
        assert rows(ge.overlay(a, b, "a", "b", size), "a", "b", "area") == [(1, 2, 25.0), (1, 3, 1.0), (2, 3, 9.0)]
    assert spark.range(1).select(ge.quadkey(F.lit(41.85), F.lit(-87.65), 7)).first()[0] == "0302222"


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text(' id ,name\n1," a "\n2,N/A\n')
    (tmp_path / "f.txt").write_text("001 abc  \n002      \n")
    (tmp_path / "g.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": 1, "s": {"q": 2}}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    assert rows(readers.read_table(spark, str(tmp_path / "t.csv"), null_values=["N/A"]), "id", "name") == [("1", " a "), ("2", None)]
    assert rows(readers.read_table(spark, str(tmp_path / "f.txt"), "fixed", widths={"i": (1, 3), "t": (5, 5)}), "i", "t") == [("001", "abc"), ("002", None)]
    flat = readers.flatten(readers.read_table(spark, str(tmp_path / "g.geojson")))
    assert rows(flat, "n", "s_q", "geometry_type") == [(1, 2, "Point")]
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        readers.join_members([one, one.union(one).withColumnRenamed("v", "w")], "k")
    target = f"file://{tmp_path}/parts"
    store.write_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), target, "p")
    store.write_partitions(spark.createDataFrame([(3, "x")], "v int, p string"), target, "p")
    assert rows(spark.read.parquet(target), "v", "p") == [(2, "y"), (3, "x")]
    assert spark.createDataFrame([("CaÃ±on",), ("plain",)], "t string").select(readers.repair_mojibake(c("t"))).collect()[0][0] == "Cañon"


def test_recipe_checks():
    with pytest.raises(ValueError, match="unknown step"):
        rc.check({"source": "x", "pipeline": [{"step": "nope"}]})
    with pytest.raises(ValueError, match="belongs to"):
        rc.check({"source": "x", "pipeline": [{"step": "sort_rows", "by": ["a"]}, {"step": "declare_columns", "columns": {}}]})
    assert rc.patched({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert rc.dependencies({"source": "s", "pipeline": [{"step": "link_by_id", "reference": "r"}]}) == ["s", "r"]


def test_sale_pairs_need_no_exchange_of_pairs(spark):
    sales = spark.createDataFrame([(1, "deed", "A", 10, None, 5.0, 1, None, None), (2, "deed", "B", 10, None, 5.0, 2, None, None), (3, "deed", "C", 10, None, 7.0, 3, " a ", "correct"),
                                   (4, "assessor_last_sale", "assessor_last_sale:A", 10, None, 5.0, 4, None, None), (5, "assessor_last_sale", "x", 10, None, 5.0, 5, None, None)],
                                  "transaction_id int, kind string, document string, period int, day date, price double, read int, previous string, reason string")
    things = spark.createDataFrame([(i, thing) for i in range(1, 6) for thing in (["p"] if i == 2 else ["p", "q"])], "transaction_id int, thing string")
    out = sa.sale_record_pairs(sales, things, 0.5, corrections=("correct",))
    got = rows(out, "transaction_id", "other_transaction_id", "label")
    assert got == sorted([(4, 1, "deed_echo_document"), (4, 2, "deed_echo_period_price"), (5, 1, "deed_echo_period_price"), (5, 2, "deed_echo_period_price"), (5, 4, "roll_restated"), (1, 2, "double_closing"),
                          (1, 3, "restates_document"), (2, 3, "resale_within_window")], key=str)
    assert "min(rank" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_ranges_are_matched_without_their_pairs(spark):
    from cadastra.operators import parcels as pa

    spine = spark.createDataFrame([(1, "2-8"), (2, "4-6"), (3, "8-10"), (4, "7")], "i int, n string").withColumns({"s": F.lit("Oak Street"), "p": F.lit("t")})
    ref = spark.createDataFrame([(10, "2"), (10, "8"), (11, "4"), (12, "4"), (None, "6"), (13, "10")], "r int, n string").withColumns({"s": F.lit("OAK ST"), "p": F.lit("t")})
    out = pa.match_ranges(spine, ref, "i", "r", "n", "s", "p")
    assert rows(out, "i", "r") == [(1, 10)]
    many = ref.crossJoin(spark.range(50)).drop("id")
    joined = pa.match_ranges(spine, many, "i", "r", "n", "s", "p")
    assert rows(joined, "i", "r") == [(1, 10)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") >= 2


def test_median_of_a_table(spark):
    import random

    rng = random.Random(5)
    for values in ([1.0], [3.0, 1.0], [], [None], [2.0] * 9 + [5.0, None], [rng.choice([1.5, rng.uniform(-1e6, 1e6)]) for _ in range(20001)], [rng.uniform(0, 1) for _ in range(20000)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        out = gr.median_of(df, "v", "m")
        assert [tuple(r) for r in out.collect()] == [tuple(r) for r in df.agg(F.median("v")).collect()]
    assert "percentile(" not in out._jdf.queryExecution().optimizedPlan().toString().replace("percentile_approx(", "")
