"""Queries of parcel ids, spines, rolls, ranges of house numbers, and divided values."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import parcels as pa
from cadastra.plans.catalogue import load, query

c = F.col


@query(
    "parcel_ids",
    "with p as (select p_partkey, 'LOT-' || (p_partkey % 150) as derived, p_partkey % 150 || '/' || p_partkey % 2 || case when p_partkey % 150 < 20 then p_partkey // 150 else 0 end as source from part), m as (select derived as d, count(distinct source) > 1 as many from p group by 1) select p_partkey, case when not many then derived end as derived, many as twice, 'LOT' || (p_partkey % 150) as plain, case when p_partkey >= 10 then cast(p_partkey // 10 as varchar) || '.' || p_partkey % 10 end as local from p join m on d = derived",
)
def parcel_ids(spark, d):
    k = c("p_partkey")
    last = F.when(k % 150 < 20, F.floor(k / 150)).otherwise(0)
    rows = load(spark, d, "part").select("p_partkey", F.concat(F.lit("LOT-"), k % 150).alias("derived"), F.concat(k % 150, F.lit("/"), k % 2, last).alias("source"))
    flagged = pa.introduced_duplicates(rows, "derived", "source", "twice").withColumn("plain", pa.alnum(c("derived")))
    cleared = pa.without_introduced_duplicates(flagged, "derived", "source")
    return cleared.select("p_partkey", "derived", "twice", "plain", pa.local_id(k.cast("string"), r"(\d+)(\d)", "$1.$2").alias("local"))


@query("parcel_id_patterns", r"select unnest(['\d+-\d+', '[0-9A-Z-]+']) as pattern, unnest([avg(case when p_partkey % 50 <> 0 then 1.0 else 0.0 end), 1.0]) as share from part")
def parcel_id_patterns(spark, d):
    rows = load(spark, d, "part").select(F.concat(c("p_size"), F.when(c("p_partkey") % 50 == 0, "A").otherwise("-"), c("p_partkey")).alias("id"))
    return pa.id_patterns(rows, "id", [r"\d+-\d+", r"\d+", "[0-9A-Z-]+"])


@query("latest_vintage", "select o_orderkey from orders o where year(o_orderdate) = (select max(year(o_orderdate)) from orders i where i.o_custkey = o.o_custkey)")
def latest_vintage(spark, d):
    return pa.latest_vintage(load(spark, d, "orders").withColumn("y", F.year("o_orderdate")), ["o_custkey"], "y").select("o_orderkey")


@query("spine_union", "select c_custkey as k, 'a' as source from customer where c_custkey % 2 = 0 union all select c_custkey, 'b' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0 union all select null, 'b' from customer where c_custkey % 11 = 0")
def spine_union(spark, d):
    k = load(spark, d, "customer").select(c("c_custkey").alias("k"))
    b = k.where("k % 3 = 0").union(k.where("k % 11 = 0").select(F.lit(None).cast("long")))
    return pa.union_sources([("a", k.where("k % 2 = 0")), ("b", b)], "k").select("k", "source")


@query("spine_merge", "select c_custkey, case when c_custkey % 2 = 0 and c_custkey % 4 <> 0 then c_acctbal when c_custkey % 3 = 0 then -1.0 end as bal, case when c_custkey % 2 = 0 then c_name end as c_name, case when c_custkey % 3 = 0 then 'x' end as tag from customer where c_custkey % 2 = 0 or c_custkey % 3 = 0")
def spine_merge(spark, d):
    k = load(spark, d, "customer")
    base = k.where("c_custkey % 2 = 0").select("c_custkey", F.when(c("c_custkey") % 4 != 0, c("c_acctbal")).alias("bal"), "c_name")
    other = k.where("c_custkey % 3 = 0").select("c_custkey", F.lit(-1.0).alias("bal"), F.lit("x").alias("tag"))
    return pa.merge_on_id(base, other, "c_custkey")


@query("spine_id_column", "select 'o_orderkey' as best")
def spine_id_column(spark, d):
    best = pa.id_column(load(spark, d, "orders"), ["o_custkey", "o_orderkey", "o_orderstatus"])
    return spark.range(1).select(F.lit(best).alias("best"))


@query("panel_repeats", "with k as (select distinct o_custkey as k, cast(year(o_orderdate) as int) as y from orders) select a.y, round(case when exists (select 1 from k p where p.y = a.y - 1) then avg(case when b.k is not null then 1.0 else 0.0 end) end, 9) as share from k a left join k b on b.k = a.k and b.y = a.y - 1 group by 1")
def panel_repeats(spark, d):
    out = pa.repeat_share(load(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y")), "o_custkey", "y")
    return out.select("y", F.round("share", 9).alias("share"))


@query("stacked_lots", "select o_custkey, min(o_orderkey) as lot, case when count(*) > 1 then count(*) else 0 end as n_units, case when count(*) = 1 then min(o_totalprice) end as price from orders group by 1")
def stacked_lots(spark, d):
    rows = load(spark, d, "orders").select("o_custkey", c("o_orderkey").alias("lot"), c("o_orderstatus").alias("key"), c("o_totalprice").alias("price"))
    lots, _ = pa.split_stacked(rows, "o_custkey", "key", c("lot"), ["price"])
    return lots.select("o_custkey", "lot", "n_units", "price")


@query("stacked_units", "select o_orderkey as unit from orders where o_custkey in (select o_custkey from orders group by 1 having count(*) > 1)")
def stacked_units(spark, d):
    rows = load(spark, d, "orders").select("o_custkey", c("o_orderkey").alias("unit"), c("o_orderstatus").alias("key"))
    return pa.split_stacked(rows, "o_custkey", "key", c("unit"), [])[1].select("unit")


@query("last_sales", "select o_orderkey, cast(year(o_orderdate) as int) as roll, cast(year(o_orderdate) - i as int) as sale_year, cast(month(o_orderdate) as int) as sale_month, o_totalprice / i as price, 'last_sale' as sale_record_kind from orders, (select unnest([1, 2]) as i) where i = 1 or o_orderkey % 3 <> 0")
def last_sales(spark, d):
    y, m, p = F.year("o_orderdate"), F.month("o_orderdate"), c("o_totalprice")
    rows = load(spark, d, "orders").select("o_orderkey", y.alias("roll"), (y - 1).alias("y1"), m.alias("m1"), p.alias("p1"), F.when(c("o_orderkey") % 3 != 0, y - 2).alias("y2"), (p / 2).alias("p2"))
    return pa.last_sales(rows, "o_orderkey", "roll", [("y1", "m1", "p1"), ("y2", "m1", "p2")])


@query(
    "restated_sales",
    "with o as (select o_orderkey, o_custkey, year(o_orderdate) as y, o_orderpriority as doc from orders), f as (select *, first_value(doc) over w as fd, first_value(y) over w as fy from o window w as (partition by o_custkey order by y, doc rows between unbounded preceding and current row)) select o_orderkey, y > fy and doc <> fd as restated from f",
)
def restated_sales(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), c("o_orderpriority").alias("doc"), F.lit(1).alias("sale_year"), F.lit(1).alias("sale_month"), F.lit(1.0).alias("price"))
    return pa.restated(rows, "o_custkey", "y", "doc", "restated").select("o_orderkey", "restated")


@query(
    "outside_coverage",
    "with o as (select *, year(o_orderdate) as y, case when o_orderkey % 4 <> 0 then month(o_orderdate) end as m from orders), f as (select o_custkey % 20 as u, greatest(min(y * 12 + month(o_orderdate)), 23930) as a, max(y * 12 + month(o_orderdate)) - 0 as b from o where o_custkey % 20 < 15 group by 1) select o_orderkey from o left join f on u = o_custkey % 20 where not coalesce(y * 12 + coalesce(m, 1) >= a and y * 12 + coalesce(m, 12) <= b, false)",
)
def outside_coverage(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", (c("o_custkey") % 20).alias("u"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("mm"), F.when(c("o_orderkey") % 4 != 0, F.month("o_orderdate")).alias("m"))
    covered = pa.coverage_of(rows.where("u < 15"), "u", "y", "mm", first=23930)
    return pa.outside_coverage(rows, covered, "u", "y", "m").select("o_orderkey")


@query("prior_roll", "select c_custkey, coalesce(case when c_custkey % 2 = 0 then c_acctbal end, case when c_custkey % 3 = 0 then 1.0 end) as bal, case when c_custkey % 2 <> 0 and c_custkey % 3 = 0 then 'prior_roll' end as bal_source from customer")
def prior_roll(spark, d):
    k = load(spark, d, "customer")
    return pa.fill_from_prior(k.select("c_custkey", F.when(c("c_custkey") % 2 == 0, c("c_acctbal")).alias("bal")), k.where("c_custkey % 3 = 0").select("c_custkey", F.lit(1.0).alias("bal")), "c_custkey", ["bal"]).select("c_custkey", "bal", "bal_source")


@query("not_on_roll", "select c_custkey, case when c_custkey % 4 <> 0 then c_acctbal end as bal, case when c_custkey % 4 = 0 then 'not_on_roll' end as bal_source from customer")
def not_on_roll(spark, d):
    k = load(spark, d, "customer")
    return pa.not_on_roll(k.select("c_custkey", c("c_acctbal").alias("bal")), k.where("c_custkey % 4 <> 0"), "c_custkey", ["bal"]).select("c_custkey", "bal", "bal_source")


@query("duplicate_points", "select event_id, row_number() over (partition by user_id % 10, event_id % 7 order by event_type, event_id) > 1 as again from events")
def duplicate_points(spark, d):
    rows = load(spark, d, "events").select("event_id", "event_type", (c("user_id") % 10).alias("x"), (c("event_id") % 7).alias("y"))
    return pa.duplicate_points(rows, "x", "y", c("event_type"), "event_id", "again").select("event_id", "again")


@query("address_ranges", "with r as (select c_custkey, c_custkey % 100 as n, c_nationkey as p from customer), m as (select s_suppkey as s, c_custkey as k from supplier join r on p = s_nationkey and n in (s_suppkey % 90, s_suppkey % 90 + 6)) select s as s_suppkey, min(k) as c_custkey from m group by 1 having count(distinct k) = 1")
def address_ranges(spark, d):
    n = c("s_suppkey") % 90
    spine = load(spark, d, "supplier").select("s_suppkey", c("s_nationkey").alias("place"), F.concat(n, F.lit("-"), n + 6).alias("number"), F.lit("Oak Street").alias("street"))
    ref = load(spark, d, "customer").select("c_custkey", c("c_nationkey").alias("place"), (c("c_custkey") % 100).cast("string").alias("number"), F.lit("OAK ST").alias("street"))
    return pa.match_ranges(spine, ref, "s_suppkey", "c_custkey", "number", "street", "place")


@query("address_keys", "select s_suppkey, case when s_nationkey % 2 = 0 then s_nationkey || '|OAK ST|' || s_suppkey end as town, 'C1|OAK ST|' || s_suppkey as county, lpad(cast(s_suppkey as varchar), 5, '0') as zip, case when s_suppkey % 2 = 0 then 'roll' end as zip_conflict from supplier")
def address_keys(spark, d):
    town, county = pa.address_keys(c("s_suppkey").cast("string"), F.lit("Oak Street"), F.when(c("s_nationkey") % 2 == 0, c("s_nationkey").cast("string")), F.lit("C1"))
    own = F.lpad(c("s_suppkey").cast("string"), 5, "0")
    code, conflict = pa.first_postal_code([("blank", F.lit(" ")), ("point", own), ("roll", F.when(c("s_suppkey") % 2 == 0, "99999").otherwise(own))])
    return load(spark, d, "supplier").select("s_suppkey", town.alias("town"), county.alias("county"), code.alias("zip"), conflict.alias("zip_conflict"))


SHARES = "(select l_orderkey as a, l_partkey as lot, sum(l_quantity) as area, sum(l_quantity) / sum(sum(l_quantity)) over (partition by l_orderkey) as share from lineitem group by 1, 2)"


def _account_links(spark, d):
    rows = load(spark, d, "lineitem").groupBy(c("l_orderkey").alias("a"), c("l_partkey").alias("lot")).agg(F.sum("l_quantity").alias("area"))
    return pa.area_shares(rows, "a", "area")


@query("divided_accounts", f"select lot, round(sum(o_totalprice * share), 4) as value from {SHARES} join orders on o_orderkey = a group by 1")
def divided_accounts(spark, d):
    accounts = load(spark, d, "orders").select(c("o_orderkey").alias("a"), c("o_totalprice").alias("value"))
    return pa.divided(_account_links(spark, d), accounts, "a", "lot", ["value"]).select("lot", F.round("value", 4).alias("value"))


@query("conserved_accounts", f"select 'lost' as \"column\", round(sum(o_totalprice), 0) as before, round(sum(o_totalprice) filter (where o_orderkey % 2 = 0), 0) as after from orders where o_orderkey in (select l_orderkey from lineitem)")
def conserved_accounts(spark, d):
    """Values of accounts that have lots add up on these; those of half the accounts don't."""
    links = _account_links(spark, d)
    o = load(spark, d, "orders").join(links.select(c("a").alias("o_orderkey")).distinct(), "o_orderkey").select(c("o_orderkey").alias("a"), c("o_totalprice").alias("kept"), c("o_totalprice").alias("lost"))
    half = pa.divided(links, o.withColumn("lost", F.when(c("a") % 2 == 0, c("lost"))), "a", "lot", ["kept", "lost"])
    return pa.not_conserved(half, o, ["kept", "lost"]).select("column", F.round("before", 0).alias("before"), F.round("after", 0).alias("after"))


@query("identity_failures", "select l_orderkey, l_linenumber from lineitem where abs(l_quantity * 10 + l_tax - l_extendedprice) > 500")
def identity_failures(spark, d):
    rows = load(spark, d, "lineitem").withColumn("ten", c("l_quantity") * 10)
    return pa.identity_failures(rows, ["ten", "l_tax"], "l_extendedprice", 500).select("l_orderkey", "l_linenumber")


@query("linked_ids", "with s as (select l_orderkey as k, l_suppkey as s, max(l_quantity) as q from lineitem group by 1, 2) select k as l_orderkey, string_agg(cast(s as varchar), '|' order by -q, cast(s as varchar)) as suppliers, string_agg(case when s % 2 = 0 then cast(s as varchar) end, '|' order by -q, cast(s as varchar)) as even from s group by 1")
def linked_ids(spark, d):
    """All suppliers of an order, and those left when only even ones are kept."""
    rows = load(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.max("l_quantity").alias("q"))
    listed = pa.linked_ids(rows, "l_orderkey", "l_suppkey", "q", "suppliers")
    even = load(spark, d, "supplier").where("s_suppkey % 2 = 0")
    return pa.keep_ids(listed.withColumn("even", c("suppliers")), "even", even, "s_suppkey", "l_orderkey")


@query("merged_layers", "select c_custkey, case when c_custkey % 2 = 0 then c_acctbal when c_custkey % 3 = 0 then 1.0 when c_custkey % 5 = 0 then 2.0 end as bal, case when c_custkey % 5 = 0 then 'five' end as note from customer")
def merged_layers(spark, d):
    k = load(spark, d, "customer")
    base = k.select("c_custkey", F.when(c("c_custkey") % 2 == 0, c("c_acctbal")).alias("bal"))
    layers = [k.where("c_custkey % 3 = 0").select("c_custkey", F.lit(1.0).alias("bal")), k.where("c_custkey % 5 = 0").select("c_custkey", F.lit(2.0).alias("bal"), F.lit("five").alias("note"))]
    return pa.merge_layers(base, layers, "c_custkey").select("c_custkey", "bal", "note")


@query("longest_prefix", "select p_partkey, case when cast(p_partkey as varchar) like '12%' then 'twelve' when cast(p_partkey as varchar) like '1%' then 'one' when cast(p_partkey as varchar) like '345%' then 'more' end as class from part")
def longest_prefix(spark, d):
    rules = spark.createDataFrame([("1", "one"), ("12", "twelve"), ("345", "more")], "prefix string, class string")
    return pa.longest_prefix(load(spark, d, "part").select("p_partkey", c("p_partkey").cast("string").alias("code")), "code", rules, "prefix", "class", "class").select("p_partkey", "class")


@query("footprints", "select l_orderkey, count(*) as n_footprints, sum(l_quantity) as footprint_area, max(l_quantity) as largest_footprint, round(avg(case when l_quantity <= 10 then 1.0 else 0.0 end), 9) as small_share, round(avg(case when l_linenumber >= 3 then 1.0 else 0.0 end), 9) as long_share from lineitem group by 1")
def footprints(spark, d):
    out = pa.footprint_summary(load(spark, d, "lineitem"), "l_orderkey", "l_quantity", "l_linenumber", 10)
    return out.withColumns({x: F.round(x, 9) for x in ("small_share", "long_share")})


@query("footprint_roles", "with w as (select l_orderkey, l_partkey, l_quantity, l_linenumber = 1 as dw, max(case when l_linenumber = 1 and l_orderkey % 2 = 0 then 1 else 0 end) over (partition by l_orderkey) as has, max(l_quantity) over (partition by l_orderkey) as top from lineitem) select l_orderkey, l_partkey, l_quantity, case when dw and l_orderkey % 2 = 0 then 'primary' when has = 1 then 'secondary' when l_quantity >= 0.5 * top then 'primary' else 'secondary' end as role from w")
def footprint_roles(spark, d):
    rows = load(spark, d, "lineitem").withColumn("points", F.when((c("l_linenumber") == 1) & (c("l_orderkey") % 2 == 0), 1))
    return pa.footprint_roles(rows, "l_partkey", "l_orderkey", "l_quantity", "points").select("l_orderkey", "l_partkey", "l_quantity", "role")


@query("snapped_links", "with s as (select l_orderkey as e, l_partkey as p, sum(l_quantity) as q from lineitem group by 1, 2), h as (select *, q / sum(q) over (partition by e) as share from s), r as (select *, row_number() over (partition by e order by share desc, p) = 1 as main from h), m as (select p as mp, min(e) as lo, max(e) as hi from r where main group by 1), t as (select *, main or (coalesce(lo <> e or hi <> e, false) and share <= 0.15) as small from r left join m on mp = p) select e, p from (select *, min(case when small then 1 else 0 end) over (partition by e) as every from t) where main or every = 0")
def snapped_links(spark, d):
    from pyspark.sql.window import Window

    rows = load(spark, d, "lineitem").groupBy(c("l_orderkey").alias("e"), c("l_partkey").alias("p")).agg(F.sum("l_quantity").alias("q"))
    shared = rows.withColumn("share", c("q") / F.sum("q").over(Window.partitionBy("e")))
    return pa.snapped(shared, "e", "p", "share", 0.15).select("e", "p")


@query("unit_link_keys", "with u as (select l_orderkey as unit_id, case when l_orderkey % 3 = 0 then 'K' || l_orderkey end as key, l_returnflag as lot from lineitem), n as (select unit_id as i, count(distinct lot) as n, min(lot) as lot from u group by 1) select u.unit_id, coalesce(key, case when n = 1 then n.lot end) as link from u join n on i = u.unit_id")
def unit_link_keys(spark, d):
    rows = load(spark, d, "lineitem").select(c("l_orderkey").alias("unit_id"), F.when(c("l_orderkey") % 3 == 0, F.concat(F.lit("K"), "l_orderkey")).alias("key"), c("l_returnflag").alias("lot"))
    return pa.link_key(rows, "key", "lot", "link").select("unit_id", "link")
