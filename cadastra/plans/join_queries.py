"""Queries of links, as-of joins, cascades and sale records."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import links as ln
from cadastra.operators import sales as sa
from cadastra.plans.catalogue import load, query

c = F.col


def _orders(spark, d):
    return load(spark, d, "orders")


def _lines(spark, d):
    return load(spark, d, "lineitem")


@query(
    "link_by_id_attributes",
    """with n as (select l_orderkey, sum(l_quantity) as qty, min(l_returnflag) as flag from lineitem group by 1), r as (select avg(case when qty is not null then 1.0 else 0.0 end) as reach from orders left join n on l_orderkey = o_orderkey)
    select o_orderkey, case when (select reach from r) >= 0.5 then coalesce(flag, o_orderstatus) else coalesce(nullif(trim(o_orderstatus), ''), flag) end as status, qty as quantity from orders left join n on l_orderkey = o_orderkey""",
)
def link_by_id_attributes(spark, d):
    spine = _orders(spark, d).select("o_orderkey", c("o_orderstatus").alias("status"))
    ref = _lines(spark, d).select(c("l_orderkey").alias("o_orderkey"), c("l_returnflag").alias("status"), c("l_quantity").alias("quantity"))
    return ln.link_by_id(spine, ref, "o_orderkey", {"status": "min", "quantity": "sum"}, F.lit(0))


@query("link_by_id_fill", "select c_custkey, coalesce(c_acctbal, 0) as c_acctbal, o.spent from customer left join (select o_custkey, round(sum(o_totalprice), 2) as spent from orders group by 1) o on o_custkey = c_custkey")
def link_by_id_fill(spark, d):
    ref = _orders(spark, d).select(c("o_custkey").alias("c_custkey"), F.lit(0.0).alias("c_acctbal"), c("o_totalprice").alias("spent"))
    out = ln.link_by_id(load(spark, d, "customer").select("c_custkey", "c_acctbal"), ref, "c_custkey", {"c_acctbal": "max", "spent": "sum"}, F.lit(0), mode="fill")
    return out.withColumn("spent", F.round("spent", 2))


@query("link_by_id_aggregate", "select o_orderkey, max(l_extendedprice) as price_new, round(avg(l_discount), 9) as discount_new from orders left join lineitem on l_orderkey = o_orderkey group by 1")
def link_by_id_aggregate(spark, d):
    ref = _lines(spark, d).select(c("l_orderkey").alias("o_orderkey"), c("l_extendedprice").alias("price"), c("l_discount").alias("discount"))
    out = ln.link_by_id(_orders(spark, d).select("o_orderkey"), ref, "o_orderkey", {"price": "max", "discount": "mean"}, F.lit(0), mode="aggregate")
    return out.withColumn("discount_new", F.round("discount_new", 9))


@query("link_by_id_count", "select c_custkey, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1")
def link_by_id_count(spark, d):
    return ln.link_by_id(load(spark, d, "customer").select("c_custkey"), _orders(spark, d).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {}, F.lit(0), mode="count")


@query("link_by_id_flag", "select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as linked from customer")
def link_by_id_flag(spark, d):
    return ln.link_by_id(load(spark, d, "customer").select("c_custkey"), _orders(spark, d).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {}, F.lit(0), mode="flag")


@query("link_degenerate_keys", """with l as (select *, case when l_linenumber = 1 then l_returnflag else cast(l_orderkey as varchar) end as k from lineitem where l_linenumber <> 7)
    select l_orderkey, l_linenumber from l where k not in (select k from l group by 1 having count(*) > greatest(100, (select count(*) * 0.001 from l)) and k <> 'R') and k <> '3'""")
def link_degenerate_keys(spark, d):
    """First lines have one of three flags as key, far too many rows each; one of the flags is the key of just one row of the spine."""
    rows = _lines(spark, d).where("l_linenumber <> 7").withColumn("k", F.when(c("l_linenumber") == 1, c("l_returnflag")).otherwise(c("l_orderkey").cast("string")))
    spine = load(spark, d, "region").select(F.when(c("r_regionkey") == 0, "R").otherwise("A").alias("k"))
    return ln.blank_keys(rows, "k", ("3",), spine=spine).select("l_orderkey", "l_linenumber")


def _pairs(spark, d):
    rows = _lines(spark, d).groupBy(c("l_partkey").alias("part"), c("l_suppkey").alias("supplier")).agg(F.sum("l_quantity").alias("area"))
    return ln.apportion_shares(rows, "part", "area")


PAIRS = "(select l_partkey as part, l_suppkey as supplier, sum(l_quantity) as area, sum(l_quantity) / sum(sum(l_quantity)) over (partition by l_partkey) as share from lineitem group by 1, 2)"


@query("link_table_build", "select distinct l_orderkey, o_custkey, 'order' as link_method from lineitem join orders on l_orderkey = o_orderkey")
def link_table_build(spark, d):
    a = _lines(spark, d).withColumn("key", c("l_orderkey"))
    b = _orders(spark, d).withColumn("key", c("o_orderkey"))
    return ln.link_table(a, b, "key", "l_orderkey", "o_custkey", "order")


@query("apportion_shares", f"select part, supplier, round(share, 9) as share from {PAIRS}")
def apportion_shares(spark, d):
    return _pairs(spark, d).select("part", "supplier", F.round("share", 9).alias("share"))


@query("apportion_values", f"select supplier, round(sum(round_even(p_retailprice * 1.00073 * share, 2)), 2) as value from {PAIRS} join part on p_partkey = part group by 1")
def apportion_values(spark, d):
    values = load(spark, d, "part").select(c("p_partkey").alias("part"), (c("p_retailprice") * 1.00073).alias("value"))
    return ln.apportion_values(_pairs(spark, d), values, "part", "supplier", "value").withColumn("value", F.round("value", 2))


def _write(name: str, mode: str, sql: str) -> None:
    @query(f"aggregate_from_entities_{name}", f"with s as (select o_custkey, max(o_totalprice) as best from orders group by 1) select c_custkey, {sql} as c_acctbal from customer left join s on o_custkey = c_custkey")
    def run(spark, d):
        best = _orders(spark, d).groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
        return ln.from_entities(load(spark, d, "customer").select("c_custkey", "c_acctbal"), best, "c_custkey", ["c_acctbal"], mode)


_write("fill", "fill", "coalesce(c_acctbal, best)")
_write("replace", "replace", "best")
_write("prefer", "prefer", "coalesce(best, c_acctbal)")
_write("recover", "recover", "case when (c_acctbal is null or c_acctbal <= 0) and best > 0 then best else c_acctbal end")

AS_OF = """with p as (select user_id, ts, max(value) as price from events where event_type = 'purchase' group by 1, 2), v as (select event_id, user_id, ts from events where event_type = 'view')
select v.event_id, p.price, p.ts as at, case when p.ts is null then null when p.ts = v.ts then 'exact' else '{0}_fallback' end as match_type from v asof left join p on v.user_id = p.user_id and v.ts {1} p.ts"""


def _as_of(direction: str):
    def run(spark, d):
        e = load(spark, d, "events")
        prices = e.where("event_type = 'purchase'").groupBy("user_id", c("ts").alias("at")).agg(F.max("value").alias("price"))
        views = e.where("event_type = 'view'").select("event_id", "user_id", "ts")
        return ln.as_of(views, prices, ["user_id"], "ts", "at", ["price"], direction).select("event_id", "price", "at", "match_type")

    return run


query("asof_backward", AS_OF.format("backward", ">="))(_as_of("backward"))
query("asof_forward", AS_OF.format("forward", "<="))(_as_of("forward"))


@query(
    "transaction_cascade",
    """with u as (select o_totalprice as k, min(o_orderkey) as r from orders group by 1 having count(*) = 1), n as (select c_custkey as k, min(c_nationkey) as r from customer group by 1 having count(*) = 1),
    s as (select s_suppkey as k, min(s_suppkey) as r from supplier group by 1 having count(*) = 1)
    select l_orderkey, l_linenumber, coalesce(u.r, n.r, s.r) as target, case when u.r is not null then 'price' when n.r is not null then 'customer' when s.r is not null then 'supplier' end as link_method
    from lineitem left join u on u.k = l_extendedprice left join n on n.k = l_partkey left join s on s.k = l_suppkey""",
)
def transaction_cascade(spark, d):
    passes = [
        ("price", _orders(spark, d).select(c("o_totalprice").alias("l_extendedprice"), c("o_orderkey").alias("r")), "l_extendedprice", "r"),
        ("customer", load(spark, d, "customer").select(c("c_custkey").alias("l_partkey"), c("c_nationkey").cast("long").alias("r")), "l_partkey", "r"),
        ("supplier", load(spark, d, "supplier").select(c("s_suppkey").alias("l_suppkey"), c("s_suppkey").alias("r")), "l_suppkey", "r"),
    ]
    out = ln.cascade(_lines(spark, d), "l_orderkey", passes, "target")
    return out.select("l_orderkey", "l_linenumber", "target", "link_method")


@query("dedup_documents", "select min(o_orderkey) as o_orderkey from orders group by o_custkey, upper(o_orderstatus), regexp_replace(upper(o_orderpriority), '[^A-Z0-9]', '', 'g')")
def dedup_documents(spark, d):
    return sa.first_of_document(_orders(spark, d), ["o_custkey", "o_orderstatus", "o_orderpriority"], [c("o_orderkey")]).select("o_orderkey")


@query("document_id", "select o_orderkey, concat(o_orderstatus, '-', year(o_orderdate), '-', o_custkey) as document from orders")
def document_id(spark, d):
    missing = F.lit(None).cast("string")
    ids = sa.document_id([[missing, c("o_orderkey")], [F.year("o_orderdate"), F.concat(F.lit("00"), c("o_custkey"))]], c("o_orderstatus"), "none")
    return _orders(spark, d).select("o_orderkey", ids.alias("document"))


@query("parcels_per_document", "select l_orderkey, l_linenumber, n from lineitem join (select l_orderkey as k, count(distinct l_partkey) as n from lineitem group by 1) on k = l_orderkey")
def parcels_per_document(spark, d):
    return sa.parcels_per_document(_lines(spark, d), "l_partkey", "l_orderkey", "n").select("l_orderkey", "l_linenumber", "n")


@query(
    "multi_parcel_fold",
    "select l_orderkey, case when count(distinct l_returnflag) = 1 then min(l_returnflag) end as l_returnflag, case when count(distinct l_linestatus) = 1 then min(l_linestatus) end as l_linestatus, case when count(distinct l_tax) = 1 then min(l_tax) end as l_tax, count(*) as n from lineitem group by 1",
)
def multi_parcel_fold(spark, d):
    return sa.fold_documents(_lines(spark, d), "l_orderkey", ["l_returnflag", "l_linestatus", "l_tax"], c("l_linenumber"), "n")


@query(
    "mint_ids",
    """with b as (select o_orderkey, concat('US-', upper(o_orderstatus), '-', o_custkey) as base from orders), n as (select *, row_number() over (partition by base order by o_orderkey) as k from b)
    select o_orderkey, case when k > 1 then concat(base, '-', k) else base end as id from n""",
)
def mint_ids(spark, d):
    rows = _orders(spark, d).withColumn("doc", F.concat_ws("/", "o_orderstatus", "o_custkey"))
    return sa.minted_ids(rows, F.lit("US"), "doc", ["o_totalprice"], [c("o_orderkey")], "id").select("o_orderkey", "id")


@query(
    "double_closings",
    """with o as (select *, year(o_orderdate) * 12 + month(o_orderdate) as p from orders), w as (select *, lead(p) over q - p as gap, lead(o_orderstatus) over q as s, lead(o_orderpriority) over q as r from o window q as (partition by o_custkey order by p, o_orderkey))
    select o_orderkey, coalesce(gap between 0 and 6 and s = o_orderstatus and (r is null or r <> o_orderpriority), false) as double_closing from w""",
)
def double_closings(spark, d):
    rows = _orders(spark, d).withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    return sa.double_closings(rows, ["o_custkey"], "y", "m", "o_orderstatus", ["o_orderpriority"], [c("o_orderkey")], 6).select("o_orderkey", "double_closing")


@query(
    "duplicate_pairs",
    """with s as (select o_custkey as t, o_orderkey as i, year(o_orderdate) * 12 + month(o_orderdate) as p, o_orderstatus as v, o_orderpriority as d from orders),
    x as (select a.i as i, b.i as j, a.p as p, b.p as q, case when a.d = b.d then 0 when a.p = b.p and a.v = b.v then 1 when a.v = b.v and abs(a.p - b.p) between 1 and 2 then 2 end as rank from s a join s b on a.t = b.t and a.i < b.i)
    select case when p > q then j else i end as earlier, case when p > q then i else j end as later, case rank when 0 then 'same_document' when 1 then 'same_period_price' else 'resale_within_window' end as label from x where rank is not null""",
)
def duplicate_pairs(spark, d):
    rows = _orders(spark, d).withColumn("period", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    return sa.duplicate_pairs(rows, "o_custkey", "o_orderkey", "period", "o_orderstatus", "o_orderpriority", 2)


@query(
    "nominal_floor",
    """with t as (select l_returnflag as u, count(*) as n from lineitem group by 1), h as (select l_returnflag as u, l_quantity as p, count(*) as n from lineitem where l_quantity between 0 and 56 group by 1, 2),
    a as (select a.u, a.p, a.n, sum(b.n) as around from h a join h b on a.u = b.u and b.p > 0.9 * a.p - 1 and b.p < 1.1 * a.p + 1 where a.p <= 50 group by 1, 2, 3)
    select t.u as l_returnflag, coalesce((select max(p) from a where a.u = t.u and a.n >= 0.01 * t.n and (around - a.n) * 0.4 <= a.n), 0.0) as floor from t""",
)
def nominal_floor(spark, d):
    return sa.nominal_price_floor(_lines(spark, d), "l_returnflag", "l_quantity", cap=50.0, min_share=0.01, isolation=0.4)


@query(
    "connected_components",
    """with m as (select c_nationkey as nk, min('c' || c_custkey) as component from customer group by 1)
    select 'c' || c_custkey as node, component from customer join m on nk = c_nationkey union all select 'n' || nk, component from m
    union all select 'o' || o_orderkey, component from orders join customer on c_custkey = o_custkey join m on nk = c_nationkey""",
)
def connected_components(spark, d):
    """Orders linked to their customers, and these to their nations."""
    from cadastra.sources.store import scratch

    customers = load(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("n"), "c_nationkey").alias("b"))
    orders = _orders(spark, d).select(F.concat(F.lit("o"), "o_orderkey").alias("a"), F.concat(F.lit("c"), "o_custkey").alias("b"))
    return ln.chained_components(customers.union(orders), "a", "b", scratch(spark))


# One key for all, and missing keys and dates: the hot cases of an as-of join.
HOT = """with p as (select case when user_id % 3 = 0 then 0 else user_id end as u, ts, max(value) as price from events where event_type = 'purchase' group by 1, 2),
v as (select event_id, case when user_id % 3 = 0 then 0 when user_id % 7 = 0 then null else user_id end as u, case when event_id % 11 <> 0 then ts end as ts from events where event_type <> 'purchase')
select v.event_id, p.price, p.ts as at, case when v.u is null then 'no_key' when v.ts is null then 'no_date' when p.ts is null then null when p.ts = v.ts then 'exact' else '{0}_fallback' end as match_type from v asof left join p on v.u = p.u and v.ts {1} p.ts"""


def _hot(direction: str):
    def run(spark, d):
        e = load(spark, d, "events")
        hot = F.when(c("user_id") % 3 == 0, 0)
        prices = e.where("event_type = 'purchase'").groupBy(hot.otherwise(c("user_id")).alias("u"), c("ts").alias("at")).agg(F.max("value").alias("price"))
        views = e.where("event_type <> 'purchase'").select("event_id", hot.when(c("user_id") % 7 != 0, c("user_id")).alias("u"), F.when(c("event_id") % 11 != 0, c("ts")).alias("ts"))
        return ln.as_of(views, prices, ["u"], "ts", "at", ["price"], direction).select("event_id", "price", "at", "match_type")

    return run


query("asof_hot_backward", HOT.format("backward", ">="))(_hot("backward"))
query("asof_hot_forward", HOT.format("forward", "<="))(_hot("forward"))


@query(
    "asof_exact",
    """with p as (select o_custkey as k, cast(year(o_orderdate) as int) as y, min(o_totalprice) as price from orders group by 1, 2) select c_custkey, p.price, p.y as at, case when p.y is not null then 'exact' end as match_type from customer left join p on k = c_custkey and y = 1995""",
)
def asof_exact(spark, d):
    people = load(spark, d, "customer").select("c_custkey", F.lit(1995).alias("year"))
    prices = _orders(spark, d).select(c("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("at"), c("o_totalprice").alias("price"))
    return ln.as_of(people, prices, ["c_custkey"], "year", "at", ["price"], "exact").select("c_custkey", "price", "at", "match_type")


@query(
    "asof_ordered_keys",
    """with p as (select o_custkey as k, o_orderstatus as s, cast(year(o_orderdate) as int) as y, min(o_totalprice) as price from orders group by 1, 2, 3), q as (select k, y, min(price) as price from p group by 1, 2),
    n as (select c_custkey, case when c_custkey % 2 = 0 then 'P' else 'F' end as s, 1995 as year from customer),
    a as (select n.*, p.price, p.y as "at" from n asof left join p on n.c_custkey = p.k and n.s = p.s and n.year >= p.y),
    b as (select r.c_custkey, q.price, q.y as "at" from (select * from a where "at" is null) r asof left join q on r.c_custkey = q.k and r.year >= q.y)
    select c_custkey, price, "at", case when "at" = 1995 then 'exact' else 'backward_fallback' end as match_type from a where "at" is not null
    union all select c_custkey, price, "at", case when "at" is null then null when "at" = 1995 then 'exact' else 'backward_fallback' end from b""",
)
def asof_ordered_keys(spark, d):
    """By customer and status first, by customer alone then."""
    people = load(spark, d, "customer").select("c_custkey", F.when(c("c_custkey") % 2 == 0, "P").otherwise("F").alias("status"), F.lit(1995).alias("year"))
    rows = _orders(spark, d).groupBy(c("o_custkey").alias("c_custkey"), c("o_orderstatus").alias("status"), F.year("o_orderdate").alias("at")).agg((-F.min("o_totalprice")).alias("minus"))
    out = ln.as_of_by_turns(people, rows, [["c_custkey", "status"], ["c_custkey"]], "year", "at", ["minus"])
    return out.select("c_custkey", (-c("minus")).alias("price"), "at", "match_type")


@query(
    "link_by_id_degenerate",
    """with l as (select case when l_linenumber = 1 then 1 else l_orderkey end as k, l_quantity as q from lineitem), good as (select k from l group by 1 having count(*) <= greatest(100, (select count(*) * 0.001 from lineitem)))
    select o_orderkey, count(q) as n from orders left join (select * from l where k in (select k from good)) on k = o_orderkey group by 1""",
)
def link_by_id_degenerate(spark, d):
    """Counts by key, the key that first lines share left out: two rows of the spine have it."""
    ref = _lines(spark, d).select(F.when(c("l_linenumber") == 1, 1).otherwise(c("l_orderkey")).alias("o_orderkey"), "l_quantity")
    spine = _orders(spark, d).select("o_orderkey")
    again = spine.union(spine.where("o_orderkey = 1"))
    return ln.link_by_id(again, ref, "o_orderkey", {}, F.lit(0), mode="count", placeholders=()).distinct()


RECORDS = """(select o_orderkey as i, case when o_orderkey % 3 = 0 then 'assessor_last_sale' else 'deed' end as kind, case when o_orderkey % 3 = 0 then 'assessor_last_sale:D' || (o_orderkey + 1) else 'D' || o_orderkey end as doc, cast(year(o_orderdate) * 12 + month(o_orderdate) as int) as p,
case when o_orderkey % 2 = 0 then cast(o_orderdate as date) end as day, cast(o_custkey % 3 as double) as price, case when o_orderkey % 5 = 0 then 'D' || (o_orderkey - 5) end as prev, case when o_orderkey % 10 = 0 then 'correct' end as reason, o_custkey % 200 as thing from orders)"""


@query(
    "sale_record_pairs",
    f"""with s as {RECORDS}, x as (select a.i as a, b.i as b, case when a.kind <> b.kind and a.kind like 'a%' and a.doc = 'assessor_last_sale:' || b.doc then 0
    when a.kind like 'a%' and b.kind = 'deed' and a.thing = b.thing and a.p = b.p and a.price = b.price then 1
    when a.kind like 'a%' and b.kind like 'a%' and a.thing = b.thing and a.p = b.p and a.price = b.price and a.i > b.i then 2
    when a.kind = 'deed' and b.kind = 'deed' and a.thing = b.thing and a.price > 0.5 and a.price = b.price and (a.p = b.p and a.i < b.i or a.p + 1 = b.p) and (a.day is null or b.day is null or a.day = b.day) then 3
    when a.kind = 'deed' and b.kind = 'deed' and b.reason = 'correct' and b.prev = a.doc and a.thing = b.thing then 4
    when a.kind = 'deed' and b.kind = 'deed' and a.thing = b.thing and a.price > 0.5 and b.price > 0.5 and a.price <> b.price and (a.p = b.p and a.i < b.i or a.p + 1 = b.p) and (a.day is null or b.day is null or a.day = b.day) then 5 end as k
    from s a join s b on a.i <> b.i and (a.thing = b.thing or a.doc = 'assessor_last_sale:' || b.doc))
    select a as transaction_id, b as other_transaction_id, case k when 0 then 'deed_echo_document' when 1 then 'deed_echo_period_price' when 2 then 'roll_restated' when 3 then 'double_closing' when 4 then 'restates_document' else 'resale_within_window' end as label from x where k is not null""",
)
def sale_record_pairs(spark, d):
    k = c("o_orderkey")
    rows = _orders(spark, d).select(
        k.alias("transaction_id"), F.when(k % 3 == 0, "assessor_last_sale").alias("kind"), F.when(k % 3 == 0, F.concat(F.lit("assessor_last_sale:D"), k + 1)).otherwise(F.concat(F.lit("D"), k)).alias("document"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("period"), F.when(k % 2 == 0, F.to_date("o_orderdate")).alias("day"), (c("o_custkey") % 3).cast("double").alias("price"), k.alias("read"),
        F.when(k % 5 == 0, F.concat(F.lit("D"), k - 5)).alias("previous"), F.when(k % 10 == 0, "correct").alias("reason"),
    )
    links = _orders(spark, d).select(k.alias("transaction_id"), (c("o_custkey") % 200).alias("parcel_id"), F.lit("key").alias("link_method"))
    stacked = links.where("transaction_id % 2 = 0").select("transaction_id", F.lit(1).alias("property_id"), F.lit("stacked_units").alias("link_method"))
    return sa.sale_record_pairs(rows, sa.sale_things(stacked, links, "transaction_id"), 0.5, corrections=("correct",))
