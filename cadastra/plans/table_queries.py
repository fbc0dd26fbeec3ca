"""Queries of set operations, filters, reconciliation, deflation, validation, admin ids and redaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import tables as tb
from cadastra.operators import validation as va
from cadastra.plans.catalogue import load, query

c = F.col


def _orders(spark, d):
    return load(spark, d, "orders").withColumn("year", F.year("o_orderdate"))


@query("partition_union", "select distinct l_suppkey, l_returnflag from lineitem")
def partition_union(spark, d):
    rows = load(spark, d, "lineitem").select("l_suppkey", "l_returnflag")
    return tb.union_partitions([rows.where(c("l_returnflag") == f) for f in ("A", "N", "R")])


@query("partition_replace", "select o_orderkey, cast(year(o_orderdate) as int) as year, case when year(o_orderdate) = 1995 then 'new' else o_orderstatus end as status from orders")
def partition_replace(spark, d):
    rows = _orders(spark, d).select("o_orderkey", "year", c("o_orderstatus").alias("status"))
    return tb.replace_partitions(rows, rows.where("year = 1995").withColumn("status", F.lit("new")), "year")


@query("join_partitions", "select c_custkey, n, m from (select o_custkey as c_custkey, count(*) as n from orders where o_orderstatus = 'O' group by 1) full join (select o_custkey as c_custkey, count(*) as m from orders where o_orderstatus = 'F' group by 1) using (c_custkey)")
def join_partitions(spark, d):
    part = lambda s, n: _orders(spark, d).where(c("o_orderstatus") == s).groupBy(c("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias(n))
    return tb.join_partitions([part("O", "n"), part("F", "m")], "c_custkey")


@query("table_equality", "select c_custkey, case when c_acctbal < 0 then -c_acctbal else c_acctbal end as balance, 'right' as side from customer where c_acctbal < 0 union all select c_custkey, c_acctbal, 'left' from customer where c_acctbal < 0")
def table_equality(spark, d):
    a = load(spark, d, "customer").select("c_custkey", c("c_acctbal").alias("balance"))
    return tb.differences(a, a.withColumn("balance", F.abs("balance")))


@query("distinct_rows", "select distinct o_custkey, o_orderstatus from orders")
def distinct_rows(spark, d):
    return load(spark, d, "orders").select("o_custkey", "o_orderstatus").dropDuplicates()


@query("filter_expression", "select o_orderkey from orders where o_totalprice > 150000 and o_orderstatus in ('O', 'P')")
def filter_expression(spark, d):
    return _orders(spark, d).where("o_totalprice > 150000 and o_orderstatus in ('O', 'P')").select("o_orderkey")


@query("filter_semi", "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 200000)")
def filter_semi(spark, d):
    return load(spark, d, "customer").join(_orders(spark, d).where("o_totalprice > 200000"), c("c_custkey") == c("o_custkey"), "left_semi").select("c_custkey")


@query("filter_anti", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def filter_anti(spark, d):
    return load(spark, d, "customer").join(_orders(spark, d), c("c_custkey") == c("o_custkey"), "left_anti").select("c_custkey")


@query("filter_top_per_group", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) where k = 1")
def filter_top_per_group(spark, d):
    best = F.min_by("o_orderkey", F.struct((-c("o_totalprice")).alias("p"), "o_orderkey"))
    return _orders(spark, d).groupBy("o_custkey").agg(best.alias("o_orderkey"))


@query(
    "filter_panel_latest",
    "with y as (select max(year(o_orderdate)) as y from orders) select o_orderkey from orders where year(o_orderdate) = (select y from y)",
)
def filter_panel_latest(spark, d):
    rows = _orders(spark, d)
    latest = rows.agg(F.max("year").alias("latest"))
    return rows.join(F.broadcast(latest), c("year") == c("latest")).select("o_orderkey")


@query(
    "reconcile_values",
    "select p_partkey, case when p_size between 10 and 40 then p_size * 1.0 when p_retailprice between 10 and 40 then p_retailprice end as value, case when p_size between 10 and 40 then 'size' when p_retailprice between 10 and 40 then 'price' end as value_source from part",
)
def reconcile_values(spark, d):
    rows = load(spark, d, "part").withColumn("p_size", c("p_size").cast("double"))
    return tb.reconcile(rows, [("size", "p_size"), ("price", "p_retailprice")], "value", 10, 40).select("p_partkey", "value", "value_source")


@query("suppress_where", "select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as o_totalprice from orders")
def suppress_where(spark, d):
    return tb.suppress(_orders(spark, d), ["o_totalprice"], c("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("null_out_of_range", "select p_partkey, case when p_size between 5 and 45 then p_size end as p_size from part")
def null_out_of_range(spark, d):
    return tb.within(load(spark, d, "part"), ["p_size"], 5, 45).select("p_partkey", "p_size")


@query("corrections", "select c_custkey, case when c_nationkey = 3 then 'FIXED' else c_mktsegment end as c_mktsegment from customer")
def corrections(spark, d):
    rows = load(spark, d, "customer")
    fixes = rows.where("c_nationkey = 3").select("c_custkey", F.lit("FIXED").alias("c_mktsegment"))
    return tb.correct(rows, fixes, "c_custkey", "c_mktsegment").select("c_custkey", "c_mktsegment")


@query(
    "deflate_values",
    """with r as (select y, 0.01 * (y - 1990) as rate from range(1992, 2000) t(y)), l as (select y, sum(ln(1 + rate)) over (order by y) as level from r), f as (select y, exp((select level from l where y = 1995) - level) as deflator from l)
    select o_orderkey, round(o_totalprice * deflator, 2) as o_totalprice_real from orders left join f on y = year(o_orderdate)""",
)
def deflate_values(spark, d):
    rates = spark.range(1992, 2000).select(c("id").cast("int").alias("year"), (0.01 * (c("id") - 1990)).alias("rate"))
    out = tb.deflate(_orders(spark, d), ["o_totalprice"], "year", tb.deflators(rates, "year", "rate", 1995))
    return out.select("o_orderkey", F.round("o_totalprice_real", 2).alias("o_totalprice_real"))


@query("pivot_counts", "select o_custkey, count(*) filter (o_orderstatus = 'F') as f, count(*) filter (o_orderstatus = 'O') as o, count(*) filter (o_orderstatus = 'P') as p from orders group by 1")
def pivot_counts(spark, d):
    wide = _orders(spark, d).groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return wide.select("o_custkey", *(F.coalesce(s, F.lit(0)).cast("long").alias(s.lower()) for s in ("F", "O", "P")))


@query("unpivot_values", "select l_orderkey, l_linenumber, 'l_tax' as measure, l_tax as value from lineitem union all select l_orderkey, l_linenumber, 'l_discount', l_discount from lineitem")
def unpivot_values(spark, d):
    return load(spark, d, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_tax", "l_discount"], "measure", "value")


def _judged(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.length("text").alias("size"))
    rows = load(spark, d, "labels").join(docs, "doc_id")
    return rows.select("doc_id", "quality", "toxic", "size", (c("size") > 400).cast("int").alias("a"), (c("size") > 1000).cast("int").alias("b"))


JUDGED = "(select l.doc_id, quality, toxic, length(text) as size, cast(length(text) > 400 as int) as a, cast(length(text) > 1000 as int) as b from labels l join documents d on d.doc_id = l.doc_id)"


@query("confusion_matrix", f"select quality, a, count(*) as n from {JUDGED} group by 1, 2")
def confusion_matrix(spark, d):
    return va.confusion(_judged(spark, d), "quality", "a")


@query("kappa", f"with j as (select count(*) as n, avg(cast(quality = a as int)) as po, avg(quality) * avg(a) + (1 - avg(quality)) * (1 - avg(a)) as pe from {JUDGED}) select n, round(po, 6) as accuracy, round(pe, 6) as expected, round((po - pe) / (1 - pe), 6) as kappa from j")
def kappa(spark, d):
    return va.kappa(_judged(spark, d), "quality", "a").select(c("n").cast("long").alias("n"), *(F.round(x, 6).alias(x) for x in ("accuracy", "expected", "kappa")))


@query(
    "prf",
    f"""with s as (select v as label, count(*) filter (quality = v) as support, count(*) filter (a = v) as called, count(*) filter (quality = v and a = v) as hit from {JUDGED}, (values (0), (1)) t(v) group by 1)
    select label, support, round(hit / called, 6) as precision, round(hit / support, 6) as recall, round(2 * hit / (support + called), 6) as f1 from s""",
)
def prf(spark, d):
    return va.scores(_judged(spark, d), "quality", "a").select("label", "support", *(F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")))


@query(
    "mcnemar",
    f"with s as (select count(*) filter (a = quality and b <> quality) as only_a, count(*) filter (a <> quality and b = quality) as only_b from {JUDGED}) select only_a, only_b, round(power(abs(only_a - only_b) - 1, 2) / (only_a + only_b), 6) as statistic from s",
)
def mcnemar(spark, d):
    return va.mcnemar(_judged(spark, d), "quality", "a", "b").withColumn("statistic", F.round("statistic", 6))


@query("year_bins", f"select size // 1000 * 1000 as bin, count(*) as n, round(avg(a - quality), 6) as bias, round(avg(abs(a - quality)), 6) as mae from {JUDGED} group by 1")
def year_bins(spark, d):
    return va.binned_error(_judged(spark, d), "size", 1000, "quality", "a").select("bin", "n", F.round("bias", 6).alias("bias"), F.round("mae", 6).alias("mae"))


@query(
    "cumulative_shares",
    "with y as (select o_custkey, cast(year(o_orderdate) as int) as year, sum(o_totalprice) as part from orders group by 1, 2) select o_custkey, year, round(least(1.0, sum(part) over (partition by o_custkey order by year) / 1000000.0), 6) as share from y",
)
def cumulative_shares(spark, d):
    rows = _orders(spark, d).withColumn("whole", F.lit(1000000.0))
    return va.cumulative_shares(rows, "o_custkey", "year", "o_totalprice", "whole").withColumn("share", F.round("share", 6))


def _units(spark, d):
    return load(spark, d, "nation").select("n_nationkey", F.concat(F.lit("R"), "n_regionkey", F.lit("-N"), "n_nationkey", F.lit("-X1")).alias("admin_id"))


UNITS = "(select n_nationkey, concat('R', n_regionkey, '-N', n_nationkey, '-X1') as admin_id from nation)"


@query("admin_ancestor", f"select n_nationkey, split_part(admin_id, '-', 1) as level1, concat(split_part(admin_id, '-', 1), '-', split_part(admin_id, '-', 2)) as level2, cast(null as varchar) as level4 from {UNITS}")
def admin_ancestor(spark, d):
    return _units(spark, d).select("n_nationkey", *(tb.ancestor(c("admin_id"), k).alias(f"level{k}") for k in (1, 2, 4)))


@query("scope_covers", f"select n_nationkey, admin_id = 'R1' or starts_with(admin_id, 'R1-') as inside, true as everywhere from {UNITS}")
def scope_covers(spark, d):
    return _units(spark, d).select("n_nationkey", tb.covers(F.lit("R1"), c("admin_id")).alias("inside"), tb.covers(F.lit(""), c("admin_id")).alias("everywhere"))


@query(
    "redaction",
    """with h as (select c_custkey, c_acctbal, c_nationkey % 3 as s, c_nationkey < 5 as inside from customer), w as (select *, s = 1 or (s = 0 and inside) as gone from h)
    select c_custkey, case when not gone then c_acctbal end as value, case when gone then 'withheld' when s = 1 then 'closed+imputed' when s = 2 then 'open' end as value_source, case when not gone then c_acctbal / 2 end as value_per_area from w""",
)
def redaction(spark, d):
    s = c("c_nationkey") % 3
    rows = load(spark, d, "customer").select("c_custkey", c("c_acctbal").alias("value"), F.when(s == 1, "closed+imputed").when(s == 2, "open").alias("value_source"), (c("c_acctbal") / 2).alias("value_per_area"), F.when(c("c_nationkey") < 5, "US-MA-X").otherwise("US-NY").alias("admin_id"))
    return tb.withhold(rows, ["value"], ["closed"], "admin_id", "US-MA", {"value_per_area": ["value"]}).drop("admin_id")
