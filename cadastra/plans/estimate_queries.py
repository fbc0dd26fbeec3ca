"""Queries of inferred columns, provenance, delivery, administrative units and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import addresses as ad
from cadastra.functions import estimates as es
from cadastra.operators import admin as am
from cadastra.operators import aggregates as ag
from cadastra.operators import delivery as dl
from cadastra.operators import imputation as im
from cadastra.operators import tables as tb
from cadastra.plans import lineage as li
from cadastra.plans.catalogue import load, query
from cadastra.sources.store import scratch

c = F.col

# Provenance and inference ----------------------------------------------------------------------------


@query(
    "provenance",
    """select p_partkey, case when p_size % 3 = 0 then 'roll+imputed' when p_size % 3 = 1 then 'roll+imputed' else 'imputed' end as marked, p_size % 3 = 0 as was, case when p_size > 25 then 'reviewed' when p_size % 3 = 0 then 'roll+imputed' when p_size % 3 = 1 then 'roll' end as recorded,
    case p_size % 3 when 0 then 'first' when 1 then 'second' else 'other' end as bucket from part""",
)
def provenance(spark, d):
    source = F.when(c("p_size") % 3 == 0, "roll+imputed").when(c("p_size") % 3 == 1, "roll")
    bucket = es.bucketed((c("p_size") % 3).cast("string"), {"0": "first", "1": "second"}, "other")
    return load(spark, d, "part").select("p_partkey", es.mark_imputed(source).alias("marked"), es.is_imputed(source).alias("was"), es.record_source(source, c("p_size") > 25, "reviewed").alias("recorded"), bucket.alias("bucket"))


@query(
    "stories_and_dwellings",
    """select p_partkey, cast(greatest(1, floor(p_size / 3.0 + 0.5)) as int) as by_height, cast(case when p_size % 4 = 0 then p_size when p_retailprice between 1 and 150 then floor(p_retailprice + 0.5) else greatest(1, floor(p_size / 3.0 + 0.5)) end as int) as stories,
    case when p_size % 4 = 0 then 'survey' when p_retailprice between 1 and 150 then 'price' else 'height' end as stories_source, case when p_size % 5 = 0 then 7 when p_brand = 'Brand#11' then 1 when p_brand = 'Brand#12' then 2 end as dwellings,
    cast(case when p_size % 2 = 0 then 0 else p_size end as bigint) as filled from part""",
)
def stories_and_dwellings(spark, d):
    by_height = es.stories_from_height(c("p_size"))
    stories, label = es.decide_stories([("survey", F.when(c("p_size") % 4 == 0, c("p_size"))), ("price", c("p_retailprice")), ("height", by_height)])
    dwellings = es.dwellings_of_class(F.when(c("p_size") % 5 == 0, 7), c("p_brand"), {"Brand#11": 1, "Brand#12": 2})
    filled = es.filled_number(F.when(c("p_size") % 2 == 0, "unknown").otherwise(c("p_size").cast("string")))
    return load(spark, d, "part").select("p_partkey", by_height.alias("by_height"), stories.alias("stories"), label.alias("stories_source"), dwellings.alias("dwellings"), filled.alias("filled"))


@query(
    "land_value_tiers",
    """with r as (select *, case when o_orderkey % 3 <> 0 then o_totalprice * 0.2 end as land, o_totalprice * 0.5 as imp, case when o_orderkey % 5 <> 0 then o_totalprice * case when o_orderkey % 2 = 0 then 0.9 else 0.4 end end as total, cast(o_custkey % 50 + 1 as double) as area from orders),
    t as (select o_orderstatus as s, sum(land) / sum(area) as rate from r where land > 0 group by 1), x as (select *, land is null as gap from r left join t on s = o_orderstatus),
    y as (select *, gap and coalesce(total > imp, false) as ident, gap and not coalesce(total > imp, false) as byrate, case when total is not null then least(rate * area, total) else rate * area end as est from x)
    select o_orderkey, round(case when ident then total - imp when byrate then est else land end, 3) as land, round(case when byrate then greatest(0.0, imp - est) else imp end, 3) as improvement, case when ident then 'total_less_improvement' when byrate then 'rate_times_area' end as method from y""",
)
def land_value_tiers(spark, d):
    o = load(spark, d, "orders")
    rows = o.select("o_orderkey", "o_orderstatus", F.when(c("o_orderkey") % 3 != 0, c("o_totalprice") * 0.2).alias("land"), (c("o_totalprice") * 0.5).alias("imp"),
                    F.when(c("o_orderkey") % 5 != 0, c("o_totalprice") * F.when(c("o_orderkey") % 2 == 0, 0.9).otherwise(0.4)).alias("total"), (c("o_custkey") % 50 + 1).cast("double").alias("area"))
    rate = rows.where("land > 0").groupBy("o_orderstatus").agg((F.sum("land") / F.sum("area")).alias("rate"))
    land, imp, method = es.land_value(c("land"), c("imp"), c("total"), c("area"), c("rate"), F.lit(True))
    return rows.join(rate, "o_orderstatus", "left").select("o_orderkey", F.round(land, 3).alias("land"), F.round(imp, 3).alias("improvement"), method.alias("method"))


@query(
    "flags_and_reasons",
    """select p_partkey, p_retailprice / p_size >= 60 and p_retailprice / p_size / greatest(coalesce(ceil(p_size / 3.0), 1), 1) > 40 as unconfirmed, case when p_size % 4 = 0 then case when p_size % 8 = 0 then 'exempt' when p_size > 20 then 'large' else 'unknown' end end as reason,
    cast(case when p_name like '%a%' then 1.0 else case when p_size >= 10 then 0.5 else 0 end + case when p_size <= 30 then 0.5 else 0 end end as double) as score, case when p_size % 4 = 0 then null when p_size % 3 = 0 then 'omission' when p_size % 5 = 0 then 'correct' else 'commission' end as result from part""",
)
def flags_and_reasons(spark, d):
    size = c("p_size")
    unconfirmed = es.unconfirmed_height(c("p_retailprice"), size, F.lit(None), size, 60.0, 40.0)
    reason = es.zero_reason(F.when(size % 4 == 0, 0).otherwise(1), [("exempt", size % 8 == 0), ("large", size > 20)])
    truth, said = F.when(size % 4 != 0, "x"), F.when(size % 3 != 0, F.when(size % 5 == 0, "x").otherwise("y"))
    return load(spark, d, "part").select("p_partkey", unconfirmed.alias("unconfirmed"), reason.alias("reason"), es.manufactured_score(F.contains("p_name", F.lit("a")), size, size, 10, 30).alias("score"), es.validation_result(truth, said).alias("result"))


@query(
    "sale_dates",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, case when o_orderkey % 6 = 5 then null else strftime(case when o_orderkey % 6 in (3, 4) then date_trunc('month', o_orderdate) else o_orderdate end, '%Y-%m-%d') end as found,
    cast(case when o_orderkey % 2 = 0 then year(o_orderdate) else 1900 end as int) as year from orders""",
)
def sale_dates(spark, d):
    at, k = c("o_orderdate"), c("o_orderkey") % 6
    text = F.when(k == 0, F.date_format(at, "yyyy-MM-dd")).when(k == 1, F.date_format(at, "yyyyMMdd")).when(k == 2, F.date_format(at, "M/d/yyyy")).when(k == 3, F.date_format(at, "yyyyMM")).when(k == 4, F.date_format(at, "yyyy-MM")).otherwise("none")
    year, _ = es.sale_period(F.when(c("o_orderkey") % 2 == 1, 1900), F.lit(None).cast("int"), at)
    return load(spark, d, "orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd").alias("day"), F.date_format(es.sale_date(text), "yyyy-MM-dd").alias("found"), year.cast("int").alias("year"))


@query(
    "conflict_texts",
    "select o_orderkey, case when o_orderstatus = s and o_orderstatus = t then null when o_orderstatus = s then 'a/b: ' || s || ' | c: ' || t when o_orderstatus = t then 'a/c: ' || t || ' | b: ' || s when s = t then 'a: ' || o_orderstatus || ' | b/c: ' || s else 'a: ' || o_orderstatus || ' | b: ' || s || ' | c: ' || t end as conflict from (select *, case when o_orderkey % 2 = 0 then 'F' else 'O' end as s, case when o_orderkey % 3 = 0 then 'O' else 'P' end as t from orders)",
)
def conflict_texts(spark, d):
    s, t = F.when(c("o_orderkey") % 2 == 0, "F").otherwise("O"), F.when(c("o_orderkey") % 3 == 0, "O").otherwise("P")
    return load(spark, d, "orders").select("o_orderkey", es.conflict_text([("a", c("o_orderstatus")), ("b", s), ("c", t)]).alias("conflict"))


# Addresses -------------------------------------------------------------------------------------------


@query(
    "address_parse",
    """select s_suppkey, cast(s_suppkey as varchar) as address_number, 'North Main Street' as address_street, case when s_suppkey % 2 = 0 then 'Apt ' || s_nationkey end as unit_number, 'Coastal City' as city, 'NC' as state, cast(28500 + s_nationkey as varchar) as postal_code,
    s_suppkey || ' N MAIN ST' || case when s_suppkey % 2 = 0 then ' APT ' || s_nationkey else '' end || ' COASTAL CITY NC ' || (28500 + s_nationkey) as normal, s_suppkey || ' N Main St' || case when s_suppkey % 2 = 0 then ' Apt ' || s_nationkey else '' end || ', Coastal City, NC ' || (28500 + s_nationkey) as shown from supplier""",
)
def address_parse(spark, d):
    line = F.concat(c("s_suppkey"), F.lit(" North Main Street"), F.when(c("s_suppkey") % 2 == 0, F.concat(F.lit(" Apt "), c("s_nationkey"))).otherwise(""), F.lit(", Coastal City, nc "), 28500 + c("s_nationkey"))
    rows = load(spark, d, "supplier").select("s_suppkey", ad.parse_line(line).alias("p")).select("s_suppkey", "p.*")
    parts = [c(x) for x in ("address_number", "address_street", "unit_number", "city", "state", "postal_code")]
    return rows.select("*", ad.normal_line(*parts).alias("normal"), ad.display_line(*parts).alias("shown"))


@query("address_match", "select s_suppkey, s_suppkey % 2 = 0 as same, 'ELM AVE' as street, case when s_nationkey < 3 then 'Quincy' end as city, '02169-' || lpad(cast(s_nationkey as varchar), 4, '0') as zip from supplier")
def address_match(spark, d):
    other = F.when(c("s_suppkey") % 2 == 0, "Elm  Ave.").otherwise("Oak Road")
    code = F.lpad((2169 + F.when(c("s_nationkey") < 3, 0).otherwise(1)).cast("string"), 5, "0")
    return load(spark, d, "supplier").select("s_suppkey", ad.streets_match(F.lit("ÉLM AVENUE"), other).alias("same"), ad.normal_street(F.lit("élm  avenue")).alias("street"), ad.postal_city(code, {"02169": "Quincy"}).alias("city"), ad.normal_postal_code(F.concat(F.lit("02169"), F.lpad(c("s_nationkey").cast("string"), 4, "0"))).alias("zip"))


@query("join_addresses", "select s_nationkey, string_agg(v, ' + ' order by k) as lines from (select s_nationkey, s_suppkey % 4 as base, min(s_suppkey) as k, arg_min(s_suppkey % 4 || ' Oak St Unit ' || s_suppkey, s_suppkey) as v from supplier group by 1, 2) group by 1")
def join_addresses(spark, d):
    rows = load(spark, d, "supplier").withColumn("line", F.concat(c("s_suppkey") % 4, F.lit(" Oak St Unit "), c("s_suppkey")))
    return ag.join_addresses(rows, ["s_nationkey"], "line", c("s_suppkey"), "lines")


@query("distinct_join", "select l_suppkey, string_agg(v, ' | ' order by o, v) as v from (select l_suppkey, l_returnflag || l_linestatus as v, min(l_orderkey * 10 + l_linenumber) as o from lineitem group by 1, 2) group by 1")
def distinct_join(spark, d):
    rows = load(spark, d, "lineitem").withColumn("v", F.concat("l_returnflag", "l_linestatus"))
    return ag.distinct_join(rows, ["l_suppkey"], "v", c("l_orderkey") * 10 + c("l_linenumber"), "v")


# Delivery --------------------------------------------------------------------------------------------


def _sourced(spark, d):
    p = load(spark, d, "part")
    source = F.when(c("p_partkey") % 5 == 0, "secret+imputed").when(c("p_partkey") % 5 == 1, "imputed").otherwise("open")
    return p.select("p_partkey", "p_brand", "p_size", source.alias("p_size_source"), (c("p_retailprice") / 10).alias("p_size_per_area"), "p_retailprice", F.lit("open").alias("p_retailprice_source"), F.when(c("p_partkey") % 11 == 0, "secret").otherwise("open").alias("outline"))


@query(
    "withhold_sources",
    """with p as (select *, case when p_partkey % 5 = 0 then 'secret+imputed' when p_partkey % 5 = 1 then 'imputed' else 'open' end as s from part), u as (select distinct p_brand as b from p where s like 'secret%'),
    g as (select *, s like 'secret%' or (s like '%imputed' and p_brand in (select b from u)) as gone from p where p_partkey % 11 <> 0)
    select p_partkey, case when not gone then p_size end as p_size, case when gone then 'withheld' else s end as p_size_source, round(case when not gone then p_retailprice / 10 end, 6) as p_size_per_area, case when not gone then p_retailprice end as p_retailprice, case when gone then 'withheld' else 'open' end as p_retailprice_source from g""",
)
def withhold_sources(spark, d):
    out = dl.withhold(_sourced(spark, d), ["p_size"], ["secret"], "outline", "p_brand", {"p_retailprice": ["p_size"]})
    return out.select("p_partkey", "p_size", "p_size_source", F.round("p_size_per_area", 6).alias("p_size_per_area"), "p_retailprice", "p_retailprice_source")


@query("cells_by_source", "select 'p_size' as \"column\", unnest(case when p_partkey % 5 = 0 then ['secret', 'imputed'] when p_partkey % 5 = 1 then ['imputed'] else ['open'] end) as source, count(*) as cells from part group by 1, 2 union all select 'p_retailprice', 'open', count(*) from part")
def cells_by_source(spark, d):
    return dl.cells_by_source(_sourced(spark, d), ["p_size", "p_retailprice"])


@query("units_supplied", "select distinct p_brand from part where p_partkey % 5 = 0")
def units_supplied(spark, d):
    return dl.units_supplied(_sourced(spark, d), "p_brand", ["p_size"], ["secret"])


@query("changed_columns", "select unnest(['o_clerk', 'o_orderstatus', 'o_totalprice']) as \"column\", unnest(['added', 'removed', 'changed']) as change")
def changed_columns(spark, d):
    """The same rows in another order, with a column more, one less, and one cell changed."""
    old = load(spark, d, "orders")
    new = old.repartition(7, "o_custkey").drop("o_orderstatus").withColumn("o_clerk", F.lit("x")).withColumn("o_totalprice", F.when(c("o_orderkey") == 3, -1.0).otherwise(c("o_totalprice")))
    return dl.changed_columns(dl.digests(old, ["o_orderkey"]), dl.digests(new, ["o_orderkey"]))


@query("table_profile", "select 'p_brand' as \"column\", count(*) as rows, 0 as missing from part union all select 'size', count(*), count(*) filter (where p_size % 3 = 0) from part")
def table_profile(spark, d):
    rows = load(spark, d, "part").select("p_brand", F.when(c("p_size") % 3 != 0, c("p_size")).alias("size"))
    return dl.profile(rows).select("column", "rows", "missing")


@query("value_counts", "select 'l_returnflag' as \"column\", l_returnflag as value, count(*) as n from lineitem group by 1, 2 union all select 'l_linestatus', l_linestatus, count(*) from lineitem group by 1, 2")
def value_counts(spark, d):
    return dl.value_counts(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_orderkey"], 10)


@query("stable_sample", "select 100 as n, true as same, true as within")
def stable_sample(spark, d):
    """A sample of 100 rows: the same however the rows are dealt out, and all of them rows of the table."""
    o = load(spark, d, "orders")
    a, b = dl.sampled(o, "o_orderkey", 100).select("o_orderkey"), dl.sampled(o.repartition(5, "o_custkey"), "o_orderkey", 100).select("o_orderkey")
    both = a.join(b, "o_orderkey").join(o.select("o_orderkey"), "o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("m"))
    return a.agg(F.count(F.lit(1)).cast("int").alias("n")).join(F.broadcast(both)).select("n", (c("m") == c("n")).alias("same"), (c("m") == c("n")).alias("within"))


@query("stale_outputs", "select o_orderkey as output, o_custkey as input from orders join (select c_custkey, timestamp '1990-01-01' + to_days(cast(c_custkey % 3000 as int)) as t from customer where c_custkey % 10 <> 0) on c_custkey = o_custkey where t > o_orderdate union all select o_orderkey, o_custkey from orders where o_custkey % 10 = 0 or o_custkey not in (select c_custkey from customer)")
def stale_outputs(spark, d):
    made = load(spark, d, "orders").select(c("o_orderkey").alias("output"), c("o_custkey").alias("input"), c("o_orderdate").alias("built"))
    inputs = load(spark, d, "customer").where("c_custkey % 10 <> 0").select(c("c_custkey").alias("input"), F.expr("timestamp_ntz'1990-01-01' + make_interval(0, 0, 0, cast(c_custkey % 3000 as int))").alias("built"))
    return dl.out_of_date(made, inputs)


@query("decided_twice", "select o_orderstatus as \"column\", string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as steps from orders group by 1 having count(distinct o_orderpriority) > 1")
def decided_twice(spark, d):
    return li.decided_twice(load(spark, d, "orders").select(c("o_orderstatus").alias("column"), c("o_orderpriority").alias("step")))


# Administrative units --------------------------------------------------------------------------------


def _units(spark, d):
    n = load(spark, d, "nation").select(F.concat_ws("-", c("n_regionkey"), c("n_nationkey")).alias("admin_id"), c("n_name").alias("name"), F.lit(None).cast("double").alias("people"))
    r = load(spark, d, "region").where("r_regionkey <> 2").select(c("r_regionkey").cast("string").alias("admin_id"), c("r_name").alias("name"), F.lit(100.0).alias("people"))
    return am.registry([r, n])


@query("admin_orphans", "select n_regionkey || '-' || n_nationkey as admin_id, n_name as name from nation where n_regionkey = 2")
def admin_orphans(spark, d):
    return am.orphans(_units(spark, d)).select("admin_id", "name")


@query("admin_level_view", "select n_regionkey || '-' || n_nationkey as admin_id, cast(n_regionkey as varchar) as admin1_id, n_regionkey || '-' || n_nationkey as admin2_id from nation")
def admin_level_view(spark, d):
    return am.at_level(_units(spark, d), 2).select("admin_id", "admin1_id", "admin2_id")


@query("admin_names", "select s_suppkey, 'Sao ' || s_nationkey || ' Lodz' as name, cast(null as varchar) as nothing, substr(cast(100 + s_suppkey as varchar), 2, 2) as part from supplier")
def admin_names(spark, d):
    name = F.concat(F.lit("District of  São "), c("s_nationkey"), F.lit(" Łódź County"))
    code = (100 + c("s_suppkey")).cast("string")
    return load(spark, d, "supplier").select("s_suppkey", am.clean_name(name, ["county"], ["district of"], ["n/a"]).alias("name"), am.clean_name(F.lit("N/A"), [], [], ["n/a"]).alias("nothing"), am.segment(code, 2, 2).alias("part"))


@query("admin_codes", "select n_regionkey, count(*) as n, count(*) as codes from nation group by 1")
def admin_codes(spark, d):
    coded = am.assign_codes(load(spark, d, "nation").select("n_regionkey", c("n_name").alias("name"), c("n_nationkey").alias("weight")), "n_regionkey", "name", "weight", scratch(spark))
    return coded.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("codes"))


@query(
    "admin_population",
    """with u as (select c_custkey, c_nationkey, case when c_custkey % 3 <> 0 then c_acctbal end as people from customer), t as (select *, coalesce(sum(people) over (partition by c_nationkey), 0) as known, sum(case when people is null then 1 else 0 end) over (partition by c_nationkey) as gaps from u)
    select c_custkey, round(coalesce(people, greatest(0.0, 300000.0 - known) / gaps), 4) as people, people is null as filled from t""",
)
def admin_population(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(c("c_custkey") % 3 != 0, c("c_acctbal")).alias("people"))
    totals = load(spark, d, "nation").select(c("n_nationkey").alias("c_nationkey"), F.lit(300000.0).alias("total"))
    return am.fill_population(rows, "c_nationkey", "people", totals, "total").select("c_custkey", F.round("people", 4).alias("people"), "filled")


@query("admin_weights", "select c_custkey, round(case when c_custkey % 4 = 0 then (select median(c_acctbal) from customer i where i.c_mktsegment = o.c_mktsegment and c_acctbal > 0 and c_custkey % 4 <> 0 and c_custkey % 5 <> 0) when c_custkey % 5 = 0 then 0.0 else c_acctbal end, 4) as w from customer o")
def admin_weights(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_mktsegment", F.when((c("c_custkey") % 4 == 0) | (c("c_custkey") % 5 == 0), 0.0).otherwise(c("c_acctbal")).alias("w"), (c("c_custkey") % 4 == 0).alias("filled"))
    return am.repair_weights(rows, "c_mktsegment", "w", "filled").select("c_custkey", F.round("w", 4).alias("w"))


@query("admin_match_names", "select n_nationkey as unit, n_nationkey + 100 as harvested from nation where n_nationkey % 4 <> 0")
def admin_match_names(spark, d):
    n = load(spark, d, "nation")
    harvest = n.select("n_regionkey", F.initcap("n_name").alias("name"), (c("n_nationkey") + 100).alias("harvested"))
    again = harvest.where("harvested % 4 = 0").withColumn("harvested", c("harvested") + 100)
    return am.match_by_name(n.select("n_regionkey", c("n_name").alias("name"), c("n_nationkey").alias("unit")), harvest.union(again), "n_regionkey", "name", "unit", "harvested")


@query("admin_audit", "select n_regionkey || '-' || n_nationkey as admin_id, 'no_parent' as problem from nation where n_regionkey = 2 union all select 'x y', 'bad_code' union all select '0', 'repeated'")
def admin_audit(spark, d):
    units = _units(spark, d).select("admin_id")
    odd = units.where("admin_id = '0'").union(units.where("admin_id = '0'").withColumn("admin_id", F.lit("x y")))
    return am.audit(units.union(odd))


@query("admin_rekey", "select c_custkey, case when c_nationkey < 5 then 'N' || c_nationkey else cast(c_nationkey as varchar) end as code from customer")
def admin_rekey(spark, d):
    codes = load(spark, d, "nation").where("n_nationkey < 5").select(c("n_nationkey").cast("string").alias("old"), F.concat(F.lit("N"), "n_nationkey").alias("new"))
    return am.rekey(load(spark, d, "customer").select("c_custkey", c("c_nationkey").cast("string").alias("code")), "code", codes, "old", "new")


# Imputation ------------------------------------------------------------------------------------------


@query(
    "value_caps",
    """with r as (select *, p_retailprice / p_size as rate from part), k as (select p_brand as b, quantile_cont(rate, 0.9) as cap from r where p_brand <> 'Brand#11' group by 1), a as (select quantile_cont(rate, 0.9) as cap from r where p_brand <> 'Brand#11')
    select p_partkey, round(least(p_retailprice, coalesce(k.cap, a.cap) * p_size), 4) as value from r left join k on b = p_brand cross join a""",
)
def value_caps(spark, d):
    rows = load(spark, d, "part").select("p_partkey", "p_brand", c("p_retailprice").alias("value"), "p_size")
    caps = im.area_caps(rows.where("p_brand <> 'Brand#11'"), "p_brand", "value", "p_size", 0.9)
    return im.clipped(rows, caps, "p_brand", "value", "p_size").select("p_partkey", F.round("value", 4).alias("value"))


INDEX = "(select c_nationkey as r, c_nationkey % 5 as s, cast(year(o_orderdate) as int) as y, avg(o_totalprice) as v from orders join customer on c_custkey = o_custkey where year(o_orderdate) < 1996 or c_nationkey % 2 = 0 group by 1, 2, 3)"
WIDER = "(select c_nationkey % 5 as s, cast(year(o_orderdate) as int) as y, avg(o_totalprice) as v from orders join customer on c_custkey = o_custkey group by 1, 2)"


def _index(spark, d):
    o = load(spark, d, "orders").join(load(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select(c("c_nationkey").alias("r"), (c("c_nationkey") % 5).alias("s"), F.year("o_orderdate").alias("y"), c("o_totalprice").alias("v"))
    return o.where("y < 1996 or r % 2 = 0").groupBy("r", "s", "y").agg(F.avg("v").alias("v")), o.groupBy("s", "y").agg(F.avg("v").alias("v"))


@query(
    "index_continued",
    f"""with i as {INDEX}, w as {WIDER}, l as (select r, s, max(y) as ly, arg_max(v, y) as lv from i group by 1, 2)
    select r, y, round(v, 3) as v, false as continued from i union all select l.r, n.y, round(lv * n.v / t.v, 3), true from l join w t on t.s = l.s and t.y = ly join w n on n.s = l.s and n.y > ly""",
)
def index_continued(spark, d):
    index, wider = _index(spark, d)
    return im.continued(index, wider, "r", "s", "y", "v").select("r", "y", F.round("v", 3).alias("v"), "continued")


@query("index_scales", f"with i as {INDEX} select i.r, i.y, round(b.v / i.v, 6) as scale from i left join i b on b.r = i.r and b.y = 1994")
def index_scales(spark, d):
    return im.scales(_index(spark, d)[0], "r", "y", "v", 1994).select("r", "y", F.round("scale", 6).alias("scale"))


@query("imputation_scores", "select l_returnflag, count(*) as rows, round(sum(l_quantity * 1000) / sum(l_extendedprice) - 1, 6) as total_bias, round(avg(abs(l_quantity * 1000 - l_extendedprice)), 4) as mean_error, round(median(abs(l_quantity * 1000 - l_extendedprice) / l_extendedprice), 6) as typical_miss from lineitem group by 1")
def imputation_scores(spark, d):
    rows = load(spark, d, "lineitem").withColumn("said", c("l_quantity") * 1000)
    out = im.score(rows, "l_returnflag", "l_extendedprice", "said")
    return out.select("l_returnflag", "rows", F.round("total_bias", 6).alias("total_bias"), F.round("mean_error", 4).alias("mean_error"), F.round("typical_miss", 6).alias("typical_miss"))


@query("void_implausible", "select p_partkey, case when p_size between 5 and 40 then p_size end as p_size, case when p_retailprice >= 950 then p_retailprice end as p_retailprice from part")
def void_implausible(spark, d):
    return im.void_implausible(load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), {"p_size": (5, 40), "p_retailprice": (950, None)})


PLACES = "(select n_nationkey as b, (n_nationkey * 7 % 50) / 10 + 40 as lat, (n_nationkey * 11 % 60) / 10 - 90 as lon, n_nationkey + 1.0 as size from nation)"
SPOTS = "(select s_suppkey as a, (s_suppkey * 3 % 50) / 10 + 40 as lat, (s_suppkey * 5 % 60) / 10 - 90 as lon from supplier)"
KM = "2 * 6371.0088 * asin(sqrt(least(1.0, power(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.lon) / 2), 2))))"


@query("place_gravity", f"with k as (select a, size, {KM} as km from {SPOTS} s cross join {PLACES} p) select s_suppkey as a, round(coalesce(sum(size / power(greatest(km, 1), 2)) filter (where km <= 150), 0), 6) as gravity, round(min(km) filter (where km <= 150), 4) as nearest_km from supplier left join k on a = s_suppkey group by 1")
def place_gravity(spark, d):
    s, n = c("s_suppkey"), c("n_nationkey")
    spots = load(spark, d, "supplier").select(s.alias("a"), (s * 3 % 50 / 10 + 40).alias("lat"), (s * 5 % 60 / 10 - 90).alias("lon"))
    places = load(spark, d, "nation").select((n + 1.0).alias("size"), (n * 7 % 50 / 10 + 40).alias("lat"), (n * 11 % 60 / 10 - 90).alias("lon"))
    return im.place_gravity(spots, places, "a", "size", 150.0).select("a", F.round("gravity", 6).alias("gravity"), F.round("nearest_km", 4).alias("nearest_km"))


@query("region_distances", f"with r as (select b as t, lat, lon from {PLACES}) select s.t as target, p.t as donor, round({KM}, 3) as km from r s join r p on {KM} <= 200")
def region_distances(spark, d):
    n = c("n_nationkey")
    regions = load(spark, d, "nation").select(n.alias("t"), (n * 7 % 50 / 10 + 40).alias("lat"), (n * 11 % 60 / 10 - 90).alias("lon"))
    return im.region_distances(regions, "t", 200.0).withColumn("km", F.round("km", 3))


@query("training_rows", "select count(*) as n, 0 as own from (select n_nationkey from nation)")
def training_rows(spark, d):
    """With a target's own rows left out, each target has at most five rows of each donor."""
    people = load(spark, d, "customer").select("c_custkey", c("c_nationkey").alias("t"), "c_acctbal")
    keys = load(spark, d, "nation").select(c("n_nationkey").alias("target"))
    pairs = keys.select("target", F.explode(F.array(c("target"), F.pmod(c("target") + 1, F.lit(25)))).alias("donor")).withColumn("km", F.when(c("target") == c("donor"), 0.0).otherwise(100.0))
    rows = im.training_rows(people, pairs, "t", "c_custkey", 5, leave_out=True)
    each = rows.groupBy("target").agg(F.count(F.lit(1)).alias("k"), F.sum((c("target") == c("donor")).cast("int")).alias("own"))
    return keys.join(each, "target", "left").agg(F.count_if(F.coalesce("k", F.lit(0)) <= 5).alias("n"), F.coalesce(F.sum("own"), F.lit(0)).cast("int").alias("own"))


@query("value_model", "select true as close, true as share_close")
def value_model(spark, d):
    """Fitted on four of five parts of a table whose law is known, and held against the fifth."""
    p = load(spark, d, "part").withColumn("y", F.exp(c("p_size") * 0.05 + 3)).withColumn("w", F.lit(1.0)).withColumn("x", c("p_size").cast("double"))
    p = p.withColumn("flag", (c("p_size") > 25).cast("double"))
    train, test = p.where("p_partkey % 5 <> 0"), p.where("p_partkey % 5 = 0")
    model, share = im.fit_log_linear(train, ["x"], "y", "w"), im.fit_share(train, ["x"], "flag", "w")
    out = im.predict_share(im.predict_log_linear(test, model, ["x"], "said"), share, ["x"], "chance")
    return out.agg((F.max(F.abs(c("said") / c("y") - 1)) < 0.02).alias("close"), (F.avg(((c("chance") > 0.5) == (c("flag") > 0.5)).cast("double")) > 0.9).alias("share_close"))


@query("memory_envelope", "with o as (select o_custkey as k, cast(count(*) as double) as size, sum(o_totalprice) as peak from orders group by 1), s as (select greatest(0, regr_slope(peak, size)) as m from o) select round(max(m), 2) as slope, round(max(peak - m * size), 2) as floor from o cross join s")
def memory_envelope(spark, d):
    seen = load(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("size"), F.sum("o_totalprice").alias("peak"))
    floor, slope = li.envelope(seen, "size", "peak")
    return spark.range(1).select(F.round(F.lit(slope), 2).alias("slope"), F.round(F.lit(floor), 2).alias("floor"))


@query("flag_other_kind", "with o as (select *, case when o_orderkey % 3 = 0 then 'roll' else 'deed' end as kind from orders) select o_orderkey, kind = 'roll' and exists (select 1 from o d where d.kind = 'deed' and d.o_custkey = o.o_custkey and year(d.o_orderdate) = year(o.o_orderdate)) as reported from o")
def flag_other_kind(spark, d):
    rows = load(spark, d, "orders").withColumn("kind", F.when(c("o_orderkey") % 3 == 0, "roll").otherwise("deed")).withColumn("y", F.year("o_orderdate"))
    return tb.flag_reported(rows, ["o_custkey", "y"], "kind", "roll", "deed", "reported").select("o_orderkey", "reported")
