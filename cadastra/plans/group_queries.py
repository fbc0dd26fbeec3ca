"""Queries of aggregations and group context."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import scalar as sc
from cadastra.functions.estimates import filled_number
from cadastra.operators import aggregates as ag
from cadastra.operators import groups as gr
from cadastra.plans.catalogue import load, query

c = F.col


def _line():
    """Order of the rows of an order: their numbers repeat, so the price decides."""
    return F.struct("l_linenumber", "l_extendedprice")


def _lines(spark, d):
    return load(spark, d, "lineitem")


@query(
    "agg_registry_rows",
    """select l_orderkey, sum(l_quantity) as l_quantity, round(avg(l_discount), 9) as l_discount, max(l_extendedprice) as l_extendedprice, arg_min(l_returnflag, (l_linenumber, l_extendedprice)) as l_returnflag, mode_flag as l_linestatus
    from lineitem join (select l_orderkey as k, min(s) as mode_flag from (select l_orderkey, l_linestatus as s, count(*) as n, max(count(*)) over (partition by l_orderkey) as m from lineitem group by 1, 2) where n = m group by 1) on k = l_orderkey group by l_orderkey, mode_flag""",
)
def agg_registry_rows(spark, d):
    how = {"l_quantity": "sum", "l_discount": "mean", "l_extendedprice": "max", "l_returnflag": "first", "l_linestatus": "mode"}
    return ag.aggregate_rows(_lines(spark, d), ["l_orderkey"], how, _line()).withColumn("l_discount", F.round("l_discount", 9))


@query("agg_weighted_mean_sum", "select l_partkey, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) as mean_price, round(sum(l_discount * l_quantity), 4) as sum_discount from lineitem group by 1")
def agg_weighted_mean_sum(spark, d):
    return _lines(spark, d).groupBy("l_partkey").agg(F.round(ag.weighted("l_extendedprice", "l_quantity", "mean"), 4).alias("mean_price"), F.round(ag.weighted("l_discount", "l_quantity", "sum"), 4).alias("sum_discount"))


@query("agg_agree", "select l_suppkey, l_linenumber, case when count(distinct l_linestatus) = 1 then min(l_linestatus) end as l_linestatus from lineitem group by 1, 2")
def agg_agree(spark, d):
    return ag.aggregate_rows(_lines(spark, d), ["l_suppkey", "l_linenumber"], {"l_linestatus": "agree"}, F.lit(0))


@query("agg_distinct_join", "select l_orderkey, string_agg(f, ' | ' order by k) as l_returnflag from (select l_orderkey, l_returnflag as f, min((l_linenumber, l_extendedprice)) as k from lineitem group by 1, 2) group by 1")
def agg_distinct_join(spark, d):
    return ag.aggregate_rows(_lines(spark, d), ["l_orderkey"], {"l_returnflag": "distinct"}, _line())


@query("agg_join_nonnull", "select l_orderkey, string_agg(l_linestatus, ' + ' order by l_linenumber, l_extendedprice) as l_linestatus from lineitem group by 1")
def agg_join_nonnull(spark, d):
    return ag.aggregate_rows(_lines(spark, d), ["l_orderkey"], {"l_linestatus": "join_nonnull"}, _line())


@query("agg_list", "select l_orderkey, string_agg(cast(l_partkey as varchar), ',' order by l_linenumber, l_extendedprice) as parts from lineitem group by 1")
def agg_list(spark, d):
    out = ag.aggregate_rows(_lines(spark, d), ["l_orderkey"], {"l_partkey": "list"}, _line())
    return out.select("l_orderkey", F.array_join("l_partkey", ",").alias("parts"))


@query(
    "group_weighted_mode",
    """with s as (select l_partkey, l_returnflag, sum(l_extendedprice) as w, min((l_orderkey, l_linenumber)) as o from lineitem group by 1, 2), b as (select l_partkey, l_returnflag, row_number() over (partition by l_partkey order by w desc, o) as k from s)
    select l_orderkey, l_linenumber, b.l_returnflag as commonest from lineitem l join b on b.l_partkey = l.l_partkey and k = 1""",
)
def group_weighted_mode(spark, d):
    return ag.weighted_mode(_lines(spark, d), "l_partkey", "l_returnflag", "l_extendedprice", [c("l_orderkey"), c("l_linenumber")], "commonest").select("l_orderkey", "l_linenumber", "commonest")


@query("unique_suffix", "select s_suppkey, concat(n_name, '-', row_number() over (partition by n_name order by s_suppkey)) as label from supplier join nation on s_nationkey = n_nationkey where s_nationkey in (select s_nationkey from supplier group by 1 having count(*) > 1)")
def unique_suffix(spark, d):
    rows = load(spark, d, "supplier").join(load(spark, d, "nation"), c("s_nationkey") == c("n_nationkey"))
    out = ag.unique_suffix(rows, "n_name", [c("s_suppkey")], "label")
    return out.where(c("label") != c("n_name")).select("s_suppkey", "label")


@query("unique_index", "select s_suppkey, case when k = 1 then n_name else concat(n_name, '_', k - 1) end as label from (select s_suppkey, n_name, row_number() over (partition by n_name order by s_suppkey) as k from supplier join nation on s_nationkey = n_nationkey)")
def unique_index(spark, d):
    rows = load(spark, d, "supplier").join(load(spark, d, "nation"), c("s_nationkey") == c("n_nationkey"))
    return ag.unique_suffix(rows, "n_name", [c("s_suppkey")], "label", first_too=False, separator="_").select("s_suppkey", "label")


@query("issued_id_normalize", "select p_partkey, trim(regexp_replace(upper(concat('#', p_brand, '/', p_name)), '[^A-Z0-9]+', '-', 'g'), '-') as id, cast(null as varchar) as zero from part")
def issued_id_normalize(spark, d):
    return load(spark, d, "part").select("p_partkey", ag.normal_id(F.concat(F.lit("#"), "p_brand", F.lit("/"), "p_name")).alias("id"), ag.normal_id(F.lit("00-0")).alias("zero"))


@query("derive_ratio", "select l_orderkey, l_linenumber, round(ln(l_extendedprice / l_quantity), 6) as ratio from lineitem")
def derive_ratio(spark, d):
    return _lines(spark, d).select("l_orderkey", "l_linenumber", F.round(F.ln(sc.divide(c("l_extendedprice"), c("l_quantity"))), 6).alias("ratio"))


@query("value_map", "select l_orderkey, l_linenumber, case when l_returnflag = 'A' and l_linestatus = 'F' then 1::double when l_returnflag = 'N' and l_linestatus = 'O' then 0.5::double else 0::double end as grade from lineitem")
def value_map(spark, d):
    grade = gr.value_map([c("l_returnflag"), c("l_linestatus")], {("A", "F"): 1.0, ("N", "O"): 0.5}, 0.0, None)
    return _lines(spark, d).select("l_orderkey", "l_linenumber", grade.alias("grade"))


@query("minimum", "select l_orderkey, l_linenumber, least(l_tax, l_discount) as low from lineitem")
def minimum(spark, d):
    return _lines(spark, d).select("l_orderkey", "l_linenumber", gr.minimum(c("l_tax"), c("l_discount")).alias("low"))


@query("group_share", "select l_orderkey, l_linenumber, round(avg(case when l_returnflag = 'R' then 1.0 else 0.0 end) over (partition by l_suppkey), 6) as share from lineitem")
def group_share(spark, d):
    return gr.share_of(_lines(spark, d), "l_suppkey", c("l_returnflag") == "R", "share").select("l_orderkey", "l_linenumber", F.round("share", 6).alias("share"))


@query(
    "group_class_share",
    "select l_orderkey, l_linenumber, case when n >= 5 then round((m - hit) * 1.0 / (n - 1), 6) end as share from (select l_orderkey, l_linenumber, hit, count(*) over w as n, sum(hit) over w as m from (select *, cast(l_returnflag = 'A' as int) as hit from lineitem) window w as (partition by l_partkey))",
)
def group_class_share(spark, d):
    return gr.share_of(_lines(spark, d), "l_partkey", c("l_returnflag") == "A", "share", least=5, without_self=True).select("l_orderkey", "l_linenumber", F.round("share", 6).alias("share"))


@query("cohort_threshold", "select p_partkey, round(p_retailprice / case when n >= 10 then greatest(100.0, m * 0.5) else 900.0 end, 6) as against from (select *, count(*) over w as n, avg(p_retailprice) over w as m from part window w as (partition by p_brand))")
def cohort_threshold(spark, d):
    return gr.cohort_threshold(load(spark, d, "part"), "p_brand", "p_retailprice", 100.0, 0.5, 10, 900.0, "against").select("p_partkey", F.round("against", 6).alias("against"))


@query("group_zscore", "select p_partkey, round((ln(1 + p_retailprice) - avg(ln(1 + p_retailprice)) over w) / nullif(stddev_pop(ln(1 + p_retailprice)) over w, 0), 4) as z from part window w as (partition by p_brand)")
def group_zscore(spark, d):
    return gr.zscore(load(spark, d, "part"), "p_brand", F.log1p("p_retailprice"), "z").select("p_partkey", F.round("z", 4).alias("z"))


@query(
    "group_percentile",
    "select p_partkey, round((rank() over (partition by p_brand order by p_size) + (count(*) over (partition by p_brand, p_size) - 1) / 2.0) / count(*) over (partition by p_brand), 6) as place from part",
)
def group_percentile(spark, d):
    return gr.percentile(load(spark, d, "part"), "p_brand", "p_size", "place").select("p_partkey", F.round("place", 6).alias("place"))


@query("group_count", "select s_suppkey, count(*) over (partition by s_nationkey) as n from supplier")
def group_count(spark, d):
    rows = load(spark, d, "supplier")
    return rows.join(rows.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")), "s_nationkey").select("s_suppkey", "n")


@query("group_rank", "select s_suppkey, case when s_acctbal > 0 then row_number() over (partition by s_nationkey, s_acctbal > 0 order by s_acctbal desc, s_suppkey) end as place from supplier")
def group_rank(spark, d):
    return gr.rank_in(load(spark, d, "supplier"), "s_nationkey", "s_acctbal", "s_suppkey", "place", c("s_acctbal") > 0).select("s_suppkey", c("place").cast("long").alias("place"))


def _gaps(spark, d):
    return load(spark, d, "part").withColumn("size", F.when(c("p_partkey") % 7 != 0, c("p_size")))


GAPS = "(select *, case when p_partkey % 7 <> 0 then p_size end as size from part)"


@query("impute_group_mean", f"select p_partkey, round(coalesce(size, avg(size) over (partition by p_brand)), 6) as size, case when size is null then 'imputed' end as size_source from {GAPS}")
def impute_group_mean(spark, d):
    out = gr.impute(_gaps(spark, d).withColumn("size", c("size").cast("double")), "p_brand", "size", "mean")
    return out.select("p_partkey", F.round("size", 6).alias("size"), "size_source")


@query("impute_group_median", f"select p_partkey, coalesce(size, m) as size, case when size is null then 'imputed' end as size_source from {GAPS} p join (select p_brand as b, median(size) as m from {GAPS} group by 1) on b = p_brand")
def impute_group_median(spark, d):
    return gr.impute(_gaps(spark, d).withColumn("size", c("size").cast("double")), "p_brand", "size", "median").select("p_partkey", "size", "size_source")


@query(
    "impute_group_mode",
    f"""with n as (select p_brand as b, size, count(*) as n from {GAPS} where size is not null group by 1, 2), m as (select b, min(size) as s from (select *, max(n) over (partition by b) as most from n) where n = most group by 1)
    select p_partkey, coalesce(size, s) as size, case when size is null then 'imputed' end as size_source from {GAPS} p join m on b = p_brand""",
)
def impute_group_mode(spark, d):
    return gr.impute(_gaps(spark, d), "p_brand", "size", "mode").select("p_partkey", "size", "size_source")


@query("fill_numeric", f"select p_partkey, coalesce(size, 0) as size from {GAPS}")
def fill_numeric(spark, d):
    return _gaps(spark, d).select("p_partkey", filled_number(c("size"), 0, "int").alias("size"))


@query(
    "land_rate_impute",
    """with r as (select *, case when p_partkey % 7 <> 0 then p_retailprice end as land from part), a as (select p_brand as b, p_type as t, sum(land) / sum(p_size) as rate from r where land is not null group by 1, 2 having count(*) >= 5), o as (select p_brand as b2, sum(land) / sum(p_size) as rate2 from r where land is not null group by 1)
    select p_partkey, round(coalesce(land, least(10000.0, coalesce(rate, rate2) * p_size)), 4) as land, case when land is null then case when rate is not null then 'brand+type' else 'brand' end end as land_source from r left join a on b = p_brand and t = p_type left join o on b2 = p_brand""",
)
def land_rate_impute(spark, d):
    """Rate per size from the first tier with enough donors, capped."""
    rows = load(spark, d, "part").withColumn("land", F.when(c("p_partkey") % 7 != 0, c("p_retailprice")))
    out = gr.impute_rate(rows, "land", "p_size", [("brand+type", ["p_brand", "p_type"], 5), ("brand", ["p_brand"], 1)], 10000.0)
    return out.select("p_partkey", F.round("land", 4).alias("land"), "land_source")
