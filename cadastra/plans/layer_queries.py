"""Queries of yearly pixel layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import layers as la
from cadastra.plans.catalogue import load, query

c = F.col
PIXELS = """with recursive p as (select o_custkey % 40 as pixel, cast(year(o_orderdate) as int) as year, case when count(*) % 5 <> 0 then case when count(*) % 3 > 0 then 1 else 0 end end as v from orders group by 1, 2)"""


def _layers(spark, d):
    n = F.count(F.lit(1))
    value = F.when(n % 5 != 0, F.when(n % 3 > 0, 1).otherwise(0))
    return load(spark, d, "orders").groupBy((c("o_custkey") % 40).alias("pixel"), F.year("o_orderdate").alias("year")).agg(value.alias("v"))


@query(
    "layer_transitions",
    f"{PIXELS} select a.pixel, a.year, case when a.v is not null and b.v is not null then cast(b.v = 1 and a.v = 0 as int) end as lost from p a left join p b on a.pixel = b.pixel and b.year = a.year - 1",
)
def layer_transitions(spark, d):
    return la.transitions(_layers(spark, d), ["pixel"], "year", "v", 1, 0, "lost").drop("v")


@query(
    "layer_never_regained",
    f"""{PIXELS}, s as (select pixel, year, v, v as state from p a where not exists (select 1 from p b where b.pixel = a.pixel and b.year = a.year - 1)
    union all select p.pixel, p.year, p.v, case when p.v is null then null when s.state is null then p.v else least(s.state, p.v) end from s join p on p.pixel = s.pixel and p.year = s.year + 1)
    select pixel, year, state from s""",
)
def layer_never_regained(spark, d):
    return la.never_regained(_layers(spark, d), ["pixel"], "year", "v", "state").drop("v")


@query(
    "layer_masks",
    f"""{PIXELS} select pixel, max(v) as ever, max(case when year = 1995 then v end) as start,
    case when max(v) is not null then cast(max(v) = 1 and coalesce(max(case when year = 1995 then v end), 0) <> 1 as int) end as later,
    case when max(v) is not null then cast(max(v) = 1 and not (pixel % 7 between 1 and 3) as int) end as cover from p group by pixel""",
)
def layer_masks(spark, d):
    every = _layers(spark, d).groupBy("pixel").agg(la.any_year(c("v")).alias("ever"), la.any_year(F.when(c("year") == 1995, c("v"))).alias("start"))
    return every.select("*", la.but_not(c("ever"), c("start")).alias("later"), la.cover_less_loss(c("ever"), c("pixel") % 7, 2003).alias("cover"))
