"""Queries of address text."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import addresses as ad
from cadastra.plans.catalogue import load, query

c = F.col


@query(
    "address_numbers",
    """select s_suppkey, cast(s_suppkey % 90 + 1 as varchar) as low, cast(s_suppkey % 90 + 7 as varchar) || 'B' as high,
    cast(least(s_suppkey, s_nationkey) as varchar) || case when s_suppkey = s_nationkey then '' else '-' || cast(greatest(s_suppkey, s_nationkey) as varchar) end as span, cast(null as varchar) as words from supplier""",
)
def address_numbers(spark, d):
    rows = load(spark, d, "supplier")
    pair = ad.number_range(F.concat(c("s_suppkey") % 90 + 1, F.lit(" - "), c("s_suppkey") % 90 + 7, F.lit("b")))
    span = ad.number_list(F.concat(c("s_suppkey"), F.lit("A; "), c("s_nationkey")))
    return rows.select("s_suppkey", pair["low"].alias("low"), pair["high"].alias("high"), span.alias("span"), ad.number_list(F.concat(c("s_suppkey"), F.lit(" MAIN"))).alias("words"))


@query("address_lists", "select s_suppkey, unnest([cast(s_suppkey as varchar) || ' OAK ST', cast(s_nationkey as varchar) || ' ELM RD']) as line from supplier")
def address_lists(spark, d):
    rows = load(spark, d, "supplier")
    joined = F.concat(c("s_suppkey"), F.lit(" OAK ST UNIT 4 + "), c("s_nationkey"), F.lit(" ELM RD # 2; "))
    return rows.select("s_suppkey", F.explode(ad.split_list(joined)).alias("line")).select("s_suppkey", ad.without_unit(c("line")).alias("line"))


@query("address_similarity")
def address_similarity(spark, d):
    rows = load(spark, d, "supplier")
    other = F.concat(F.lit("supplier "), F.reverse(c("s_suppkey").cast("string")))
    return rows.select("s_suppkey", F.round(ad.similarity(F.lower("s_name"), other), 6).alias("similarity"))
