"""Queries of the scalar catalogue, predicates and votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import predicates as pr
from cadastra.functions import scalar as sc
from cadastra.operators import groups as gr
from cadastra.plans.catalogue import load, query

c = F.col


@query(
    "scalar_unary_math",
    """select l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) as log_price, round(asinh(l_quantity), 6) as asinh_qty, round(sqrt(l_extendedprice), 6) as root,
    round(exp(l_discount), 6) as exp_discount, abs(l_tax - 0.05) as off, round(pow(l_quantity, 2), 6) as square, round(l_quantity * 43560.0, 2) as sqft from lineitem""",
)
def scalar_unary_math(spark, d):
    u = sc.UNARY
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(u["log"](c("l_extendedprice")), 6).alias("log_price"), F.round(u["arcsinh"](c("l_quantity")), 6).alias("asinh_qty"), F.round(u["sqrt"](c("l_extendedprice")), 6).alias("root"),
        F.round(u["exp"](c("l_discount")), 6).alias("exp_discount"), u["abs"](c("l_tax") - 0.05).alias("off"), F.round(u["power"](c("l_quantity"), 2), 6).alias("square"), F.round(u["acres_to_sqft"](c("l_quantity")), 2).alias("sqft"),
    )


@query(
    "scalar_median_centred",
    "select l_orderkey, l_linenumber, round(asinh(l_extendedprice / (select median(l_extendedprice) from lineitem)), 6) as centred from lineitem",
)
def scalar_median_centred(spark, d):
    rows = load(spark, d, "lineitem")
    middle = gr.median_of(rows, "l_extendedprice", "m")
    return rows.join(F.broadcast(middle)).select("l_orderkey", "l_linenumber", F.round(F.asinh(c("l_extendedprice") / c("m")), 6).alias("centred"))


@query(
    "scalar_parse_currency",
    "select o_orderkey, o_totalprice as parsed, -o_totalprice as negative, cast(null as double) as junk from orders",
)
def scalar_parse_currency(spark, d):
    price = F.format_string("%.2f", c("o_totalprice"))
    return load(spark, d, "orders").select("o_orderkey", sc.parse_currency(F.concat(F.lit("$ "), price)).alias("parsed"), sc.parse_currency(F.concat(F.lit("("), price, F.lit(")"))).alias("negative"), sc.parse_currency(F.concat(price, F.lit("d"))).alias("junk"))


@query(
    "scalar_resolve_century",
    "select o_orderkey, cast(case when year(o_orderdate) % 100 <= 68 then 2000 + year(o_orderdate) % 100 else 1900 + year(o_orderdate) % 100 end as double) as resolved, cast(year(o_orderdate) as double) as kept from orders",
)
def scalar_resolve_century(spark, d):
    y = F.year("o_orderdate")
    return load(spark, d, "orders").select("o_orderkey", sc.resolve_century(y % 100).alias("resolved"), sc.resolve_century(y).alias("kept"))


@query(
    "scalar_null_if_equal",
    "select event_id, nullif(event_type, 'click') as kind, date_trunc('millisecond', ts) as at, cast(null as double) as nothing from events",
)
def scalar_null_if_equal(spark, d):
    ms = F.unix_millis(c("ts").cast("timestamp"))
    return load(spark, d, "events").select("event_id", sc.UNARY["null_if_equal"](c("event_type"), "click").alias("kind"), sc.UNARY["epoch_ms_to_datetime"](ms).alias("at"), sc.UNARY["set_null"](c("value")).alias("nothing"))


@query(
    "scalar_binary",
    """select l_orderkey, l_linenumber, l_extendedprice + l_quantity as a, l_extendedprice - l_quantity as s, round(l_quantity * (1 - l_discount), 9) as m,
    round(l_extendedprice / l_quantity, 9) as q, l_linenumber % 3 as r from lineitem""",
)
def scalar_binary(spark, d):
    b = sc.BINARY
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", b["add"](c("l_extendedprice"), c("l_quantity")).alias("a"), b["subtract"](c("l_extendedprice"), c("l_quantity")).alias("s"), F.round(b["multiply"](c("l_quantity"), 1 - c("l_discount")), 9).alias("m"),
        F.round(b["divide"](c("l_extendedprice"), c("l_quantity")), 9).alias("q"), b["mod"](c("l_linenumber"), F.lit(3)).cast("int").alias("r"),
    )


@query(
    "scalar_rowwise_agg",
    """select l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 6) as total, least(l_quantity, l_discount, l_tax) as low, greatest(l_quantity, l_discount, l_tax) as high,
    round((l_quantity + l_discount + l_tax) / 3, 6) as middle, cast(l_discount > 0.05 or l_tax > 0.05 as int) as any_high, cast(l_discount > 0.05 and l_tax > 0.05 as int) as all_high, coalesce(nullif(l_returnflag, ''), l_linestatus) as stated from lineitem""",
)
def scalar_rowwise_agg(spark, d):
    x = (c("l_quantity"), c("l_discount"), c("l_tax"))
    a = sc.ACROSS
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(a["sum"](*x), 6).alias("total"), a["min"](*x).alias("low"), a["max"](*x).alias("high"), F.round(a["mean"](*x), 6).alias("middle"),
        a["any_gt"](*x[1:], threshold=0.05).alias("any_high"), a["all_gt"](*x[1:], threshold=0.05).alias("all_high"), a["coalesce"](c("l_returnflag"), c("l_linestatus")).alias("stated"),
    )


@query(
    "scalar_conditional",
    """select o_orderkey, cast(o_totalprice < 100000 as int) as less_than, cast(o_totalprice <= 100000 as int) as less_equal, cast(o_totalprice > 100000 as int) as greater_than, cast(o_totalprice >= 100000 as int) as greater_equal,
    cast(o_orderstatus = 'O' as int) as equal, cast(o_orderstatus <> 'O' as int) as not_equal from orders""",
)
def scalar_conditional(spark, d):
    number = ("less_than", "less_equal", "greater_than", "greater_equal")
    return load(spark, d, "orders").select("o_orderkey", *(sc.compare(n, c("o_totalprice"), 100000).alias(n) for n in number), *(sc.compare(n, c("o_orderstatus"), "O").alias(n) for n in ("equal", "not_equal")))


@query(
    "scalar_datetime",
    """select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(day(o_orderdate) as int) as day, cast(dayofyear(o_orderdate) as int) as dayofyear, cast(quarter(o_orderdate) as int) as quarter,
    strftime(o_orderdate, '%Y-%m') as year_month, concat(year(o_orderdate), '-', quarter(o_orderdate)) as year_quarter, round(year(o_orderdate) + dayofyear(o_orderdate) / 365.0, 6) as year_continuous from orders""",
)
def scalar_datetime(spark, d):
    out = {n: f(c("o_orderdate")) for n, f in sc.DATETIME.items()}
    out["year_continuous"] = F.round(out["year_continuous"], 6)
    return load(spark, d, "orders").select("o_orderkey", *(x.alias(n) for n, x in out.items()))


@query(
    "scalar_string",
    """select p_partkey, upper(p_name) as up, lower(p_brand) as low, substring(p_name, 2, 3) as middle, right(p_name, 3) as tail, trim(concat('  ', p_name, ' ')) as stripped, ltrim(p_brand, 'Brand#') as bare,
    replace(p_type, 'A', 'x') as swapped, concat('P-', p_partkey) as prefixed, split_part(p_name, ' ', 1) as head, lpad(cast(p_partkey as varchar), 8, '0') as padded, concat(p_brand, '|', cast(p_size as varchar)) as joined from part""",
)
def scalar_string(spark, d):
    s = sc.STRING
    return load(spark, d, "part").select(
        "p_partkey", s["upper"](c("p_name")).alias("up"), s["lower"](c("p_brand")).alias("low"), s["substring"](c("p_name"), 1, 4).alias("middle"), s["substring"](c("p_name"), -3).alias("tail"),
        s["strip"](F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("stripped"), s["lstrip"](c("p_brand"), "Brand#").alias("bare"), s["replace"](c("p_type"), "A", "x").alias("swapped"),
        s["add_prefix"](c("p_partkey").cast("string"), "P-").alias("prefixed"), s["split_take"](c("p_name"), " ", 0).alias("head"), s["zfill"](c("p_partkey").cast("string"), 8).alias("padded"), sc.concat([c("p_brand"), c("p_size")], "|").alias("joined"),
    )


@query("scalar_title_smart", "select c_custkey, 'Casa de la ' || upper(substring(lower(c_name), 1, 1)) || substring(lower(c_name), 2) as title from customer")
def scalar_title_smart(spark, d):
    return load(spark, d, "customer").select("c_custkey", sc.title_smart(F.concat(F.lit("CASA DE LA "), "c_name")).alias("title"))


@query("scalar_extract", "select page_id, nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') as host, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') as page from pages")
def scalar_extract(spark, d):
    return load(spark, d, "pages").select("page_id", sc.extract(c("url"), "^https?://([^/?#]+)").alias("host"), sc.extract(c("url"), "[?&]page=([0-9]+)").alias("page"))


@query("remap_exact", "select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else 'other' end as status from orders")
def remap_exact(spark, d):
    return load(spark, d, "orders").select("o_orderkey", sc.remap(c("o_orderstatus"), {"O": "open", "F": "filled"}, "other").alias("status"))


@query(
    "remap_pattern",
    "select o_orderkey, case when regexp_matches(o_orderpriority, '^(?:[1-2])') then 'high' when regexp_matches(o_orderpriority, '^(?:[0-9])') then 'any' else 'none' end as level from orders",
)
def remap_pattern(spark, d):
    return load(spark, d, "orders").select("o_orderkey", sc.remap_pattern(c("o_orderpriority"), [("[0-9]", "any"), ("[1-2]", "high")], "none").alias("level"))


@query(
    "remap_conditional",
    "select p_partkey, case when p_name like '%a%' then 'has a' when p_brand in ('Brand#11', 'Brand#12') then 'listed' when starts_with(p_type, 'S') then 's' else p_type end as kind from part",
)
def remap_conditional(spark, d):
    rules = [("startswith", "S", "s")]
    rows = load(spark, d, "part")
    by_type = sc.remap_conditional(c("p_type"), rules, c("p_type"))
    by_brand = sc.remap_conditional(c("p_brand"), [("in", ["Brand#11", "Brand#12"], "listed")], by_type)
    return rows.select("p_partkey", sc.remap_conditional(c("p_name"), [("contains", "a", "has a")], by_brand).alias("kind"))


@query("remap_file", "select c_custkey, n_name as nation, r_name as region from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
def remap_file(spark, d):
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    rows = load(spark, d, "customer").join(nation, c("c_nationkey") == c("n_nationkey"), "left").join(region, c("n_regionkey") == c("r_regionkey"), "left")
    return rows.select("c_custkey", c("n_name").alias("nation"), c("r_name").alias("region"))


INDICATORS = {
    "greater": ({"kind": "column_greater_than", "column": "p_retailprice", "other": "p_size"}, "p_retailprice > p_size"),
    "share_below": ({"kind": "value_share_below", "column": "p_size", "total": ["p_size", "p_retailprice"], "ratio": 0.02}, "p_size / (p_size + p_retailprice) < 0.02"),
    "share_from": ({"kind": "value_share_at_least", "column": "p_size", "total": ["p_size", "p_retailprice"], "ratio": 0.02}, "p_size / (p_size + p_retailprice) >= 0.02"),
    "keyword": ({"kind": "keyword", "column": "p_name", "pattern": "AN"}, "contains(lower(p_name), 'an')"),
    "pattern": ({"kind": "keyword", "column": "p_type", "pattern": "^(s|p)", "regex": True}, "regexp_matches(lower(p_type), '^(s|p)')"),
    "equals": ({"kind": "equals", "column": "p_size", "value": 7}, "p_size = 7"),
    "listed": ({"kind": "in_set", "column": "p_size", "values": [1, 2, 3]}, "p_size in (1, 2, 3)"),
    "stated": ({"kind": "not_null", "column": "p_brand"}, "p_brand is not null"),
    "missing": ({"kind": "is_null", "column": "p_brand"}, "p_brand is null"),
    "at_least": ({"kind": "numeric_at_least", "column": "p_size", "value": 25}, "p_size >= 25"),
    "at_most": ({"kind": "numeric_at_most", "column": "p_size", "value": 25}, "p_size <= 25"),
    "below": ({"kind": "numeric_below", "column": "p_size", "value": 25}, "p_size < 25"),
    "absent": ({"kind": "not_null", "column": "no_such_column"}, "false"),
}
COMBINED = {
    "any_of": ({"kind": "any_of", "of": [INDICATORS["equals"][0], INDICATORS["keyword"][0]]}, "p_size = 7 or contains(lower(p_name), 'an')"),
    "all_of": ({"kind": "all_of", "of": [INDICATORS["at_least"][0], INDICATORS["keyword"][0]]}, "p_size >= 25 and contains(lower(p_name), 'an')"),
    "none_of": ({"kind": "none_of", "of": [INDICATORS["absent"][0], INDICATORS["below"][0]]}, "not p_size < 25"),
}


def _indicators(name: str, specs: dict) -> None:
    @query(name, "select p_partkey, " + ", ".join(f"{sql} as {n}" for n, (_, sql) in specs.items()) + " from part")
    def run(spark, d):
        rows = load(spark, d, "part")
        return rows.select("p_partkey", *(pr.indicator(rows, spec).alias(n) for n, (spec, _) in specs.items()))


_indicators("indicators_numeric", {k: INDICATORS[k] for k in ("greater", "share_below", "share_from", "at_least", "at_most", "below")})
_indicators("indicators_text", {k: INDICATORS[k] for k in ("keyword", "pattern", "equals", "listed", "stated", "missing", "absent")})
_indicators("indicators_combined", COMBINED)


@query("indicators_token", "select l_orderkey, l_linenumber, l_returnflag in ('A', 'R') or l_linestatus in ('A', 'R') as hit from lineitem")
def indicators_token(spark, d):
    rows = load(spark, d, "lineitem").withColumn("tokens", F.concat_ws(" + ", "l_returnflag", "l_linestatus"))
    return rows.select("l_orderkey", "l_linenumber", pr.indicator(rows, {"kind": "has_token", "column": "tokens", "values": ["A", "R"]}).alias("hit"))


@query(
    "vote_enumerated",
    """with s as (select p_partkey, (case when p_size >= 25 then 2.0 else 0.0 end) + (case when contains(lower(p_name), 'an') then 1.0 else 0.0 end) as a, (case when p_retailprice < 1200 then 2.0 else 0.0 end) as b from part)
    select p_partkey, case when a >= 1 and a >= b then 'large' when b >= 1 then 'cheap' end as winner, cast(case when a >= 1 and a >= b then a when b >= 1 then b end as double) as winner_score,
    case when a >= 1 and b >= 1 then case when a >= b then 'cheap' else 'large' end end as runner_up from s""",
)
def vote_enumerated(spark, d):
    decisions = [
        {"label": "large", "evidence": [{"name": "size", "weight": 2, "test": INDICATORS["at_least"][0]}, {"name": "name", "weight": 1, "test": INDICATORS["keyword"][0]}]},
        {"label": "cheap", "evidence": [{"name": "price", "weight": 2, "test": {"kind": "numeric_below", "column": "p_retailprice", "value": 1200}}]},
    ]
    return pr.vote(load(spark, d, "part"), decisions).select("p_partkey", "winner", "winner_score", "runner_up")


@query(
    "vote_open",
    """select o_orderkey, case when o_orderstatus = left(o_orderpriority, 1) then o_orderstatus when 1.0 >= 1.0 then o_orderstatus end as winner, case when o_orderstatus = left(o_orderpriority, 1) then 2::double else 1::double end as score,
    case when o_orderstatus = left(o_orderpriority, 1) then 'status/priority' else 'status' end as evidence from orders""",
)
def vote_open(spark, d):
    ballots = [("status", c("o_orderstatus"), 1.0), ("priority", F.left("o_orderpriority", F.lit(1)), 1.0)]
    return pr.open_vote(load(spark, d, "orders"), ballots).select("o_orderkey", "winner", "score", "evidence")


@query("ruleset_match", "select doc_id, case when text is null then 'empty' when regexp_matches(text, '(?i)apache license') then 'license' when regexp_matches(text, '(?i)the') then 'english' else 'other' end as kind from documents")
def ruleset_match(spark, d):
    return load(spark, d, "documents").select("doc_id", pr.ruleset(c("text"), [("apache license", "license"), ("the", "english")], "empty", "other").alias("kind"))
