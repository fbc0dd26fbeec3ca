"""Queries that run a recipe, and the flagship."""

from __future__ import annotations

from cadastra.plans.catalogue import load, query
from cadastra.plans.recipe import load_recipe, run_recipe

ORDER_TOTALS = """
source: orders
pipeline:
  - step: transformations
    items:
      - {type: datetime, operation: year, column: o_orderdate, output: order_year}
      - {type: remap, column: o_orderstatus, mapping: {O: open, F: filled}, default: partial, output: status}
      - {type: expression, expression: "({o_totalprice} > 100000) & {status}.isin(['open', 'filled'])", output: large}
  - step: query
    text: "o_totalprice > 1000 and order_year.notna()"
  - step: aggregate_from_entities
    reference: lineitem
    reference_key: l_orderkey
    key: o_orderkey
    how: {l_quantity: sum, l_extendedprice: max}
    rename: {l_quantity: quantity, l_extendedprice: best_price}
    count_as: n_lines
  - step: null_out_of_range
    columns: [best_price]
    maximum: 90000
  - step: order_columns
    first: [o_orderkey, status, order_year, large, n_lines, quantity, best_price]
  - step: drop_columns
    columns: [o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority]
"""


@query(
    "recipe_order_totals",
    """with s as (select l_orderkey, sum(l_quantity) as quantity, max(l_extendedprice) as best_price, count(*) as n_lines from lineitem group by 1)
    select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else 'partial' end as status, cast(year(o_orderdate) as int) as order_year, o_totalprice > 100000 and o_orderstatus in ('O', 'F') as large,
    coalesce(n_lines, 0) as n_lines, quantity, case when best_price <= 90000 then best_price end as best_price from orders left join s on l_orderkey = o_orderkey where o_totalprice > 1000""",
)
def recipe_order_totals(spark, d):
    return run_recipe(load_recipe(ORDER_TOTALS), lambda name: load(spark, d, name))
