"""Recipes: a table built by an ordered list of named steps, compiled to one lazy DataFrame plan.

A recipe is a mapping (or YAML text): `source`, optional `pipeline`.  Each step
is {step: name, ...parameters}.  Steps of the curate phases must come in order.
Other tables that a step needs come from `tables`, a function from a name to a
DataFrame, so nothing is read that no step asks for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import predicates as pr
from cadastra.functions import scalar as sc
from cadastra.functions.expressions import expression
from cadastra.operators import aggregates as ag
from cadastra.operators import groups as gr
from cadastra.operators import links as ln
from cadastra.operators import sales as sa
from cadastra.operators import tables as tb

PHASES = ("gather", "reconcile", "standardize", "infer", "format")
STEPS: dict[str, tuple[Callable, str | None]] = {}


def step(name: str, phase: str | None = None):
    """Register a step f(df, tables, **parameters) -> DataFrame; a step with a phase can't follow one of a later phase."""

    def add(f: Callable) -> Callable:
        STEPS[name] = (f, phase)
        return f

    return add


def load_recipe(text: str) -> dict:
    import yaml

    return yaml.safe_load(text)


def patched(recipe: dict, patch: dict) -> dict:
    """A recipe with values of another over its own; mappings are merged, lists replaced."""
    out = dict(recipe)
    for k, v in patch.items():
        out[k] = patched(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def check(recipe: dict) -> None:
    """Raises on unknown steps and on phases out of order."""
    at = 0
    for s in recipe.get("pipeline", []):
        if s["step"] not in STEPS:
            raise ValueError(f"unknown step: {s['step']}")
        phase = STEPS[s["step"]][1]
        if phase:
            k = PHASES.index(phase)
            if k < at:
                raise ValueError(f"step {s['step']} belongs to {phase}, which comes before {PHASES[at]}")
            at = k


def run_recipe(recipe: dict, tables: Callable[[str], DataFrame]) -> DataFrame:
    check(recipe)
    df = tables(recipe["source"])
    for s in recipe.get("pipeline", []):
        f, _ = STEPS[s["step"]]
        df = f(df, tables, **{k: v for k, v in s.items() if k != "step"})
    return df


def dependencies(recipe: dict) -> list[str]:
    """Names of the tables that a recipe reads, its source first."""
    found = [recipe["source"]]
    for s in recipe.get("pipeline", []):
        found += [v for k, v in s.items() if k in ("reference", "crosswalk") and isinstance(v, str) and v not in found]
    return found


def transformation(df: DataFrame, spec: dict) -> Column | None:
    """Column of one transformation {type, operation, column(s), ...}; None where all its inputs are absent."""
    kind, op = spec["type"], spec.get("operation")
    names = spec.get("columns") or [spec[k] for k in ("column", "column2") if k in spec]
    if names and not any(n in df.columns for n in names):
        return None
    options = {k: v for k, v in spec.items() if k not in ("type", "operation", "column", "column2", "columns", "output", "admin_ids")}
    here = [F.col(n) for n in names if n in df.columns]
    kinds = dict(df.dtypes)
    if kind == "unary":
        return sc.UNARY[op](here[0], **options)
    if kind == "binary":
        b = F.lit(options["value"]) if "value" in options else here[1]
        return sc.BINARY[op](here[0], b)
    if kind == "aggregate":
        return sc.ACROSS[op](*here, **options)
    if kind == "conditional":
        return sc.compare(op, here[0], options["value"])
    if kind == "datetime":
        return sc.DATETIME[op](here[0])
    if kind == "string" and op == "concat":
        return sc.concat([sc.as_text(F.col(n), kinds[n]) for n in names if n in df.columns], options.get("sep", ""))
    if kind == "string" and op == "coalesce":
        return sc.text_coalesce(here, tuple(options.get("empty_values", ())))
    if kind == "string":
        return sc.STRING[op](here[0], **options)
    if kind == "expression":
        return expression(spec["expression"])
    if kind == "remap":
        return sc.remap(here[0], options["mapping"], options.get("default"))
    if kind == "remap_pattern":
        return sc.remap_pattern(here[0], list(options["patterns"].items()), options.get("default"))
    if kind == "remap_conditional":
        return sc.remap_conditional(here[0], [(r["test"], r["value"], r["result"]) for r in options["rules"]])
    raise ValueError(f"unknown transformation: {kind}")


@step("transformations")
def transformations(df: DataFrame, tables, items: list[dict], admin_column: str | None = None) -> DataFrame:
    """In order.  With admin_ids, a transformation holds in those units and their descendants, elsewhere the column stays."""
    for spec in items:
        value = transformation(df, spec)
        if value is None:
            continue
        if spec.get("admin_ids") and admin_column:
            inside = F.lit(False)
            for a in spec["admin_ids"]:
                inside = inside | tb.covers(F.lit(a), F.col(admin_column))
            value = F.when(inside, value).otherwise(F.col(spec["output"]) if spec["output"] in df.columns else F.lit(None))
        df = df.withColumn(spec["output"], value)
    return df


@step("columns")
def columns(df: DataFrame, tables, names: dict[str, str]) -> DataFrame:
    """Rename source columns and keep only those; absent ones are left out."""
    return df.select(*(F.col(a).alias(b) for a, b in names.items() if a in df.columns))


@step("null_values")
def null_values(df: DataFrame, tables, values: list) -> DataFrame:
    texts = [n for n, k in df.dtypes if k == "string"]
    return df.withColumns({n: F.when(~F.col(n).isin(*values), F.col(n)) for n in texts}) if texts else df


@step("query")
def where(df: DataFrame, tables, text: str) -> DataFrame:
    return df.where(expression(text))


@step("drop_duplicates")
def drop_duplicates(df: DataFrame, tables, columns: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Whole rows, or the first row in an order for each value of some columns."""
    if not columns:
        return df.distinct()
    others = [n for n in df.columns if n not in columns]
    first = df.groupBy(*columns).agg(F.min(F.struct(*(order or []), *(n for n in others if n not in (order or [])))).alias("r"))
    return first.select(*(F.col(n) if n in columns else F.col(f"r.{n}") for n in df.columns))


@step("drop_columns")
def drop_columns(df: DataFrame, tables, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


@step("aggregate_rows")
def aggregate_rows(df: DataFrame, tables, by: list[str], how: dict[str, str], order: str) -> DataFrame:
    return ag.aggregate_rows(df, by, how, F.col(order))


@step("aggregate_from_entities", "gather")
def aggregate_from_entities(df: DataFrame, tables, reference: str, key: str, how: dict[str, str], mode: str = "fill", order: str | None = None, rename: dict[str, str] | None = None, reference_key: str | None = None, where: str | None = None, count_as: str | None = None) -> DataFrame:
    """Reference rows reduced by key and written onto the spine."""
    ref = tables(reference)
    ref = ref.where(expression(where)) if where else ref
    ref = ref.withColumnRenamed(reference_key, key) if reference_key and reference_key != key else ref
    names = rename or {}
    reduced = ref.where(F.col(key).isNotNull()).groupBy(key).agg(*(ag.reduce_column(c, h, F.col(order) if order else F.lit(0)).alias(names.get(c, c)) for c, h in how.items()), *([F.count(F.lit(1)).alias(count_as)] if count_as else []))
    out = ln.from_entities(df, reduced, key, [names.get(c, c) for c in how] + ([count_as] if count_as else []), mode)
    return out.withColumn(count_as, F.coalesce(count_as, F.lit(0))) if count_as else out


@step("link_by_id")
def link_by_id(df: DataFrame, tables, reference: str, key: str, how: dict[str, str], mode: str = "attributes", reference_key: str | None = None, order: str | None = None, suffix: str = "_new") -> DataFrame:
    ref = tables(reference)
    ref = ref.withColumnRenamed(reference_key, key) if reference_key else ref
    return ln.link_by_id(df, ref, key, how, F.col(order) if order else F.lit(0), mode, suffix)


@step("remap_file")
def remap_file(df: DataFrame, tables, crosswalk: str, column: str, key: str, value: str, output: str) -> DataFrame:
    table = tables(crosswalk).select(F.col(key).cast("string").alias("__k"), F.col(value).alias("__v")).dropDuplicates(["__k"])
    joined = df.join(table, F.col(column).cast("string") == F.col("__k"), "left")
    return joined.withColumn(output, F.col("__v")).drop("__k", "__v")


@step("join_temporal_snapshot", "gather")
def join_temporal_snapshot(df: DataFrame, tables, reference: str, keys: list[str], date: str, vintage: str, columns: list[str], direction: str = "backward") -> DataFrame:
    return ln.as_of(df, tables(reference), keys, date, vintage, columns, direction)


@step("reconcile_values", "reconcile")
def reconcile_values(df: DataFrame, tables, sources: dict[str, str], output: str, minimum: float | None = None, maximum: float | None = None) -> DataFrame:
    return tb.reconcile(df, list(sources.items()), output, minimum, maximum)


@step("suppress_where", "reconcile")
def suppress_where(df: DataFrame, tables, columns: list[str], indicator: dict) -> DataFrame:
    return tb.suppress(df, columns, pr.indicator(df, indicator))


@step("null_out_of_range", "reconcile")
def null_out_of_range(df: DataFrame, tables, columns: list[str], minimum: float | None = None, maximum: float | None = None) -> DataFrame:
    return tb.within(df, columns, minimum, maximum)


@step("filter", "reconcile")
def filter_rows(df: DataFrame, tables, indicator: dict, keep: bool = True) -> DataFrame:
    p = pr.indicator(df, indicator)
    return df.where(p if keep else ~p)


@step("resolve_by_vote", "reconcile")
def resolve_by_vote(df: DataFrame, tables, decisions: list[dict], output: str) -> DataFrame:
    out = pr.vote(df, decisions)
    return out.select(*df.columns, F.col("winner").alias(output), F.col("evidence").alias(f"{output}_source"))


@step("dedup_transactions")
def dedup_transactions(df: DataFrame, tables, key: list[str], order: list[str]) -> DataFrame:
    return sa.first_of_document(df, key, [F.col(o) for o in order])


@step("impute_group_stat", "infer")
def impute_group_stat(df: DataFrame, tables, by: str, column: str, statistic: str, least: int = 1) -> DataFrame:
    return gr.impute(df, by, column, statistic, least)


@step("derive_indicator", "infer")
def derive_indicator(df: DataFrame, tables, indicator: dict, output: str) -> DataFrame:
    return df.withColumn(output, pr.indicator(df, indicator))


@step("declare_columns", "gather")
def declare_columns(df: DataFrame, tables, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


@step("order_columns", "format")
def order_columns(df: DataFrame, tables, first: list[str]) -> DataFrame:
    ahead = [c for c in first if c in df.columns]
    return df.select(*ahead, *(c for c in df.columns if c not in ahead))


@step("sort_rows", "format")
def sort_rows(df: DataFrame, tables, by: list[str]) -> DataFrame:
    return df.orderBy(*by)
