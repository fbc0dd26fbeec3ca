"""Indicators: named tests on columns that are never null, and what decides on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.scalar import row_sum, to_numeric


def _false(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def _number(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("double") if df.schema[name].dataType.simpleString() != "string" else to_numeric(F.col(name))


def indicator(df: DataFrame, spec: dict) -> Column:
    """A boolean column from {kind: ..., column: ..., ...}; where a column is absent, False (`none_of` is then True)."""
    kind = spec["kind"]
    if kind in ("any_of", "all_of", "none_of"):
        parts = [indicator(df, s) for s in spec["of"]]
        any_ = reduce(lambda a, b: a | b, parts, F.lit(False))
        if kind == "all_of":
            return reduce(lambda a, b: a & b, parts) if parts else F.lit(False)
        return any_ if kind == "any_of" else ~any_
    needed = [spec[k] for k in ("column", "other") if k in spec] + list(spec.get("total", []))
    if any(c not in df.columns for c in needed):
        return F.lit(False)
    c = F.col(spec["column"])
    if kind == "column_greater_than":
        p = _number(df, spec["column"]) > _number(df, spec["other"])
    elif kind in ("value_share_below", "value_share_at_least"):
        total = row_sum(*(F.col(t) for t in spec["total"]))
        share = F.when(total > 0, _number(df, spec["column"]) / total)
        p = share < spec["ratio"] if kind == "value_share_below" else share >= spec["ratio"]
        if kind == "value_share_below" and not spec.get("include_zero", True):
            p = p & (_number(df, spec["column"]) > 0)
    elif kind == "keyword":
        p = c.rlike(f"(?i){spec['pattern']}") if spec.get("regex") else F.contains(F.lower(c), F.lit(spec["pattern"].lower()))
    elif kind == "equals":
        p = c.eqNullSafe(F.lit(spec["value"]))
    elif kind == "in_set":
        p = c.isin(*spec["values"])
    elif kind in ("not_null", "is_null"):
        p = c.isNotNull() if kind == "not_null" else c.isNull()
    elif kind in ("numeric_at_least", "count_at_least"):
        p = _number(df, spec["column"]) >= spec["value"]
    elif kind == "numeric_at_most":
        p = _number(df, spec["column"]) <= spec["value"]
    elif kind == "numeric_below":
        p = _number(df, spec["column"]) < spec["value"]
    elif kind == "has_token":
        p = F.arrays_overlap(F.split(c, r"\s*\+\s*"), F.array(*(F.lit(v) for v in spec["values"])))
    else:
        raise ValueError(f"unknown indicator: {kind}")
    return _false(p)


def ruleset(c: Column, rules: list[tuple[str, str]], where_null: str | None = None, default: str | None = None) -> Column:
    """Ordered expressions on text, any case; the first that is found decides."""
    out = F.when(c.isNull(), F.lit(where_null))
    for pattern, value in rules:
        out = out.when(c.rlike(f"(?i){pattern}"), F.lit(value))
    return out.otherwise(F.lit(default))


def vote(df: DataFrame, decisions: list[dict]) -> DataFrame:
    """Enumerated vote: adds winner, winner_score, runner_up, runner_up_score and evidence.

    A decision is {label, evidence: [{name, weight, test, require, insufficient_alone}], min_score}.  Its score is the
    weight of what fires.  It is eligible from min_score (1) on, if all that it requires fires and what is
    insufficient alone has company.  The highest score wins, in ties the earlier decision; evidence names what fired, joined by `+`.
    """
    scored = []
    for k, d in enumerate(decisions):
        fires = [(e, indicator(df, e["test"])) for e in d["evidence"]]
        score = reduce(lambda a, b: a + b, (F.when(p, F.lit(float(e.get("weight", 1)))).otherwise(0.0) for e, p in fires))
        n = reduce(lambda a, b: a + b, (p.cast("int") for _, p in fires))
        ok = score >= d.get("min_score", 1)
        for e, p in fires:
            if e.get("require"):
                ok = ok & p
            if e.get("insufficient_alone"):
                ok = ok & (~p | (n > 1))
        token = F.concat_ws("+", *(F.when(p, F.lit(e["name"])) for e, p in fires))
        scored.append(F.when(ok, F.struct((-score).alias("order"), F.lit(k).alias("k"), F.lit(d["label"]).alias("label"), token.alias("token"))))
    ranked = df.withColumn("__votes", F.array_sort(F.array_compact(F.array(*scored))))
    first, second = F.get("__votes", F.lit(0)), F.get("__votes", F.lit(1))
    return ranked.select(*df.columns, first["label"].alias("winner"), (-first["order"]).alias("winner_score"), second["label"].alias("runner_up"), (-second["order"]).alias("runner_up_score"), first["token"].alias("evidence"))


def open_vote(df: DataFrame, ballots: list[tuple[str, Column, float]], tiebreaker: str | None = None) -> DataFrame:
    """Weights are summed for each distinct value of the ballots (label, value, weight); adds winner, score and evidence.

    Ties go to the tiebreaker's value if it is among them, else to the earliest ballot's.
    """
    cast = F.array(*(F.struct(F.lit(label).alias("label"), v.cast("string").alias("value"), F.lit(float(w)).alias("weight"), F.lit(k).alias("k"), F.lit(int(label != tiebreaker)).alias("late")) for k, (label, v, w) in enumerate(ballots)))
    stated = df.withColumn("__b", F.filter(cast, lambda b: b["value"].isNotNull()))

    def tally(value: Column) -> Column:
        own = F.filter("__b", lambda b: b["value"] == value)
        weight = F.aggregate(own, F.lit(0.0), lambda a, b: a + b["weight"])
        return F.struct((-weight).alias("order"), F.array_min(F.transform(own, lambda b: b["late"])).alias("late"), F.array_min(F.transform(own, lambda b: b["k"])).alias("k"), value.alias("value"), F.array_join(F.transform(own, lambda b: b["label"]), "/").alias("token"))

    values = F.array_distinct(F.transform("__b", lambda b: b["value"]))
    counted = stated.withColumn("__t", F.get(F.array_sort(F.transform(values, tally)), F.lit(0)))
    return counted.select(*df.columns, F.col("__t.value").alias("winner"), (-F.col("__t.order")).alias("score"), F.col("__t.token").alias("evidence"))
