"""Columns that infer what a source doesn't state, and the notes of where a value came from.

Sources of a value stand beside it as text of tokens joined by `+`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMPUTED = "imputed"


def _tokens(source: Column) -> Column:
    return F.filter(F.split(F.coalesce(source, F.lit("")), r"\+"), lambda t: t != "")


def mark_imputed(source: Column, token: str = IMPUTED) -> Column:
    """The source with the token at its end, once; the token alone where there is no source."""
    t = _tokens(source)
    return F.array_join(F.when(F.array_contains(t, token), t).otherwise(F.array_append(t, F.lit(token))), "+")


def is_imputed(source: Column) -> Column:
    """Whether `imputed` is one of the tokens; false without a source."""
    return F.array_contains(_tokens(source), IMPUTED)


def record_source(source: Column, where: Column, token: str | Column, imputed: bool = False) -> Column:
    """The source, replaced by the token where the condition holds."""
    new = F.lit(token) if isinstance(token, str) else token
    return F.when(F.coalesce(where, F.lit(False)), mark_imputed(new) if imputed else new).otherwise(source)


def bucketed(c: Column, buckets: dict[str, str], other: str | None = None) -> Column:
    """Coarse class of a class; those without a bucket get `other`, nulls stay."""
    table = F.create_map(*(F.lit(x) for pair in buckets.items() for x in pair))
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(table, c), F.lit(other)))


def number(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def filled_number(c: Column, value: float = 0, kind: str = "bigint") -> Column:
    """Missing and non-numeric values become `value`; the rest is cast, numbers cut towards 0."""
    return F.coalesce(number(c), F.lit(float(value))).cast(kind)


def whole_number(c: Column) -> Column:
    """Nullable integer of whole numbers; other values are null."""
    x = number(c)
    return F.when(x == F.floor(x), x.cast("bigint"))


def per_area(value: Column, area: Column) -> Column:
    """Null where the area is missing or not positive."""
    return F.when(area > 0, value / area)


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def stories_from_height(height: Column, floor_height: float = 3.0) -> Column:
    """At least 1; null without a positive height."""
    return F.when(height > 0, F.greatest(F.lit(1), half_up(height / floor_height).cast("int")))


def decide_stories(evidence: list[tuple[str, Column]], low: float = 1, high: float = 150) -> tuple[Column, Column]:
    """(stories, label): the first evidence in range, rounded half up, and its label."""
    value = F.coalesce(*(F.when(number(c).between(low, high), half_up(number(c)).cast("int")) for _, c in evidence))
    label = F.coalesce(*(F.when(number(c).between(low, high), F.lit(name)) for name, c in evidence))
    return value, label


def dwellings_of_class(n: Column, kind: Column, by_class: dict[str, int]) -> Column:
    """Stated number of dwellings, else that of the class, else null."""
    table = F.create_map(*(F.lit(x) for pair in by_class.items() for x in pair))
    return F.coalesce(n, F.try_element_at(table, kind))


def occupancy(parts: list[Column], dwellings: Column, one: str = "single_family", many: str = "multi_family") -> Column:
    """First stated class; without any, from the number of dwellings."""
    return F.coalesce(*(F.nullif(F.trim(p), F.lit("")) for p in parts), F.when(dwellings == 1, F.lit(one)).when(dwellings > 1, F.lit(many)))


def unconfirmed_height(value: Column, area: Column, stories: Column, height: Column, least_per_area: float, most_per_floor: float, story_height: float = 3.0) -> Column:
    """Whether value per area is at least `least_per_area` and more than all known floors can hold; false where unknown."""
    floors = F.greatest(F.coalesce(stories.cast("double"), F.lit(1.0)), F.coalesce(F.ceil(height / story_height).cast("double"), F.lit(1.0)))
    ratio = per_area(value, area)
    return F.coalesce((ratio >= least_per_area) & (ratio / floors > most_per_floor), F.lit(False))


def zero_reason(value: Column, reasons: list[tuple[str, Column]], other: str = "unknown") -> Column:
    """Why a value is 0: the first reason that holds; null for other values."""
    out = F.lit(other)
    for name, holds in reversed(reasons):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(out)
    return F.when(value == 0, out)


def land_value(land: Column, improvement: Column, total: Column, area: Column, rate: Column, eligible: Column) -> tuple[Column, Column, Column]:
    """(land value, improvement value, method) of a lot whose land value is missing or 0.

    total_less_improvement where the total is larger; else rate_times_area, capped at the total, and taken off the
    improvement value (not below 0).  Others keep what they state, with a null method.
    """
    gap = F.coalesce(eligible & ((land.isNull()) | (land == 0)) & (improvement > 0) & (area > 0), F.lit(False))
    identity = gap & F.coalesce(total > improvement, F.lit(False))
    estimate = F.when(total.isNotNull(), F.least(rate * area, total)).otherwise(rate * area)
    by_rate = gap & ~identity & estimate.isNotNull()
    new_land = F.when(identity, total - improvement).when(by_rate, estimate).otherwise(land)
    new_improvement = F.when(by_rate, F.greatest(F.lit(0.0), improvement - estimate)).otherwise(improvement)
    return new_land, new_improvement, F.when(identity, F.lit("total_less_improvement")).when(by_rate, F.lit("rate_times_area"))


def deflated_growth(value: Column, factor: Column) -> Column:
    return value * factor


def conflict_text(sources: list[tuple[str, Column]]) -> Column:
    """'a/b: x | c: y': which sources state which value, values in order of the first source; null unless two differ."""
    every = F.filter(F.array(*(F.struct(F.lit(n).alias("n"), c.cast("string").alias("v")) for n, c in sources)), lambda s: s["v"].isNotNull())
    values = F.array_distinct(F.transform(every, lambda s: s["v"]))
    texts = F.transform(values, lambda v: F.concat(F.array_join(F.transform(F.filter(every, lambda s: s["v"] == v), lambda s: s["n"]), "/"), F.lit(": "), v))
    return F.when(F.size(values) > 1, F.array_join(texts, " | "))


def sale_date(c: Column) -> Column:
    """Date of a sale from its usual spellings: 2020-05-31, 20200531, 5/31/2020, 202005 and 2020-05 (first of month); else null."""
    t = F.trim(c.cast("string"))
    forms = [(r"^\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d", r"^(\d{4}-\d{1,2}-\d{1,2})"), (r"^\d{8}$", "yyyyMMdd", r"^(\d{8})$"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy", r"^(.*)$"), (r"^\d{6}$", "yyyyMM", r"^(\d{6})$"), (r"^\d{4}-\d{1,2}$", "yyyy-M", r"^(.*)$")]
    return F.coalesce(*(F.when(t.rlike(shape), F.to_date(F.try_to_timestamp(F.regexp_extract(t, part, 1), F.lit(form)))) for shape, form, part in forms))


def sale_period(year: Column, month: Column, date: Column) -> tuple[Column, Column]:
    """Year and month; the date's only where both are missing."""
    gap = year.isNull() & month.isNull()
    return F.when(gap, F.year(date)).otherwise(year), F.when(gap, F.month(date)).otherwise(month)


def tier(count: Column, share: Column, by_id: Column, sure: float = 0.9) -> Column:
    """How far a reference is to be trusted: high (by id, several labels or one, which agree), medium, low, none."""
    return F.when(F.coalesce(count, F.lit(0)) == 0, "none").when(by_id & (share >= sure), "high").when(share >= sure, "medium").otherwise("low")


def validation_result(truth: Column, predicted: Column) -> Column:
    """correct, omission (something true wasn't predicted), commission (something else was), or null without truth."""
    return F.when(truth.isNull(), F.lit(None).cast("string")).when(predicted.isNull(), "omission").when(truth == predicted, "correct").otherwise("commission")


def manufactured_score(keyword: Column, aspect: Column, area: Column, aspect_min: float = 2.5, area_max: float = 250.0) -> Column:
    """Likeness to a manufactured home, 0 to 1: 1 by keyword, else half for each of a long and a small outline."""
    return F.when(F.coalesce(keyword, F.lit(False)), 1.0).otherwise(F.when(aspect >= aspect_min, 0.5).otherwise(0.0) + F.when(area <= area_max, 0.5).otherwise(0.0))
