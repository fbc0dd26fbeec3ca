"""Scalar transformations by type and operation, as column expressions.

Every operation follows the same rules: what can't be read as a number or date
is null; conditions give 0 or 1, never null; nothing raises on a value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SQFT_PER_ACRE = 43560.0
#: Particles that stay lower-case inside a title.
PARTICLES = ("de", "del", "la", "las", "los", "el", "y", "e", "en", "al")


def _text(c: Column) -> Column:
    return c.cast("string")


def strip(c: Column) -> Column:
    return F.regexp_replace(_text(c), r"^\s+|\s+$", "")


def to_numeric(c: Column) -> Column:
    t = strip(c)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def parse_currency(c: Column) -> Column:
    """`$1,234.50` and `(12)` for minus 12."""
    bare = F.regexp_replace(_text(c), r"[$,\s]", "")
    minus = F.regexp_replace(bare, r"^\((.*)\)$", "-$1")
    return to_numeric(minus)


def resolve_century(c: Column, pivot: int = 68) -> Column:
    """Two-digit years up to the pivot belong to this century, others to the last; years from 100 on stay."""
    n = to_numeric(c)
    return F.when(n >= 100, n).when(n <= pivot, n + 2000).when(n.isNotNull(), n + 1900)


def to_date(c: Column, pattern: str | None = None, latest_year: int | None = None) -> Column:
    t = F.try_to_timestamp(_text(c), F.lit(pattern)) if pattern else F.try_to_timestamp(_text(c))
    if latest_year is None:
        return t
    return F.when(F.year(t) > latest_year, t - F.expr("INTERVAL 100 YEAR")).otherwise(t)


UNARY = {
    # null for 0 and below, as Spark has it, where a floating-point logarithm gives minus infinity or no number
    "log": lambda c: F.ln(c),
    "arcsinh": lambda c: F.asinh(c),
    "sqrt": lambda c: F.sqrt(c),
    "exp": lambda c: F.exp(c),
    "abs": lambda c: F.abs(c),
    "power": lambda c, exponent: F.pow(c, F.lit(exponent)),
    "to_numeric": to_numeric,
    "parse_currency": parse_currency,
    "resolve_century": resolve_century,
    "round": lambda c, decimals=0: F.bround(c, decimals),
    "to_datetime": to_date,
    "epoch_ms_to_datetime": lambda c: F.timestamp_millis(c.cast("long")),
    "null_if_equal": lambda c, value: F.nullif(c, F.lit(value)),
    "set_null": lambda c: F.nullif(c, c),
    "acres_to_sqft": lambda c: c * SQFT_PER_ACRE,
}


def divide(a: Column, b: Column) -> Column:
    """x/0 is infinite with the sign of x, 0/0 is not a number; null stays null."""
    a, b = a.cast("double"), b.cast("double")
    special = F.when(a.isNull() | b.isNull(), F.lit(None)).when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.when(b == 0, special).otherwise(F.try_divide(a, b))


BINARY = {
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "multiply": lambda a, b: a * b,
    "divide": divide,
    "power": lambda a, b: F.pow(a, b),
    "mod": lambda a, b: F.when(b != 0, a - F.floor(a / b) * b),
}


def row_sum(*cs: Column) -> Column:
    """Sum of what is there; null where nothing is."""
    some = reduce(lambda a, b: a | b, (c.isNotNull() for c in cs))
    return F.when(some, reduce(lambda a, b: a + b, (F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs)))


def row_count(*cs: Column) -> Column:
    return reduce(lambda a, b: a + b, (c.isNotNull().cast("int") for c in cs))


def row_mean(*cs: Column) -> Column:
    return F.try_divide(row_sum(*cs), row_count(*cs))


def first_stated(*cs: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*(F.when(_text(c) != "", c) for c in cs))


def _any(cs: tuple[Column, ...], test) -> Column:
    return reduce(lambda a, b: a | b, map(test, cs)).cast("int")


ACROSS = {
    "sum": row_sum,
    "mean": row_mean,
    "min": lambda *cs: F.least(*cs),
    "max": lambda *cs: F.greatest(*cs),
    "coalesce": first_stated,
    "any_gt": lambda *cs, threshold, fill_na=0: _any(cs, lambda c: F.coalesce(c, F.lit(fill_na)) > threshold),
    "any_lt": lambda *cs, threshold, fill_na=0: _any(cs, lambda c: F.coalesce(c, F.lit(fill_na)) < threshold),
    "all_gt": lambda *cs, threshold, fill_na=0: reduce(lambda a, b: a & b, (F.coalesce(c, F.lit(fill_na)) > threshold for c in cs)).cast("int"),
}


def compare(operation: str, c: Column, value) -> Column:
    """0 or 1; null compares to 0, but differs from everything."""
    v = value if isinstance(value, Column) else F.lit(value)
    tests = {"less_than": c < v, "less_equal": c <= v, "greater_than": c > v, "greater_equal": c >= v, "equal": c == v, "not_equal": c != v}
    return F.coalesce(tests[operation].cast("int"), F.lit(int(operation == "not_equal")))


DATETIME = {
    "year": lambda c: F.year(c),
    "month": lambda c: F.month(c),
    "day": lambda c: F.dayofmonth(c),
    "dayofyear": lambda c: F.dayofyear(c),
    "quarter": lambda c: F.quarter(c),
    "year_month": lambda c: F.date_format(c, "yyyy-MM"),
    "year_quarter": lambda c: F.concat(F.year(c), F.lit("-"), F.quarter(c)),
    "year_continuous": lambda c: F.year(c) + F.dayofyear(c) / 365.0,
}


def substring(c: Column, start: int | None = None, end: int | None = None) -> Column:
    """As a slice: negative places count from the end, beyond the ends is empty."""
    n = F.length(c)

    def place(k: int | None, default: Column) -> Column:
        if k is None:
            return default
        return F.least(n, F.lit(k)) if k >= 0 else F.greatest(F.lit(0), n + k)

    a, b = place(start, F.lit(0)), place(end, n)
    return F.when(n.isNotNull(), F.substring(c, a + 1, F.greatest(F.lit(0), b - a)))


def title_smart(c: Column) -> Column:
    """Words capitalised, but for particles after the first."""
    words = F.split(F.lower(c), " ", -1)
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*PARTICLES), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))))), " ")


def as_text(c: Column, kind: str) -> Column:
    """Text of a value; whole numbers lose their decimals."""
    if kind not in ("double", "float"):
        return _text(c)
    return F.when(c == F.floor(c), _text(c.cast("long"))).otherwise(_text(c))


def concat(texts: list[Column], sep: str = "") -> Column:
    """Nulls count as empty."""
    return F.concat_ws(sep, *(F.coalesce(_text(t), F.lit("")) for t in texts))


def text_coalesce(texts: list[Column], absent: tuple[str, ...] = ()) -> Column:
    """First value that is not null, blank or one of the given stand-ins."""
    return F.coalesce(*(F.when((strip(t) != "") & ~strip(t).isin(*absent) if absent else strip(t) != "", t) for t in texts))


def split_take(c: Column, sep: str, index: int) -> Column:
    parts = F.split(c, F.lit("\\Q" + sep + "\\E"), -1)
    return F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))


def extract(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def zfill(c: Column, width: int) -> Column:
    """Zeros on the left, after the sign; nothing is cut off."""
    sign, rest = F.regexp_extract(c, r"^[+-]?", 0), F.regexp_replace(c, r"^[+-]", "")
    return F.when(F.length(c) >= width, c).otherwise(F.concat(sign, F.lpad(rest, F.lit(width) - F.length(sign), F.lit("0"))))


STRING = {
    "substring": substring,
    "upper": lambda c: F.upper(c),
    "lower": lambda c: F.lower(c),
    "strip": strip,
    "title_smart": title_smart,
    "lstrip": lambda c, chars: F.ltrim(c, F.lit(chars)),
    "replace": lambda c, old, new: F.replace(c, F.lit(old), F.lit(new)),
    "add_prefix": lambda c, prefix: F.concat(F.lit(prefix), c),
    "add_suffix": lambda c, suffix: F.concat(c, F.lit(suffix)),
    "split_take": split_take,
    "extract_named": extract,
    "zfill": zfill,
}


def remap(c: Column, mapping: dict, default=None) -> Column:
    """Exact values; what isn't listed gets the default."""
    if not mapping:
        return F.lit(default)
    table = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def _last_wins(rules: list[tuple[Column, object]], otherwise: Column) -> Column:
    out = None
    for test, value in reversed(rules):
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return otherwise if out is None else out.otherwise(otherwise)


def remap_pattern(c: Column, patterns: list[tuple[str, object]], default=None) -> Column:
    """Expressions that match from the start; the last that does decides."""
    return _last_wins([(c.rlike(f"^(?:{p})"), v) for p, v in patterns], F.lit(default))


def condition(c: Column, test: str, value) -> Column:
    return {"in": lambda: c.isin(*value), "startswith": lambda: c.startswith(value), "endswith": lambda: c.endswith(value), "contains": lambda: c.contains(value), "regex": lambda: c.rlike(value)}[test]()


def remap_conditional(c: Column, rules: list[tuple[str, object, object]], default: Column | None = None) -> Column:
    """(test, value, result); the last that holds decides."""
    return _last_wins([(condition(c, t, v), r) for t, v, r in rules], F.lit(None) if default is None else default)
