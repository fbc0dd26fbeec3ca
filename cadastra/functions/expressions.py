"""Expression text of recipes as column expressions.  The text is parsed, never run."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions import scalar as sc

_ARITHMETIC = {ast.Add: "add", ast.Sub: "subtract", ast.Mult: "multiply", ast.Div: "divide", ast.Pow: "power", ast.Mod: "mod"}
_COMPARE = {ast.Lt: "__lt__", ast.LtE: "__le__", ast.Gt: "__gt__", ast.GtE: "__ge__", ast.Eq: "__eq__", ast.NotEq: "__ne__"}
#: Methods on a column, by name, with their arguments as literals.
_METHODS = {
    "isna": lambda c: c.isNull(), "isnull": lambda c: c.isNull(), "notna": lambda c: c.isNotNull(), "notnull": lambda c: c.isNotNull(),
    "fillna": lambda c, v: F.coalesce(c, F.lit(v)), "isin": lambda c, v: F.coalesce(c.isin(*v), F.lit(False)), "abs": F.abs, "round": lambda c, n=0: F.bround(c, n),
    "between": lambda c, a, b: c.between(a, b), "clip": lambda c, a, b: F.greatest(F.lit(a), F.least(F.lit(b), c)),
    "upper": F.upper, "lower": F.lower, "strip": sc.strip, "len": F.length, "zfill": sc.zfill, "startswith": lambda c, v: c.startswith(v), "endswith": lambda c, v: c.endswith(v),
    "contains": lambda c, v: F.coalesce(c.rlike(v), F.lit(False)), "replace": lambda c, a, b: F.replace(c, F.lit(a), F.lit(b)),
}


def expression(text: str) -> Column:
    """Arithmetic, comparisons, and/or/not (also & | ~), membership, and the methods above; names, `names` and {names} are columns."""
    names: dict[str, str] = {}

    def named(m: re.Match) -> str:
        key = f"column_{len(names)}_"
        names[key] = m[1] or m[2]
        return key

    tree = ast.parse(re.sub(r"\{([^{}]+)\}|`([^`]+)`", named, text.strip()), mode="eval").body
    return _column(tree, names)


def _value(node: ast.AST):
    return ast.literal_eval(node)


def _column(node: ast.AST, names: dict[str, str]) -> Column:
    if isinstance(node, ast.Name):
        return F.col(names.get(node.id, node.id))
    if isinstance(node, ast.Constant):
        return F.lit(node.value)
    if isinstance(node, ast.BinOp):
        a, b = _column(node.left, names), _column(node.right, names)
        if isinstance(node.op, ast.BitAnd):
            return a & b
        if isinstance(node.op, ast.BitOr):
            return a | b
        return sc.BINARY[_ARITHMETIC[type(node.op)]](a, b)
    if isinstance(node, ast.BoolOp):
        parts = [_column(v, names) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if isinstance(node.op, ast.And) else out | p
        return out
    if isinstance(node, ast.UnaryOp):
        a = _column(node.operand, names)
        return -a if isinstance(node.op, ast.USub) else ~a if isinstance(node.op, (ast.Not, ast.Invert)) else a
    if isinstance(node, ast.Compare):
        out, left = None, node.left
        for op, right in zip(node.ops, node.comparators, strict=True):
            if isinstance(op, (ast.In, ast.NotIn)):
                p = F.coalesce(_column(left, names).isin(*_value(right)), F.lit(False))
                p = ~p if isinstance(op, ast.NotIn) else p
            else:
                p = getattr(_column(left, names), _COMPARE[type(op)])(_column(right, names))
            out = p if out is None else out & p
            left = right
        return out
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in _METHODS:
        target = node.func.value
        # text methods are written x.str.method()
        target = target.value if isinstance(target, ast.Attribute) and target.attr in ("str", "dt") else target
        return _METHODS[node.func.attr](_column(target, names), *map(_value, node.args))
    if isinstance(node, ast.Attribute) and isinstance(node.value, ast.Attribute) and node.value.attr == "dt":
        return sc.DATETIME[node.attr](_column(node.value.value, names))
    raise ValueError(f"not supported in an expression: {ast.dump(node)[:80]}")
