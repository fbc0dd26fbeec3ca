"""Whole tables: partition roll-up, comparison, filters and reconciliation of columns, deflation, admin ids, redaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

IMPUTED, WITHHELD = "imputed", "withheld"


def union_partitions(parts: list[DataFrame]) -> DataFrame:
    """All rows, columns by name, rows equal in everything once."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).distinct()


def replace_partitions(old: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """Partitions that `new` has replace those of `old`."""
    return old.join(new.select(partition).distinct(), partition, "left_anti").select(*old.columns).unionByName(new, allowMissingColumns=True)


def join_partitions(tables: list[DataFrame], key: str) -> DataFrame:
    """Columns of several tables side by side, by key; keys of any."""
    return reduce(lambda a, b: a.join(b, key, "full"), tables)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one table has and the other has not, or not as often, with the side that has them."""
    columns = a.columns
    return a.exceptAll(b.select(*columns)).withColumn("side", F.lit("left")).union(b.select(*columns).exceptAll(a).withColumn("side", F.lit("right")))


def reconcile(df: DataFrame, sources: list[tuple[str, str]], out: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """First stated value in range over (label, column) in order, and where it came from as {out}_source."""

    def ok(c: str) -> Column:
        p = F.col(c).isNotNull()
        p = p & (F.col(c) >= low) if low is not None else p
        return p & (F.col(c) <= high) if high is not None else p

    value = F.coalesce(*(F.when(ok(c), F.col(c)) for _, c in sources))
    source = F.coalesce(*(F.when(ok(c), F.lit(label)) for label, c in sources))
    return df.withColumn(out, value).withColumn(f"{out}_source", source)


def suppress(df: DataFrame, columns: list[str], where: Column) -> DataFrame:
    """Null where the condition holds; so is the source beside it."""
    hit = F.coalesce(where, F.lit(False))
    both = [c for c in columns] + [f"{c}_source" for c in columns if f"{c}_source" in df.columns]
    return df.withColumns({c: F.when(~hit, F.col(c)) for c in both})


def within(df: DataFrame, columns: list[str], low: float | None, high: float | None) -> DataFrame:
    """Null outside the bounds, which count as inside."""

    def kept(c: str) -> Column:
        p = F.lit(True)
        p = p & (F.col(c) >= low) if low is not None else p
        return p & (F.col(c) <= high) if high is not None else p

    return df.withColumns({c: F.when(kept(c), F.col(c)) for c in columns})


def correct(df: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """Values of a table of corrections (key, column) win; they are few rows for a key: the last by value."""
    fix = corrections.groupBy(key).agg(F.max(column).alias("__fix"))
    return df.join(fix, key, "left").withColumn(column, F.coalesce("__fix", column)).drop("__fix")


def deflators(rates: DataFrame, year: str, rate: str, base: int) -> DataFrame:
    """(year, deflator): chained (1 + rate), 1 in the base year; values of a year times its deflator are in base prices."""
    level = rates.withColumn("__level", F.sum(F.log1p(rate)).over(Window.orderBy(year)))
    ref = level.where(F.col(year) == base).select(F.col("__level").alias("__base"))
    return level.join(F.broadcast(ref)).select(year, F.exp(F.col("__base") - F.col("__level")).alias("deflator"))


def deflate(df: DataFrame, columns: list[str], year: str, table: DataFrame) -> DataFrame:
    """Adds {column}_real; null where the year has no deflator."""
    joined = df.join(table, year, "left")
    return joined.withColumns({f"{c}_real": F.col(c) * F.col("deflator") for c in columns}).drop("deflator")


def ancestor(admin: Column, level: int) -> Column:
    """The unit's ancestor (or itself) at a level, 1 being the country; null above its own depth."""
    parts = F.split(admin, "-")
    return F.when(F.size(parts) >= level, F.array_join(F.slice(parts, 1, level), "-"))


def covers(scope: Column, admin: Column) -> Column:
    """Whether a scope is the unit or an ancestor of it; the empty scope covers all."""
    return F.coalesce((scope == "") | (admin == scope) | F.startswith(admin, F.concat(scope, F.lit("-"))), F.lit(False))


def withhold(df: DataFrame, columns: list[str], restricted: list[str], admin: str, scope: str, derived: dict[str, list[str]] | None = None) -> DataFrame:
    """Cells of restricted sources become null, with source `withheld`.

    A cell goes if its source names a restricted one, or in the scope if no other source is named; what is derived
    from a withheld column goes with it.
    """
    named = {}
    for c in columns:
        tokens = F.split(F.coalesce(F.col(f"{c}_source"), F.lit("")), r"\+")
        mine = F.arrays_overlap(tokens, F.array(*map(F.lit, restricted)))
        vague = F.size(F.filter(tokens, lambda t: (t != "") & (t != IMPUTED))) == 0
        named[c] = F.coalesce(mine | (vague & covers(F.lit(scope), F.col(admin))), F.lit(False))
    out = {}
    for c, hit in named.items():
        out[c] = F.when(~hit, F.col(c))
        out[f"{c}_source"] = F.when(hit & F.col(c).isNotNull(), F.lit(WITHHELD)).otherwise(F.col(f"{c}_source"))
    for c, bases in (derived or {}).items():
        hit = reduce(lambda a, b: a | b, (named[b] for b in bases))
        out[c] = F.when(~hit, F.col(c))
    return df.withColumns(out)


def flag_reported(df: DataFrame, keys: list[str], kind: str, flagged: str, reference: str, out: str) -> DataFrame:
    """Flags rows of one kind whose keys, all stated, a row of the other kind has too; nothing is dropped."""
    known = df.where(F.col(kind) == reference).dropna(subset=keys).select(*keys).distinct().withColumn("__known", F.lit(True))
    joined = df.join(known, keys, "left")
    return joined.withColumn(out, F.coalesce((F.col(kind) == flagged) & F.col("__known"), F.lit(False))).drop("__known")
