"""What leaves the house: withheld rows and cells, cells by source, digests of columns, versions, manifests, staleness."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WITHHELD = "withheld"


def names_source(source: Column, restricted: list[str]) -> Column:
    """Whether one of the `+`-joined tokens is a restricted source; false without a source."""
    return F.coalesce(F.arrays_overlap(F.split(source, r"\+"), F.array(*map(F.lit, restricted))), F.lit(False))


def units_supplied(df: DataFrame, unit: str, columns: list[str], restricted: list[str]) -> DataFrame:
    """(unit): those in which any of the columns names a restricted source."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | names_source(F.col(f"{c}_source"), restricted)
    return df.where(hit).select(unit).distinct()


def withhold(df: DataFrame, columns: list[str], restricted: list[str], geometry_source: str | None = None, unit: str | None = None, derived_from: dict[str, list[str]] | None = None) -> DataFrame:
    """df as it may be handed on: rows whose outline came from a restricted source go, its cells become null, marked `withheld`.

    With `unit`, imputed cells of a column go too in the units to which a restricted source supplied that column.
    {column}_per_area follows {column}; a column of derived_from follows any of its inputs.  Cells without a source stay.
    """
    out = df
    if geometry_source:
        out = out.where(~names_source(F.col(geometry_source), restricted))
    gone = {c: names_source(F.col(f"{c}_source"), restricted) for c in columns}
    if unit:
        for c in columns:
            supplied = df.where(names_source(F.col(f"{c}_source"), restricted) & F.col(unit).isNotNull()).select(F.col(unit).alias("__u")).distinct().withColumn(f"__in_{c}", F.lit(True))
            out = out.join(supplied, F.col(unit) == F.col("__u"), "left").drop("__u")
            gone[c] = gone[c] | (F.coalesce(F.col(f"__in_{c}"), F.lit(False)) & names_source(F.col(f"{c}_source"), ["imputed"]))
    for c, inputs in (derived_from or {}).items():
        for i in inputs:
            gone[c] = gone.get(c, F.lit(False)) | gone[i]
    new = {}
    for c, hit in gone.items():
        new[c] = F.when(~hit, F.col(c))
        if f"{c}_source" in df.columns:
            new[f"{c}_source"] = F.when(hit, F.lit(WITHHELD)).otherwise(F.col(f"{c}_source"))
        if f"{c}_per_area" in df.columns:
            new[f"{c}_per_area"] = F.when(~hit, F.col(f"{c}_per_area"))
    return out.withColumns(new).select(*df.columns)


def cells_by_source(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, source, cells): stated cells by token of their source; a cell counts once for each token."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), F.col(f"{c}_source")).alias("source")) for c in columns)))
    rows = df.select(each.alias("x")).select("x.column", F.explode(F.array_distinct(F.split("x.source", r"\+"))).alias("source"))
    return rows.where("source <> ''").groupBy("column", "source").agg(F.count(F.lit(1)).alias("cells"))


def _digestible(c: str, kind: T.DataType) -> Column:
    return F.to_json(F.struct(F.col(c))) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else F.col(c).cast("string")


def digests(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(column, rows, digest): of each column, whatever the order of rows.

    The digest adds up a hash of every cell, with the row's key if there is one, so that cells that change places change it.
    One pass, with sums before the shuffle.
    """
    at = [_digestible(k, df.schema[k].dataType) for k in key or []]

    def one(c: str) -> Column:
        cell = F.xxhash64(*at, F.coalesce(_digestible(c, df.schema[c].dataType), F.lit("\0null")))
        low, high = cell.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright(cell, 32)
        return F.concat_ws(":", F.coalesce(F.sum(low), F.lit(0)).cast("string"), F.coalesce(F.sum(high), F.lit(0)).cast("string")).alias(c)

    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *(one(c) for c in df.columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("digest")) for c in df.columns)))
    return wide.select(F.col("__rows").alias("rows"), each.alias("x")).select("x.column", "rows", F.md5("x.digest").alias("digest"))


def changed_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """(column, change): added, removed or changed, from two tables of digests."""
    a, b = old.select("column", F.struct("rows", "digest").alias("a")), new.select("column", F.struct("rows", "digest").alias("b"))
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, "column", "full").select("column", kind.alias("change")).where("change is not null")


def same_columns(old: DataFrame, new: DataFrame) -> bool:
    return changed_columns(old, new).isEmpty()


def next_version(day: date, taken: list[str]) -> str:
    """The day as yyyymmdd; with a, b, ... behind it if that is taken."""
    base, letters = f"{day:%Y%m%d}", "abcdefghijklmnopqrstuvwxyz"
    free = [v for v in [base, *(base + x for x in letters)] if v not in taken]
    if not free:
        raise ValueError(f"no version is left of {base}")
    return free[0]


def manifest(version: str, built: datetime, tables: dict[str, DataFrame], **facts: str) -> dict:
    """Version, time, facts, and for each table its rows, columns and digests."""
    out = {"version": version, "built": built.isoformat(), **facts, "tables": {}}
    for name, df in tables.items():
        found = digests(df).collect()
        out["tables"][name] = {"rows": found[0]["rows"] if found else 0, "columns": df.columns, "digests": {r["column"]: r["digest"] for r in found}}
    return out


def out_of_date(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(output, input): outputs (output, input, built) that are older than an input (input, built) or have one that is missing."""
    i = inputs.select("input", F.col("built").alias("of_input"))
    return outputs.join(i, "input", "left").where(F.col("of_input").isNull() | (F.col("of_input") > F.col("built"))).select("output", "input")


def refuse_stale(outputs: DataFrame, inputs: DataFrame) -> None:
    late = out_of_date(outputs, inputs).orderBy("output", "input").limit(5).collect()
    if late:
        raise ValueError(f"older than what they are made of: {[tuple(r) for r in late]}")


def profile(df: DataFrame) -> DataFrame:
    """(column, type, rows, missing, values): one pass; values are counted approximately, to 1 %."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *(F.struct(F.count(c).alias("stated"), F.approx_count_distinct(c, 0.01).alias("values")).alias(c) for c in df.columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`.stated").alias("stated"), F.col(f"`{c}`.values").alias("values")) for c, t in df.dtypes)))
    return wide.select("__n", each.alias("x")).select("x.column", "x.type", F.col("__n").alias("rows"), (F.col("__n") - F.col("x.stated")).alias("missing"), "x.values")


def value_counts(df: DataFrame, columns: list[str], most: int) -> DataFrame:
    """(column, value, n): of the columns with up to `most` distinct values."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = df.select(each.alias("x")).select("x.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    few = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= most)
    return counts.join(few.select("column"), "column", "left_semi")


def sampled(df: DataFrame, key: str, n: int, salt: int = 0) -> DataFrame:
    """n rows, the same ones each time: those whose key has the least hashes."""
    return df.orderBy(F.xxhash64(F.lit(salt), F.col(key)), key).limit(n)
