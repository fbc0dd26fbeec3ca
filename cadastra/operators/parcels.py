"""Parcels and what is linked to them: local ids, spines from several sources, rolls, ranges of house numbers, divided values.

All of it is joins, windows and sums by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.functions import addresses as ad

# Ids -------------------------------------------------------------------------------------------------


def alnum(c: Column) -> Column:
    """Letters and digits of an id, upper case; null where none is left."""
    return F.nullif(F.regexp_replace(F.upper(c.cast("string")), "[^A-Z0-9]", ""), F.lit(""))


def introduced_duplicates(df: DataFrame, derived: str, source: str, out: str) -> DataFrame:
    """Flags rows whose derived key stands for several distinct source keys; false without a key."""
    many = df.where(F.col(derived).isNotNull() & F.col(source).isNotNull()).groupBy(derived).agg((F.min(source) != F.max(source)).alias("__many"))
    return df.join(many, derived, "left").withColumn(out, F.coalesce("__many", F.lit(False))).drop("__many")


def without_introduced_duplicates(df: DataFrame, derived: str, source: str) -> DataFrame:
    """Derived keys that merge distinct source keys become null."""
    flagged = introduced_duplicates(df, derived, source, "__twice")
    return flagged.withColumn(derived, F.when(~F.col("__twice"), F.col(derived))).drop("__twice")


def id_patterns(df: DataFrame, column: str, patterns: list[str], least: float = 0.9) -> DataFrame:
    """(pattern, share): share of stated ids that match each of the patterns whole, best first; ties to the shorter; those below `least` left out."""
    wide = df.where(F.col(column).isNotNull()).agg(*(F.avg(F.col(column).rlike(f"^(?:{p})$").cast("double")).alias(f"p{k}") for k, p in enumerate(patterns)))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(f"p{k}").alias("share")) for k, p in enumerate(patterns))))
    return wide.select(each.alias("x")).select("x.*").where(F.col("share") >= least).orderBy(F.col("share").desc(), F.length("pattern"), "pattern")


def local_id(c: Column, pattern: str, form: str) -> Column:
    """An id rewritten by a pattern and a form with $1, $2, ...; null where the pattern doesn't match whole."""
    return F.when(c.rlike(f"^(?:{pattern})$"), F.regexp_replace(c, f"^(?:{pattern})$", form))


def link_key(units: DataFrame, key: str, lot: str, out: str) -> DataFrame:
    """The own key, or the lot's where the unit has none and lies on exactly one lot; units repeat for each lot."""
    lots = units.where(F.col(lot).isNotNull()).groupBy("unit_id").agg(F.min(lot).alias("__lot"), F.count_distinct(lot).alias("__n"))
    return units.join(lots, "unit_id", "left").withColumn(out, F.coalesce(F.col(key), F.when(F.col("__n") == 1, F.col("__lot")))).drop("__lot", "__n")


# Spines ----------------------------------------------------------------------------------------------


def latest_vintage(df: DataFrame, by: list[str], vintage: str) -> DataFrame:
    """Rows of the last vintage of each group."""
    last = df.groupBy(*by).agg(F.max(vintage).alias("__last"))
    return df.join(last, by).where(F.col(vintage) == F.col("__last")).drop("__last")


def union_sources(sources: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Rows of several sources in order of priority, with `source`: of a key only those of the first source that has it; rows without a key all stay."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("source", F.lit(name)).withColumn("__rank", F.lit(k)) for k, (name, df) in enumerate(sources)))
    best = every.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("__rank").alias("__best"))
    return every.join(best, key, "left").where(F.col("__best").isNull() | (F.col("__rank") == F.col("__best"))).drop("__rank", "__best")


def merge_on_id(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """base with gaps filled from other, by key, and other's rows of keys that base lacks; columns of either."""
    both = base.select(F.col(key), F.struct("*").alias("__a")).join(other.dropDuplicates([key]).select(F.col(key), F.struct("*").alias("__b")), key, "full")
    columns = list(dict.fromkeys([*base.columns, *other.columns]))

    def value(c: str) -> Column:
        sides = [F.col(f"__{s}.{c}") for s, df in (("a", base), ("b", other)) if c in df.columns]
        return F.coalesce(*sides).alias(c)

    return both.select(*(F.col(key) if c == key else value(c) for c in columns))


def id_column(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that is stated and distinct on most rows; ties by order.  One pass, with approximate counts."""
    n = df.agg(F.count(F.lit(1)).alias("n"), *(F.approx_count_distinct(c, 0.02).alias(c) for c in candidates)).first()
    best = max(candidates, key=lambda c: (round(n[c] / max(1, n["n"]), 2), -candidates.index(c)), default=None)
    return best if best is not None and n[best] > 0 else None


def repeat_share(df: DataFrame, key: str, year: str) -> DataFrame:
    """(year, share): of the keys of a year, those that the year before has too; null for the first."""
    k = df.select(key, year).distinct()
    before = k.select(key, (F.col(year) + 1).alias(year)).withColumn("__again", F.lit(1))
    years = k.select((F.col(year) + 1).alias(year)).distinct().withColumn("__has", F.lit(True))
    each = k.join(before, [key, year], "left").groupBy(year).agg(F.avg(F.coalesce("__again", F.lit(0))).alias("share"))
    return each.join(years, year, "left").select(year, F.when(F.col("__has"), F.col("share")).alias("share"))


def split_stacked(df: DataFrame, place: str, key: str, order: Column, sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """(lots, units) of rows that share a place: its first row is the lot, and all of its rows are units where there are several.

    A lot of several units has no key of its own and no values that are sums over units.
    """
    w = Window.partitionBy(place)
    ranked = df.withColumn("__n", F.count(F.lit(1)).over(w)).withColumn("__k", F.row_number().over(w.orderBy(order)))
    stack = F.col("__n") > 1
    lots = ranked.where("__k = 1").withColumn("n_units", F.when(stack, F.col("__n")).otherwise(F.lit(0))).withColumns({c: F.when(~stack, F.col(c)) for c in [key, *sums]})
    return lots.drop("__n", "__k"), ranked.where(stack).drop("__n", "__k")


def snapped(links: DataFrame, entity: str, parcel: str, share: str, most: float = 0.1) -> DataFrame:
    """Links of an entity on several parcels cut to its main parcel, where each other one takes at most `most` and is another entity's main parcel."""
    w = Window.partitionBy(entity).orderBy(F.col(share).desc(), parcel)
    ranked = links.withColumn("__main", F.row_number().over(w) == 1)
    mains = ranked.where("__main").select(F.col(parcel), F.col(entity).alias("__owner")).groupBy(parcel).agg(F.min("__owner").alias("__lo"), F.max("__owner").alias("__hi"))
    told = ranked.join(mains, parcel, "left")
    others = (F.col("__lo") != F.col(entity)) | (F.col("__hi") != F.col(entity))
    small = F.col("__main") | (F.coalesce(others, F.lit(False)) & (F.col(share) <= most))
    every = told.withColumn("__all", F.min(small.cast("int")).over(Window.partitionBy(entity)))
    return every.where(F.col("__main") | (F.col("__all") == 0)).select(*links.columns)


# Rolls and sales -------------------------------------------------------------------------------------


def last_sales(roll: DataFrame, key: str, year: str, fields: list[tuple[str, str, str]], label: str = "last_sale") -> DataFrame:
    """Sale rows (key, roll year, sale_year, sale_month, price, kind) from the roll's fields (year, month, price), several of each row."""
    each = F.explode(F.array(*(F.struct(F.col(y).cast("int").alias("sale_year"), F.col(m).cast("int").alias("sale_month"), F.col(p).cast("double").alias("price")) for y, m, p in fields)))
    return roll.select(key, year, each.alias("s")).select(key, year, "s.*", F.lit(label).alias("sale_record_kind")).where(F.col("sale_year").isNotNull())


def restated(sales: DataFrame, key: str, year: str, document: str, out: str) -> DataFrame:
    """Flags sales whose account, period and price an earlier roll year states with another document."""
    w = Window.partitionBy(key, "sale_year", "sale_month", "price").orderBy(year, document)
    first = F.first(document).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_year = F.first(year).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return sales.withColumn(out, F.coalesce((F.col(year) > first_year) & ~F.col(document).eqNullSafe(first), F.lit(False)))


def coverage_of(deeds: DataFrame, unit: str, year: str, month: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(unit, first, last): months, as year * 12 + month, that a feed covers in each unit, cut to the limits."""
    at = F.col(year) * 12 + F.col(month)
    low, high = F.min(at), F.max(at)
    return deeds.groupBy(unit).agg((F.greatest(low, F.lit(first)) if first is not None else low).alias("first"), (F.least(high, F.lit(last)) if last is not None else high).alias("last"))


def outside_coverage(rows: DataFrame, covered: DataFrame, unit: str, year: str, month: str) -> DataFrame:
    """Rows whose month the unit's feed doesn't cover: all where it has none; a row without month counts by its whole year."""
    low = F.col(year) * 12 + F.coalesce(F.col(month), F.lit(1))
    high = F.col(year) * 12 + F.coalesce(F.col(month), F.lit(12))
    within = (low >= F.col("first")) & (high <= F.col("last"))
    return rows.join(covered, unit, "left").where(~F.coalesce(within, F.lit(False))).drop("first", "last")


def fill_from_prior(current: DataFrame, prior: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Gaps filled from the roll before; {column}_source says `prior_roll`."""
    old = prior.dropDuplicates([key]).select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = current.join(old, key, "left")
    new = {}
    for c in columns:
        new[f"{c}_source"] = F.when(F.col(c).isNull() & F.col(f"__{c}").isNotNull(), F.lit("prior_roll")).otherwise(F.col(f"{c}_source") if f"{c}_source" in current.columns else F.lit(None).cast("string"))
        new[c] = F.coalesce(F.col(c), F.col(f"__{c}"))
    return joined.withColumns(new).drop(*(f"__{c}" for c in columns))


def not_on_roll(spine: DataFrame, roll: DataFrame, key: str, columns: list[str], least: float = 0.5) -> DataFrame:
    """Values of parcels that the roll lacks become null, with the source `not_on_roll`, if the roll has at least that share of the keys."""
    known = roll.select(key).distinct().withColumn("__on", F.lit(True))
    keys = spine.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).join(known, key, "left")
    reach = keys.agg((F.sum(F.when(F.col("__on"), F.col("__rows")).otherwise(0)) / F.sum("__rows")).alias("__reach"))
    joined = spine.join(known, key, "left").join(F.broadcast(reach))
    gone = (F.col("__reach") >= least) & F.col("__on").isNull() & F.col(key).isNotNull()
    new = {c: F.when(~gone, F.col(c)) for c in columns} | {f"{c}_source": F.when(gone, F.lit("not_on_roll")).otherwise(F.col(f"{c}_source") if f"{c}_source" in spine.columns else F.lit(None).cast("string")) for c in columns}
    return joined.withColumns(new).drop("__on", "__reach")


def duplicate_points(points: DataFrame, x: str, y: str, rank: Column, row_id: str, out: str) -> DataFrame:
    """Flags all but the best ranked of the points in the same place, ties by id."""
    w = Window.partitionBy(x, y).orderBy(rank, row_id)
    return points.withColumn(out, F.col(x).isNotNull() & F.col(y).isNotNull() & (F.row_number().over(w) > 1))


# Addresses of parcels --------------------------------------------------------------------------------


def address_keys(number: Column, street: Column, town: Column, county: Column) -> tuple[Column, Column]:
    """(town key, county key): place, street and number in comparable form; null where one of them is missing."""
    n, s = F.nullif(ad.clean_number(number), F.lit("")), F.nullif(ad.normal_street(street), F.lit(""))
    whole = n.isNotNull() & s.isNotNull()
    return F.when(whole & town.isNotNull(), F.concat_ws("|", town, s, n)), F.when(whole & county.isNotNull(), F.concat_ws("|", county, s, n))


def match_ranges(spine: DataFrame, reference: DataFrame, row_id: str, ref_id: str, number: str, street: str, place: str) -> DataFrame:
    """(row, reference) for rows with a range of house numbers of which one reference alone has either end, on that street and place."""
    pair = ad.number_range(F.col(number))
    ends = spine.where(pair.isNotNull()).select(row_id, place, ad.normal_street(F.col(street)).alias("__s"), F.explode(F.array(pair["low"], pair["high"])).alias("__n"))
    ref = reference.select(F.col(ref_id).alias("__ref"), F.col(place), ad.normal_street(F.col(street)).alias("__s"), ad.clean_number(F.col(number)).alias("__n")).where("__s <> '' and __n <> ''")
    # the least and the largest reference of an address tell whether there is one alone
    ref = ref.groupBy(place, "__s", "__n").agg(F.min("__ref").alias("__low"), F.max("__ref").alias("__high"))
    met = ends.join(ref, [place, "__s", "__n"]).groupBy(row_id).agg(F.min("__low").alias(ref_id), F.max("__high").alias("__high"))
    return met.where(F.col(ref_id) == F.col("__high")).select(row_id, ref_id)


def first_postal_code(sources: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(code, conflict): first stated postal code in order, and the sources whose first five digits differ from it."""
    codes = [(name, ad.normal_postal_code(F.nullif(F.trim(x), F.lit("")))) for name, x in sources]
    value = F.coalesce(*(x for _, x in codes))
    other = F.filter(F.array(*(F.when(F.left(x, F.lit(5)) != F.left(value, F.lit(5)), F.lit(name)) for name, x in codes)), lambda s: s.isNotNull())
    return value, F.nullif(F.array_join(other, "/"), F.lit(""))


# Values ----------------------------------------------------------------------------------------------


def area_shares(links: DataFrame, account: str, area: str, out: str = "share") -> DataFrame:
    """Share of each lot in its account by area, equal parts where no area is stated; they add up to 1."""
    w = Window.partitionBy(account)
    total = F.sum(area).over(w)
    return links.withColumn(out, F.when(total > 0, F.coalesce(F.col(area), F.lit(0.0)) / total).otherwise(1.0 / F.count(F.lit(1)).over(w)))


def divided(links: DataFrame, accounts: DataFrame, account: str, lot: str, columns: list[str], share: str = "share") -> DataFrame:
    """Values of accounts on their lots, by share; null where no account of the lot states one."""
    parts = links.select(account, lot, share).join(accounts.select(account, *columns), account)
    return parts.groupBy(lot).agg(*(F.sum(F.col(c) * F.col(share)).alias(c) for c in columns))


def not_conserved(divided_values: DataFrame, accounts: DataFrame, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """(column, before, after) of the columns whose totals differ by more than that share."""
    def totals(df: DataFrame, name: str) -> DataFrame:
        wide = df.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns))
        return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias(name)) for c in columns))).alias("x")).select("x.*")

    both = totals(accounts, "before").join(totals(divided_values, "after"), "column")
    return both.where(F.abs(F.col("after") - F.col("before")) > tolerance * F.greatest(F.lit(1.0), F.abs(F.col("before"))))


def identity_failures(df: DataFrame, parts: list[str], total: str, tolerance: float = 1.0) -> DataFrame:
    """Rows whose parts, missing ones counting 0, don't add up to their total; rows without a total or any part pass."""
    stated = reduce(lambda a, b: a | b, (F.col(p).isNotNull() for p in parts))
    added = reduce(lambda a, b: a + b, (F.coalesce(F.col(p), F.lit(0.0)) for p in parts))
    return df.where(stated & (F.abs(added - F.col(total)) > tolerance))


def linked_ids(links: DataFrame, entity: str, other: str, overlap: str, out: str, base: str | None = None) -> DataFrame:
    """(entity, ids): linked ids joined by `|`, the largest overlap first, ties by id; null where it is the base id alone."""
    pairs = F.array_sort(F.collect_set(F.struct((-F.col(overlap)).alias("o"), F.col(other).cast("string").alias("i"))))
    listed = links.groupBy(entity).agg(F.array_join(F.array_distinct(F.transform(pairs, lambda p: p["i"])), "|").alias(out), *([F.min(base).cast("string").alias("__base")] if base else []))
    return listed.withColumn(out, F.when(~F.col(out).eqNullSafe(F.col("__base")), F.col(out))).drop("__base") if base else listed


def keep_ids(df: DataFrame, column: str, other: DataFrame, other_id: str, row_id: str) -> DataFrame:
    """Ids, and members of lists joined by `|`, that the other table lacks are taken out; null where none is left."""
    each = df.where(F.col(column).isNotNull()).select(row_id, F.posexplode(F.split(column, r"\|")).alias("at", "__id"))
    kept = each.join(other.select(F.col(other_id).cast("string").alias("__id")).distinct(), "__id", "left_semi")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "__id"))), lambda p: p["__id"])
    back = kept.groupBy(row_id).agg(F.array_join(listed, "|").alias("__kept"))
    return df.join(back, row_id, "left").withColumn(column, F.col("__kept")).select(*df.columns)


def merge_layers(base: DataFrame, layers: list[DataFrame], key: str) -> DataFrame:
    """base with the columns of further layers by key: what base states wins, then earlier layers."""
    out = base
    for k, layer in enumerate(layers):
        extra = [c for c in layer.columns if c != key]
        joined = out.join(layer.dropDuplicates([key]).select(key, *(F.col(c).alias(f"__{k}_{c}") for c in extra)), key, "left")
        out = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__{k}_{c}")) if c in out.columns else F.col(f"__{k}_{c}") for c in extra}).drop(*(f"__{k}_{c}" for c in extra))
    return out


def longest_prefix(df: DataFrame, code: str, rules: DataFrame, prefix: str, value: str, out: str) -> DataFrame:
    """Value of the longest prefix of a code among the rules; null without one.  A code meets the rules by each of its own prefixes of a length that occurs."""
    lengths = sorted(r[0] for r in rules.select(F.length(prefix)).distinct().collect() if r[0])
    codes = df.where(F.col(code).isNotNull()).select(F.col(code).alias("__code")).distinct()
    if not lengths:
        return df.withColumn(out, F.lit(None).cast(rules.schema[value].dataType))
    each = codes.select("__code", F.explode(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("__code"))).alias("n")).withColumn("__p", F.left("__code", F.col("n")))
    best = each.join(rules.select(F.col(prefix).alias("__p"), F.col(value).alias("__v")), "__p").groupBy("__code").agg(F.max_by("__v", "n").alias(out))
    return df.join(best, F.col(code) == F.col("__code"), "left").drop("__code")


def footprint_summary(footprints: DataFrame, parcel: str, area: str, aspect: str, small: float = 40.0, long: float = 3.0) -> DataFrame:
    """Per parcel: footprints, their area and largest, and the shares of small and of long ones."""
    return footprints.where(F.col(parcel).isNotNull()).groupBy(parcel).agg(
        F.count(F.lit(1)).alias("n_footprints"), F.sum(area).alias("footprint_area"), F.max(area).alias("largest_footprint"),
        F.avg((F.col(area) <= small).cast("double")).alias("small_share"), F.avg((F.col(aspect) >= long).cast("double")).alias("long_share"),
    )


def footprint_roles(pairs: DataFrame, footprint: str, parcel: str, area: str, points: str, least: float = 0.5) -> DataFrame:
    """role of each footprint on its parcel: primary if it holds a dwelling point or has at least `least` of the largest area there; secondary beside such a one; else unknown."""
    w = Window.partitionBy(parcel)
    has, largest = F.max(F.coalesce(F.col(points), F.lit(0))).over(w) > 0, F.max(area).over(w)
    role = F.when(F.coalesce(F.col(points), F.lit(0)) > 0, "primary").when(has, "secondary").when(F.col(area) >= least * largest, "primary").when(F.col(area).isNotNull(), "secondary").otherwise("unknown")
    return pairs.withColumn("role", role)
