"""Administrative units: names, codes that are unique among siblings, hierarchies, populations, matching by name.

Ids are codes joined by `-`, from the country down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_ACCENTED = "ÀÁÂÃÄÅĀĂĄÇĆČĎĐÈÉÊËĒĖĘĚĞÌÍÎÏĪĮİŁÑŃŇÒÓÔÕÖŌŐØŘŚŠŞȘŤȚÙÚÛÜŪŮŰÝŹŻŽàáâãäåāăąçćčďđèéêëēėęěğìíîïīįıłñńňòóôõöōőøřśšşșťțùúûüūůűýÿźżž"
_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}


def folded(c: Column) -> Column:
    """Latin letters without their marks; what has no such form is left out."""
    plain = c
    for mark, letters in _PAIRS.items():
        plain = F.replace(plain, F.lit(mark), F.lit(letters))
    pairs = {a: b for a, b in zip(_ACCENTED, _PLAIN_FOR, strict=True)}
    return F.regexp_replace(F.translate(plain, "".join(pairs), "".join(pairs.values())), r"[^\x00-\x7F]", "")


def _plain_letters() -> str:
    import unicodedata

    other = {"Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "ı": "i"}
    return "".join(other.get(x) or unicodedata.normalize("NFKD", x)[0] for x in _ACCENTED)


_PLAIN_FOR = _plain_letters()


def clean_name(c: Column, generic: list[str], prefixes: list[str], absent: list[str]) -> Column:
    """A unit's own name: folded, without generic words ('County', 'District of'), white space single; absent ones are null."""
    name = F.trim(F.regexp_replace(folded(c), r"\s+", " "))
    for p in prefixes:
        name = F.when(F.startswith(F.lower(name), F.lit(p.lower() + " ")), F.substring(name, len(p) + 2, 1000)).otherwise(name)
    words = F.filter(F.split(name, " "), lambda w: ~F.lower(w).isin(*[g.lower() for g in generic])) if generic else F.split(name, " ")
    bare = F.array_join(words, " ")
    own = F.when(bare == "", name).otherwise(bare)
    return F.when(~F.lower(F.trim(c)).isin("", *[a.lower() for a in absent]), own)


def level_of(admin_id: Column) -> Column:
    return F.size(F.split(admin_id, "-"))


def orphans(units: DataFrame, admin_id: str = "admin_id") -> DataFrame:
    """Units below the first level whose parent isn't registered."""
    parent = F.regexp_replace(admin_id, "-[^-]*$", "")
    lower = units.where(level_of(F.col(admin_id)) > 1).withColumn("__parent", parent)
    return lower.join(units.select(F.col(admin_id).alias("__parent")), "__parent", "left_anti").drop("__parent")


def at_level(units: DataFrame, level: int, admin_id: str = "admin_id") -> DataFrame:
    """Units of one level, with the ids of all above as admin1_id, admin2_id, ..."""
    parts = F.split(admin_id, "-")
    above = [F.array_join(F.slice(parts, 1, k), "-").alias(f"admin{k}_id") for k in range(1, level + 1)]
    return units.where(level_of(F.col(admin_id)) == level).select("*", *above)


def registry(levels: list[DataFrame]) -> DataFrame:
    """All levels in one table, with `level`; columns by name."""
    out = None
    for k, df in enumerate(levels, 1):
        one = df.withColumn("level", F.lit(k))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def candidate_codes(name: Column, most: int = 8) -> Column:
    """Two-letter codes for a name, best first: initials of two words, first letter with each letter after it in turn."""
    upper = F.regexp_replace(F.upper(folded(name)), r"[^A-Z ]", "")
    words = F.filter(F.split(upper, " "), lambda w: w != "")
    letters = F.replace(upper, F.lit(" "), F.lit(""))
    first = F.left(letters, F.lit(1))
    initials = F.when(F.size(words) > 1, F.array(F.concat(first, F.left(F.get(words, F.lit(1)), F.lit(1))))).otherwise(F.array().cast("array<string>"))
    rest = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(letters))), lambda i: F.concat(first, F.substring(letters, i, F.lit(1))))
    return F.slice(F.filter(F.array_distinct(F.concat(initials, rest)), lambda c: F.length(c) == 2), 1, most)


def assign_codes(units: DataFrame, parent: str, name: str, weight: str, path: str, rounds: int = 8) -> DataFrame:
    """units with `code`, unique among siblings: in each round, units without one ask for their next candidate that is free.

    Of those that ask for the same code, the heaviest gets it, ties by name.  What is left after all rounds gets digits
    by weight.  Rounds are joins on (parent, code), stored below `path`: no sibling group is taken into one task.
    """
    spark = units.sparkSession

    def kept(df: DataFrame, what: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{what}")
        return spark.read.parquet(f"{path}/{what}")

    open_units = kept(units.select(parent, name, weight, candidate_codes(F.col(name), rounds).alias("wishes")).dropDuplicates([parent, name]), "wishes")
    taken = None
    for k in range(rounds):
        asking = open_units.withColumn("code", F.get("wishes", F.lit(k))).where("code is not null")
        if taken is not None:
            asking = asking.join(taken.select(parent, name), [parent, name], "left_anti").join(taken.select(parent, "code"), [parent, "code"], "left_anti")
        best = asking.groupBy(parent, "code").agg(F.min_by(name, F.struct((-F.coalesce(F.col(weight).cast("double"), F.lit(0.0))).alias("w"), F.col(name).alias("n"))).alias(name))
        new = best.select(parent, name, "code")
        taken = kept(new if taken is None else taken.unionByName(new), f"taken{k}")
    rest = open_units.join(taken.select(parent, name), [parent, name], "left_anti")
    number = F.row_number().over(Window.partitionBy(parent).orderBy(F.col(weight).desc_nulls_last(), name))
    late = rest.select(parent, name, F.lpad(number.cast("string"), 2, "0").alias("code"))
    return units.join(taken.unionByName(late), [parent, name], "left")


def fill_population(units: DataFrame, parent: str, population: str, parents: DataFrame, total: str) -> DataFrame:
    """Missing populations: what the parent's total leaves beyond its children that are stated, in equal parts; never below 0."""
    w = Window.partitionBy(parent)
    known, gaps = F.coalesce(F.sum(population).over(w), F.lit(0.0)), F.sum(F.col(population).isNull().cast("int")).over(w)
    share = F.greatest(F.lit(0.0), F.col(total) - known) / gaps
    joined = units.join(parents.select(parent, total), parent, "left")
    return joined.withColumn("filled", F.col(population).isNull() & F.col(total).isNotNull()).withColumn(population, F.coalesce(F.col(population), share)).drop(total)


def repair_weights(units: DataFrame, level: str, weight: str, filled: str) -> DataFrame:
    """Weights of 0 that were filled in get the median of their level's positive weights; measured ones stay."""
    medians = units.where(F.col(weight) > 0).groupBy(level).agg(F.median(weight).alias("__m"))
    return units.join(medians, level, "left").withColumn(weight, F.when(F.col(filled) & (F.col(weight) == 0), F.coalesce("__m", weight)).otherwise(F.col(weight))).drop("__m")


def audit(units: DataFrame, admin_id: str = "admin_id") -> DataFrame:
    """(admin_id, problem): repeated ids, units without parent, codes with other signs than letters and digits."""
    again = units.groupBy(admin_id).count().where("count > 1").select(F.col(admin_id).alias("admin_id"), F.lit("repeated").alias("problem"))
    alone = orphans(units, admin_id).select(F.col(admin_id).alias("admin_id"), F.lit("no_parent").alias("problem"))
    odd = units.where(~F.col(admin_id).rlike("^[A-Z0-9]+(-[A-Z0-9]+)*$")).select(F.col(admin_id).alias("admin_id"), F.lit("bad_code").alias("problem"))
    return again.unionByName(alone).unionByName(odd).distinct()


def segment(code: Column, first: int, length: int) -> Column:
    """Part of a code by place; null where the code is too short."""
    return F.when(F.length(code) >= first + length - 1, F.substring(code, first, length))


def rekey(df: DataFrame, column: str, codes: DataFrame, old: str, new: str) -> DataFrame:
    """Old codes replaced by new ones; others stay."""
    table = codes.select(F.col(old).alias(column), F.col(new).alias("__new"))
    return df.join(table, column, "left").withColumn(column, F.coalesce("__new", column)).select(*df.columns)


def match_by_name(units: DataFrame, harvest: DataFrame, parent: str, name: str, unit_id: str, harvest_id: str) -> DataFrame:
    """(unit, harvested): within the same parent, names that are equal when folded, where that is so for one row on each side."""
    key = F.lower(F.regexp_replace(folded(F.col(name)), r"[^A-Za-z0-9]", ""))

    def only(df: DataFrame, row_id: str) -> DataFrame:
        return df.groupBy(parent, key.alias("__key")).agg(F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("__n")).where("__n = 1 and __key <> ''").drop("__n")

    return only(units, unit_id).join(only(harvest, harvest_id), [parent, "__key"]).select(unit_id, harvest_id)
