"""Joins that carry values from one entity to another: by id, by link table, as of a date, in ordered passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.operators.aggregates import reduce_column

#: Share of the spine that a source must reach to overwrite instead of filling gaps.
MAJORITY = 0.5


def present(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & (F.trim(c) != "") if df.schema[column].dataType.simpleString() == "string" else c.isNotNull()


def blank_keys(reference: DataFrame, key: str, placeholders: tuple[str, ...] = (), least: int = 100, share: float = 0.001, spine: DataFrame | None = None) -> DataFrame:
    """The reference without rows of degenerate keys: missing, placeholders, and keys on more than max(least, share of all) rows.

    A key of too many rows that just one row of `spine` has is kept.  Keys are counted first; only the few too frequent
    ones are joined back.
    """
    stated = reference.where(F.col(key).isNotNull())
    counted = stated.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = reference.agg((F.count(F.lit(1)) * share).alias("__most"))
    many = counted.join(F.broadcast(total), F.col("__n") > F.greatest(F.lit(float(least)), F.col("__most"))).select(key)
    if spine is not None:
        once = spine.join(many, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").select(key)
        many = many.join(once, key, "left_anti")
    kept = stated.join(many, key, "left_anti")
    return kept.where(~F.col(key).cast("string").isin(*placeholders)) if placeholders else kept


def link_by_id(spine: DataFrame, reference: DataFrame, key: str, how: dict[str, str], order: Column, mode: str = "attributes", suffix: str = "_new", placeholders: tuple[str, ...] | None = None) -> DataFrame:
    """Spine with the reference's columns, one row of it for each key, reduced as `how` says.

    attributes: columns that the spine has too are overwritten if the reference states at least MAJORITY of the spine's
    rows, else only its gaps are filled.  fill: gaps only.  aggregate: columns get the suffix.  count and flag:
    the number of reference rows, and whether there are any, as `n` and `linked`.  With placeholders, though there be
    none, degenerate keys of the reference are left out (`blank_keys`).
    """
    keyed = reference.where(present(reference, key))
    if placeholders is not None:
        keyed = blank_keys(keyed, key, placeholders, spine=spine)
    if mode in ("count", "flag"):
        counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        joined = spine.join(counts, key, "left")
        return joined.withColumn("n", F.coalesce("n", F.lit(0))) if mode == "count" else joined.withColumn("linked", F.col("n").isNotNull()).drop("n")
    new = keyed.groupBy(key).agg(*(reduce_column(c, h, order).alias(f"{c}{suffix}") for c, h in how.items()))
    joined = spine.join(new, key, "left")
    if mode == "aggregate":
        return joined
    shared = [c for c in how if c in spine.columns]
    added = [c for c in how if c not in spine.columns]
    out = joined
    if mode == "attributes" and shared:
        # from the keys alone: the joined rows aren't made twice
        rows = spine.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).join(new, key, "left")
        reach = rows.agg(*((F.sum(F.when(F.col(f"{c}{suffix}").isNotNull(), F.col("__rows")).otherwise(0)) / F.sum("__rows")).alias(f"__{c}") for c in shared))
        out = joined.join(F.broadcast(reach))
    for c in shared:
        fill = F.coalesce(F.when(present(spine, c), F.col(c)), F.col(f"{c}{suffix}"))
        write = F.when(F.col(f"__{c}") >= MAJORITY, F.coalesce(F.col(f"{c}{suffix}"), F.col(c))).otherwise(fill) if mode == "attributes" else fill
        out = out.withColumn(c, write)
    return out.select(*spine.columns, *(F.col(f"{c}{suffix}").alias(c) for c in added))


def from_entities(spine: DataFrame, reduced: DataFrame, key: str, columns: list[str], mode: str) -> DataFrame:
    """Write reduced columns onto the spine: fill (gaps), replace, prefer (new where stated), recover (positive onto missing or not positive)."""
    joined = spine.join(reduced.select(key, *(F.col(c).alias(f"__{c}") for c in columns)), key, "left")
    for c in columns:
        old = F.col(c) if c in spine.columns else F.lit(None)
        new = F.col(f"__{c}")
        value = {
            "fill": F.coalesce(old, new),
            "replace": new,
            "prefer": F.coalesce(new, old),
            "recover": F.when((old.isNull() | (old <= 0)) & (new > 0), new).otherwise(old),
        }[mode]
        joined = joined.withColumn(c, value)
    return joined.drop(*(f"__{c}" for c in columns))


def link_table(finer: DataFrame, coarser: DataFrame, key: str, finer_id: str, coarser_id: str, method: str) -> DataFrame:
    """All pairs that share a stated key, with how they were linked."""
    a, b = (d.where(present(d, key)).select(key, i) for d, i in ((finer, finer_id), (coarser, coarser_id)))
    return a.join(b, key).select(finer_id, coarser_id, F.lit(method).alias("link_method")).distinct()


def apportion_shares(links: DataFrame, finer_id: str, area: str) -> DataFrame:
    """share: 1 for a finer entity on one coarser only, else in proportion to area; equal parts where no area is stated."""
    w = Window.partitionBy(finer_id)
    n, total = F.count(F.lit(1)).over(w), F.sum(area).over(w)
    by_area = F.when(total > 0, F.coalesce(F.col(area), F.lit(0.0)) / total).otherwise(1.0 / n)
    return links.withColumn("share", F.when(n == 1, 1.0).otherwise(by_area))


def apportion_values(links: DataFrame, values: DataFrame, finer_id: str, coarser_id: str, column: str, share: str = "share") -> DataFrame:
    """Values of the finer entities summed on the coarser in proportion to share; each pair is rounded to cents first."""
    part = F.bround(F.col(column) * F.col(share), 2)
    return links.join(values.select(finer_id, column), finer_id).groupBy(coarser_id).agg(F.sum(part).alias(column))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, valid: str, columns: list[str], direction: str = "backward", label: str = "match_type") -> DataFrame:
    """Each left row with the right row of its key nearest in time: at or before (backward), at or after (forward), or exact.

    Both sides are laid in one order by key and time, and the last right row seen is carried along: one shuffle, no
    pairs, and each row looked at once in either direction.  Among right rows of equal time, backward takes the last
    by their columns, forward and exact the first.  Rows without key or date don't take part in the shuffle.
    label: `exact`, `backward_fallback` or `forward_fallback`, `no_key`, `no_date`, or null without a match.
    """
    keyed = reduce(lambda p, q: p & q, (F.col(k).isNotNull() for k in keys))
    able = keyed & F.col(at).isNotNull()
    right_row = F.struct(F.col(valid).alias("__valid"), *columns)
    kind = right.select(right_row.alias("r")).schema["r"].dataType
    dated = right.where(keyed & F.col(valid).isNotNull())
    if direction == "exact":
        once = dated.groupBy(*keys, F.col(valid).alias("__at")).agg(F.min(right_row).alias("__found"))
        own = left.where(able).withColumn("__at", F.col(at).cast(right.schema[valid].dataType)).join(once, [*keys, "__at"], "left")
    else:
        a = left.where(able).withColumn("__at", F.col(at)).withColumn("__left", F.lit(True)).withColumn("__right", F.lit(None).cast(kind))
        b = dated.select(*keys, F.col(valid).alias("__at"), F.lit(False).alias("__left"), right_row.alias("__right"))
        # right rows stand before the left rows of their time, and the one to be taken among them last
        order = [F.col("__at").asc(), F.col("__left").asc(), F.col("__right").asc()] if direction == "backward" else [F.col("__at").desc(), F.col("__left").asc(), F.col("__right").desc()]
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = a.unionByName(b, allowMissingColumns=True).withColumn("__found", F.last("__right", True).over(w)).where("__left")
    said = F.when(F.col("__found").isNull(), F.lit(None)).when(F.col("__found.__valid") == F.col(at), "exact").otherwise(f"{direction}_fallback")
    met = own.select(*left.columns, *(F.col(f"__found.{c}").alias(c) for c in columns), F.col("__found.__valid").alias(valid), said.alias(label))
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in (*columns, valid)]
    rest = left.where(~able).select(*left.columns, *nothing, F.when(~keyed, "no_key").otherwise("no_date").alias(label))
    return met.unionByName(rest)


def as_of_by_turns(left: DataFrame, right: DataFrame, keys: list[list[str]], at: str, valid: str, columns: list[str], direction: str = "backward", label: str = "match_type") -> DataFrame:
    """as_of by the first of several keys that finds a row; each key is only asked for rows that none before has matched.

    A row that none matches has the label of the last key.  The plan holds one pass for each key.
    """
    done: DataFrame | None = None
    rest = left
    for k, key in enumerate(keys):
        found = as_of(rest, right, key, at, valid, columns, direction, label)
        hit = F.col(valid).isNotNull()
        part = found.where(hit) if k < len(keys) - 1 else found
        done = part if done is None else done.unionByName(part)
        rest = found.where(~hit).select(*left.columns)
    return done


def cascade(rows: DataFrame, row_id: str, passes: list[tuple[str, DataFrame, str, str]], out: str) -> DataFrame:
    """Ordered exact passes (label, reference, key, reference id): each only for rows that no pass before has reached.

    A pass counts only where exactly one reference row has the key.  All passes are left joins on unique keys; the
    first that hits decides, so no row is joined twice to the same reference.
    """
    joined, hits = rows, []
    for k, (label, reference, key, ref_id) in enumerate(passes):
        only = reference.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ref_id).alias(f"__r{k}"), F.count(F.lit(1)).alias("__n")).where("__n = 1").drop("__n")
        joined = joined.join(only, key, "left")
        hits.append((label, F.col(f"__r{k}")))
    target = F.coalesce(*(h for _, h in hits))
    method = F.coalesce(*(F.when(h.isNotNull(), F.lit(label)) for label, h in hits))
    return joined.select(*rows.columns, target.alias(out), method.alias("link_method"))


def chained_components(edges: DataFrame, a: str, b: str, path: str) -> DataFrame:
    """(node, component): the least node of each connected component; rounds are written below `path`.

    In each round every node goes into its neighbour of least rank, a hash, if that is below its own, and edges are
    renamed so and made distinct; so they get fewer by a constant factor, and a hub's edges shrink with it.
    """
    spark = edges.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    def rank(c: str) -> Column:
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))

    def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
        return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).distinct()

    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    left = kept(pairs(ends, a, b), "edges0")
    root = kept(ends.select(F.col(a).alias("node")).union(ends.select(F.col(b))).distinct().select("node", F.col("node").alias("root")), "root0")
    k = 0
    while not left.isEmpty():
        k += 1
        least = left.select("u", "v").union(left.select("v", "u")).groupBy("u").agg(F.min(rank("v")).alias("least"))
        into = kept(least.select(F.col("u").alias("old"), F.least(F.col("least"), rank("u"))["n"].alias("new")), f"into{k}")
        named = left.join(into.toDF("u", "u2"), "u").join(into.toDF("v", "v2"), "v")
        left = kept(pairs(named, "u2", "v2"), f"edges{k}")
        root = kept(root.join(into.toDF("root", "new"), "root", "left").select("node", F.coalesce("new", "root").alias("root")), f"root{k}")
    names = root.groupBy("root").agg(F.min("node").alias("component"))
    return root.join(names, "root").select("node", "component")
