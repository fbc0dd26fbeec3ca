"""Readers: one call by format, with the options that recipes use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.scalar import strip


def read_table(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame:
    """Read a table of a format, by default by its ending.

    parquet, orc, json (lines), multijson, geojson (features flattened), geojsonl, csv, tsv, xml (row_tag), fixed (widths).
    Text formats read every column as text: types are a matter of transformations.  Options: columns, where,
    delimiter, header, encoding, null_values, record_path, bbox (xmin, ymin, xmax, ymax).
    """
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    kind = {"txt": "csv", "dat": "csv", "tab": "tsv"}.get(kind, kind)
    if kind in ("parquet", "orc"):
        df = spark.read.format(kind).load(path)
    elif kind in ("csv", "tsv"):
        header = options.get("header", True)
        reader = spark.read.option("header", header).option("sep", options.get("delimiter", "\t" if kind == "tsv" else ",")).option("encoding", options.get("encoding", "UTF-8"))
        reader = reader.option("multiLine", options.get("multi_line", False)).option("mode", "DROPMALFORMED" if options.get("on_bad_lines") == "skip" else "PERMISSIVE").option("escape", '"')
        df = reader.csv(path)
        df = df.toDF(*(c.strip() for c in df.columns))
    elif kind in ("json", "geojsonl"):
        df = spark.read.json(path)
    elif kind in ("multijson", "geojson"):
        df = spark.read.option("multiLine", True).json(path)
        df = df.select(F.explode("features").alias("f")).select("f.*") if kind == "geojson" else df
    elif kind == "xml":
        df = spark.read.option("rowTag", options["row_tag"]).xml(path)
    elif kind == "fixed":
        df = fixed_width(spark.read.text(path), options["widths"])
    else:
        raise ValueError(f"no reader for {kind}")
    if options.get("record_path"):
        df = df.select(F.explode(options["record_path"]).alias("r")).select("r.*")
    if kind in ("geojson", "geojsonl") and "properties" in df.columns:
        df = df.select("properties.*", "geometry")
    if options.get("null_values"):
        texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
        df = df.withColumns({c: F.when(~strip(F.col(c)).isin(*options["null_values"]), F.col(c)) for c in texts})
    if options.get("where"):
        df = df.where(options["where"])
    if options.get("bbox"):
        x0, y0, x1, y1 = options["bbox"]
        df = df.where((F.col("bbox.xmin") <= x1) & (F.col("bbox.xmax") >= x0) & (F.col("bbox.ymin") <= y1) & (F.col("bbox.ymax") >= y0))
    return df.select(*options["columns"]) if options.get("columns") else df


def fixed_width(lines: DataFrame, widths: dict[str, tuple[int, int]]) -> DataFrame:
    """Columns from places (start, length) of a text line, counted from 1; blanks around them go, blank is null."""
    return lines.select(*(F.nullif(strip(F.substring("value", s, n)), F.lit("")).alias(c) for c, (s, n) in widths.items()))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs as columns of their own, named by their path."""
    while any(f.dataType.typeName() == "struct" for f in df.schema):
        columns = []
        for f in df.schema:
            if f.dataType.typeName() == "struct":
                columns += [F.col(f.name)[g.name].alias(f"{f.name}{sep}{g.name}") for g in f.dataType]
            else:
                columns.append(F.col(f.name))
        df = df.select(*columns)
    return df


def join_members(members: list[DataFrame], key: str) -> DataFrame:
    """Several files side by side, one row each for a key; raises if a key repeats or is missing somewhere."""
    checks = [m.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.lit(k)) for k, m in enumerate(members)]
    every = reduce(lambda a, b: a.union(b), checks).groupBy(key).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("members"))
    bad = every.where((F.col("most") > 1) | (F.col("members") < len(members))).limit(1).collect()
    if bad:
        raise ValueError(f"members don't match one to one at {key} = {bad[0][0]}")
    return reduce(lambda a, b: a.join(b, key), members)


def read_members(spark: SparkSession, paths: list[str], kind: str | None = None, **options) -> DataFrame:
    """All members of a set of files, columns by name, with the file each row is from."""
    parts = [read_table(spark, p, kind, **options).withColumn("member", F.lit(p.rsplit("/", 1)[-1])) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def repair_mojibake(c):
    """Undo UTF-8 that was read as Latin-1; other text stays."""
    fixed = F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")
    return F.when(c.rlike("[Â-ô][\u0080-¿]") & ~c.rlike("[^\u0000-ÿ]"), fixed).otherwise(c)
