"""Where intermediate tables go, and sinks that replace partitions whole."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; without that setting (tests on one machine) a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or "file://" + tempfile.mkdtemp(prefix="cadastra-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Write by partition; partitions that df has are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_table(df: DataFrame, path: str, bucket: str | None = None) -> None:
    """Write one table, clustered by a column where readers filter on it."""
    (df.repartitionByRange(bucket).sortWithinPartitions(bucket) if bucket else df).write.mode("overwrite").parquet(path)


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, stated, distinct): how full each column is."""
    every = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count(c).alias(f"s_{c}") for c in columns), *(F.approx_count_distinct(c).alias(f"d_{c}") for c in columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col("__n").alias("n"), F.col(f"s_{c}").alias("stated"), F.col(f"d_{c}").alias("distinct")) for c in columns)))
    return every.select(rows.alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Comma-separated text with a header in each file; lists and structs as JSON.  `files` limits their number; by default partitions are written as they are."""
    flat = df.select(*(F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in df.schema))
    (flat.coalesce(files) if files else flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_features(df: DataFrame, path: str, shape: str = "shape") -> None:
    """A GeoJSON feature in each line: rings as one polygon, all other columns as its properties; rows without a shape have a null geometry."""
    points = F.transform(shape, lambda r: F.transform(F.sequence(F.lit(0), (F.size(r) / 2).cast("int") - 1), lambda i: F.array(F.get(r, i * 2), F.get(r, i * 2 + 1))))
    geometry = F.when(F.col(shape).isNotNull(), F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates")))
    row = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*(c for c in df.columns if c != shape)).alias("properties"))
    df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_units(spark: SparkSession, pattern: str, units: list[str], missing: str = "error") -> DataFrame:
    """Tables of several units, `{unit}` in the pattern, one after the other with a column `unit`; missing: error or skip."""
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be error or skip, not {missing}")
    found = [(u, p) for u in units if exists(spark, p := pattern.format(unit=u)) or missing == "error"]
    if not found:
        raise FileNotFoundError(f"no unit has {pattern}")
    parts = [spark.read.parquet(p).withColumn("unit", F.lit(u)) for u, p in found]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
