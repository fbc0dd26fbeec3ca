"""What the operators of this subpackage share: tables, hold-out marks, the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Punctuation of the contracts' "word": everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package, wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in [*paths, root] if p)


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see.

    It lies below spark.checkpoint.dir, as a URI of the session's file system;
    only where a session on one machine has no such setting (tests) a
    temporary folder serves instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cadastra-")
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base:
        folder = spark._jvm.org.apache.hadoop.fs.Path(base)
        base = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and reread it: cuts the lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back(spark: SparkSession) -> None:
    """Let the heap of each executor give the machine back what earlier jobs left free in it.

    A heap grows with what jobs allocate, up to its limit, and by itself hardly shrinks, so that Python workers of
    later jobs stand beside it.  One short task for each core; where the JVM is told to leave such calls alone, nothing happens.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).collect()


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    col = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def ascii_lower(col: Column) -> Column:
    """A-Z only; every other character stays as it is."""
    return F.translate(col, _UPPER, _LOWER)


def words(col: Column) -> Column:
    """Array of words of a lower-cased text; empty for null or blank text."""
    parts = F.split(F.coalesce(ascii_lower(col), F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")
