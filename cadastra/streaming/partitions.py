"""Incremental runs: a stream of new rows is merged into a partitioned table, batch by batch.

A partition that a batch has rows of is rewritten as the union of its old and
new rows, each distinct row once; other partitions aren't read.  A batch that
is run again after a failure changes nothing, as its rows are there already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from cadastra.sources.store import scratch, write_partitions


def merge(rows: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Merge rows into the partitions of the table at path; returns (by, n): the partitions touched and their rows.

    A table that isn't there is begun; its columns are those of the first rows, and later rows must have them.
    No rows change nothing.
    """
    spark = rows.sparkSession
    try:
        old = spark.read.schema(rows.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = rows.limit(0)
    touched = rows.select(*by).distinct()
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
    kept = old.alias("o").join(touched.alias("t"), same, "left_semi").select(*rows.columns)
    # old rows are read and their place is written: the union rests elsewhere in between
    between = scratch(spark)
    kept.unionByName(rows).distinct().write.parquet(between)
    merged = spark.read.schema(rows.schema).parquet(between)
    write_partitions(merged, path, *by)
    return merged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def merge_stream(stream: DataFrame, path: str, by: Sequence[str], record: str, checkpoint: str) -> StreamingQuery:
    """Merge what a stream now has into the table at path, and stop.

    The table at `record` says of every batch which partitions it touched and
    how many rows they had then: (batch, by, n), one partition a batch.
    """

    def run(rows: DataFrame, batch: int) -> None:
        touched = merge(rows, path, by)
        write_partitions(touched.withColumn("batch", F.lit(batch)), record, "batch")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
