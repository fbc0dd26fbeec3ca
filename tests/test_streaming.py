"""Incremental merges of partitions, in batches and as a stream."""

from __future__ import annotations

from cadastra.streaming.partitions import merge, merge_stream

SCHEMA = "id long, place string, year int"


def state(spark, path):
    return sorted((r.id, r.place, r.year) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_merge_touches_only_the_partitions_of_its_rows(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = [(1, "a", 2020), (2, "b", 2020), (3, "a", 2021)]
    merge(spark.createDataFrame(first, SCHEMA), path, ["year"])
    before = {f.name for f in (tmp_path / "t" / "year=2021").iterdir()}
    new = [(2, "b", 2020), (4, "c", 2020), (4, "c", 2020)]
    touched = merge(spark.createDataFrame(new, SCHEMA), path, ["year"])
    assert [tuple(r) for r in touched.collect()] == [(2020, 3)]
    assert state(spark, path) == [(1, "a", 2020), (2, "b", 2020), (3, "a", 2021), (4, "c", 2020)]
    assert {f.name for f in (tmp_path / "t" / "year=2021").iterdir()} == before


def test_merge_of_nothing_and_again(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(1, None, 2020), (1, None, None)], SCHEMA)
    for _ in range(2):
        merge(rows, path, ["year"])
        merge(rows.limit(0), path, ["year"])
    assert spark.read.schema(SCHEMA).parquet(path).count() == 2


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, path, record, checkpoint = (f"file://{tmp_path}/{n}" for n in ("in", "t", "record", "checkpoint"))
    for n, rows in enumerate(([(1, "a", 2020)], [(1, "a", 2020), (2, "b", 2021)])):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        merge_stream(spark.readStream.schema(SCHEMA).parquet(source), path, ["year"], record, checkpoint).awaitTermination(120)
        assert spark.read.parquet(record).where(f"batch = {n}").count() == len(rows)
    assert state(spark, path) == [(1, "a", 2020), (2, "b", 2021)]
    assert sorted((r.batch, r.year, r.n) for r in spark.read.parquet(record).collect()) == [(0, 2020, 1), (1, 2020, 1), (1, 2021, 1)]
