"""All queries of the engine itself, by name, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Modules that register queries.
MODULES = ("scalar_queries", "join_queries", "group_queries", "table_queries", "space_queries", "address_queries", "shape_queries", "estimate_queries", "parcel_queries", "layer_queries", "recipe_queries")


def query(name: str, sql: str | None = None):
    """Register a query; sql states the same result for the provided tables."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _all() -> None:
    for m in MODULES:
        import_module(f"cadastra.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["recipe_order_totals"](spark, sf_dir)
