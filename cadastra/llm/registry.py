"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from cadastra.llm.common import importable

#: Query name: module that has it.
MODULES = {
    "op1_bpe_trie": "bpe",
    "op2_warc_index": "warc",
    "op3_minhash_forest": "forest",
    "op4_language_by_compression": "langid",
    "op5_context_mixing": "lm",
    "op6_toxicity_ngrams": "toxicity",
    "op7_multiset_hash": "multiset",
    "op8_pii_bootstrap": "pii",
    "op9_spaced_seeds": "decontaminate",
    "op10_quality_by_compression": "quality",
}


def _query(module: str, function: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return getattr(import_module(f"cadastra.llm.{module}"), function)(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(module, name.split("_")[0]) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, module in MODULES.items():
        sql = getattr(import_module(f"cadastra.llm.{module}"), "ORACLE_SQL", None)
        if sql:
            out[name] = sql
    return out
