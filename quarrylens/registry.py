"""All queries of the library and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("operators.banking_queries", "operators.dml_queries", "operators.change_queries", "operators.hierarchy_queries", "operators.model_queries", "operators.function_queries", "plans.code_queries", "plans.analysis_queries", "plans.miner_queries", "plans.surface", "sources.inventory_queries", "streaming.velocity")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in MODULES:
        out |= import_module(f"quarrylens.{name}").queries()
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        out |= import_module(f"quarrylens.{name}").oracle_sql()
    return out
