"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import prepare
from sparkloom.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ["io", "columns", "filters", "missing", "joins", "aggregates", "reshape", "windows", "binning", "scalars",
           "timeseries", "loads", "ml", "vectors", "lineage", "models"]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(prepare(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    for module in MODULES:
        import_module(f"sparkloom.catalog.{module}")
