"""Every operator on the driver's tables, with the same result in SQL.

The tables hold no stations, so each query maps some table onto the operator's
input. All queries read their tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_MODULES = ("columns", "relations", "documents", "series", "storage", "loads", "edges", "stores", "parts")


def query(sql: str | None):
    """Register a function under its name, with its SQL counterpart if there is one."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all() -> None:
    for module in _MODULES:
        import_module(f"stationflow.queries.{module}")
