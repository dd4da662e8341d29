"""All queries over the given tables, by name, with the SQL that repeats each."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query; without sql it gets a check of its own in the tests."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


for _module in ("scalars", "money", "filings", "entities", "matching", "votes", "views", "pages", "sets", "checks", "validators", "changes", "bulk", "files"):
    importlib.import_module(f"civicspark.plans.{_module}")
