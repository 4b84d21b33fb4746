"""Queries by name, each with DuckDB SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register
