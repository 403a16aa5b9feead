"""Registry of queries: a callable over (spark, sf_dir), and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Fixtures, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, uses: str = ""):
    """Register a function of Fixtures under its own name; ``uses`` names the fixtures that its SQL reads."""

    def add(f: Callable[[Fixtures], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = (with_sql(*uses.split()) if uses else "") + sql
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    from . import queries_functions, queries_graph, queries_kernels, queries_relational, queries_warehouse  # noqa: F401
