"""Every registered query of the reconciliation engine with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: adds a (spark, sf_dir) query, and the SQL that must agree with it."""

    def add(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add
