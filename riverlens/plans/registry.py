"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
whole driver tables; the optional oracle is an SQL string over the same
tables.  Modules under ``riverlens.plans`` register themselves on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, tuple[str, ...]] = {}


def register(name: str, ids: tuple[str, ...] = (), oracle: str | None = None):
    """Decorator: register a query under ``name`` with the inventory ids it covers."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        SURVEY_IDS[name] = tuple(ids)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco
