"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables; the
oracle is the same computation written as plain SQL over views of the same
names. Only the SQL string is stored; nothing here runs DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)


def _load() -> None:
    # Importing the modules registers their queries.
    from tessera.plans import (  # noqa: F401
        dataset_queries, profile_queries, lm_queries, eval_queries, sync_queries, ml_queries, sql_queries,
        vector_queries, change_queries, log_queries, sketch_queries,
    )
