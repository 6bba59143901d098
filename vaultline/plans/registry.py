"""Registry of named queries over the driver tables and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  The oracle, when the query
is expressible in plain SQL, is a DuckDB statement over the same tables
(views named like the parquet files) producing the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers its queries on import)."""
    from . import q_cohort, q_quality, q_stream, q_vault  # noqa: F401


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
