"""Query registry: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.plans.sqlviews import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, *ctes):
    """Register a query; ``sql`` is the DuckDB body (views are prepended)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *ctes)
        return fn

    return deco


def also(name: str, of: str) -> None:
    """Another name of a registered query."""
    if name in QUERIES:
        raise ValueError(f"duplicate query name {name}")
    QUERIES[name] = QUERIES[of]
    if of in ORACLE:
        ORACLE[name] = ORACLE[of]


def load_all() -> None:
    from tidepool.plans import (  # noqa: F401
        q_aggregate,
        q_audit,
        q_drift,
        q_grid,
        q_io,
        q_learn,
        q_ml,
        q_ordered,
        q_profile,
        q_relate,
        q_scalar,
        q_spatial,
        q_validate,
    )
