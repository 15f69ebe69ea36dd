"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` (with its oracle SQL).

    The registered callable first makes sure the package can be imported by the
    Python workers of the session (see ``session.ship_package``).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import ship_package
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco
