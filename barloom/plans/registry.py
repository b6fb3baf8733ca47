"""Where queries register with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.plans import market
from barloom.plans.present import shown, shown_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, spec: str, sql: str | None, cte: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame; sql is a SELECT over the driver's and the market tables."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: shown(fn(spark, sf_dir), spec)
        if sql is not None:
            SQL[name] = shown_sql(sql, spec, market.CTE if cte is None else cte)
        return fn

    return register
