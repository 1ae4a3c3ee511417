"""The query registry: a Spark callable and, where SQL can state it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.plans.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
