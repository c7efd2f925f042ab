"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quorumdf.views import Civic, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(civic) -> DataFrame`` under a name, with the oracle's SQL over the civic views."""

    def register(f: Callable[[Civic], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Civic(spark, sf_dir))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return register
