"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from vitrine.queries.adapters import Tables
from vitrine.session import DEFAULTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RUNTIME = ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""
    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key in RUNTIME:
                spark.conf.set(key, DEFAULTS[key])
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
