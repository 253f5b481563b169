"""Query registry: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = [
    "tarmac.plans.views",
    "tarmac.plans.columns_q",
    "tarmac.plans.windows_q",
    "tarmac.plans.stats_q",
    "tarmac.plans.learning_q",
    "tarmac.plans.experiments_q",
    "tarmac.plans.sources_q",
    "tarmac.streaming.queries",
]


def register(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` with its DuckDB oracle."""
    def deco(fn):
        if name in QUERIES and getattr(QUERIES[name], "__wrapped__", None) is not fn:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir, *args, **kwargs):
            ship_package(spark)   # Python workers need the package for pandas UDFs
            return fn(spark, sf_dir, *args, **kwargs)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    """Import every module that registers queries."""
    for m in MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise
    return QUERIES, ORACLE
