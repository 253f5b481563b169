"""Queries of this subpackage: name -> Spark builder, and their DuckDB SQL where there is one."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULES = ["exact_dedup", "embedding_dedup", "line_dedup", "minhash_dedup", "toxicity", "language", "html_text",
           "lm_score", "bpe", "mixing", "warc", "prefix_trie", "phrases"]


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name``."""
    def add(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            ship_package(spark)   # the Python workers import this package
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def load() -> tuple[dict[str, Callable], dict[str, str]]:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return QUERIES, ORACLE
