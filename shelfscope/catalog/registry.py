"""Registry of runnable queries (Spark) and their DuckDB twins.

(spark, sf_dir) and returns a DataFrame over the driver tables (or data Spark
derives from them). Array columns are rendered as '|'-joined strings in the
registered projection so both engines print them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

import functools

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_conf, size_work

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            apply_conf(spark)  # sessions made by others: pin what results depend on
            size_work(spark, sf_dir)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from . import q_analyses, q_core, q_history, q_io, q_ops, q_pages, q_quality, q_reports  # noqa: F401
