"""Registered queries: a callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tripengine.session import begin_sizing, prepare


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under a name."""
    def register(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            begin_sizing(prepare(spark))
            return f(spark, sf_dir)

        QUERIES[name] = Query(run, oracle)
        return f
    return register
