"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver
tables.  ``oracle`` is the equivalent SQL DuckDB runs on the same Parquet
files; it is ``None`` for operators whose result is not a pure function of
the input (sampling, physical partition ids), which the driver then checks
by row count only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    survey_id: str
    fn: QueryFn
    oracle: str | None
    bench: bool = False


QUERIES: dict[str, Query] = {}


def query(name: str, survey_id: str, oracle: str | None = None, bench: bool = False):
    """Decorator: register ``fn`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, survey_id, fn, oracle, bench)
        return fn
    return deco
