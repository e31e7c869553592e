"""Set operations (survey 2.7, G01 to G04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both."""
    return a.intersect(b)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with no equal row in ``b`` (nulls compare equal);
    duplicates of ``a`` are kept, unlike ``exceptAll``."""
    cond = None
    for c in a.columns:
        e = a[c].eqNullSafe(b[c])
        cond = e if cond is None else cond & e
    return a.join(b, cond, "left_anti")


def union_distinct_sorted(a: DataFrame, b: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Union, distinct, sorted."""
    return a.unionByName(b).distinct().orderBy(*order)
