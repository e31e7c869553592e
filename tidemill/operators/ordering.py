"""Sorts, limits, top-k and lookup (survey 2.6, F01 to F07).

``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every task
keeps its own top n and only those reach the final merge, so the cost of
top-k is one pass with no full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by(df: DataFrame, order: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """global sort (range-partitioned then sorted), optional partition count."""
    if num_partitions:
        df = df.repartitionByRange(num_partitions, *order)
        return df.sortWithinPartitions(*order)
    return df.orderBy(*order)


def sort_within_partitions(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """sort inside each partition only (no shuffle)."""
    return df.sortWithinPartitions(*order)


def first_of_each_run(key: str, n: int):
    """F02 after ``sort_within_partitions``: for ``mapInPandas``, the first
    ``n`` rows of each run of equal keys, also where a run spans batches."""
    def run(batches):
        last, seen = None, 0
        for b in batches:
            if not len(b):
                continue
            nth = b.groupby(key, sort=False, dropna=False).cumcount()
            carried = b[key] == last if last is not None else nth < 0
            nth = nth + carried * seen
            yield b[nth < n]
            last = b[key].iloc[-1]
            seen = int(nth.iloc[-1]) + 1
    return run


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows under an explicit order."""
    return df.orderBy(*order).limit(n)


def take_ordered(df: DataFrame, col: str, n: int) -> DataFrame:
    """the ``n`` smallest."""
    return df.orderBy(F.col(col).asc()).limit(n)


def top(df: DataFrame, col: str, n: int) -> DataFrame:
    """the ``n`` largest."""
    return df.orderBy(F.col(col).desc()).limit(n)


def lookup(df: DataFrame, key: str, value, out: Sequence[str]) -> DataFrame:
    """all values of one key (a pushed-down filter on the scan)."""
    return df.filter(F.col(key) == F.lit(value)).select(*out)
