"""Versioned cell table (survey 2.12, L01 to L07, with A20 and A21).

A wide-column table is held as a cells DataFrame
``(row_key string, family string, qualifier string, ts long, value string)``
where ``ts`` is epoch milliseconds.  Writes append cells; reads pick the
newest version per (row, family, qualifier).  Reads are filters on the
cells plus one aggregation or group-limited window; a table that holds its
key in another type is filtered before it is turned into cells, so that the
scan can push the filter down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["row_key", "family", "qualifier"]


def cells_from_table(df: DataFrame, key: str, family: str, cols: Sequence[str],
                     ts: Column | None = None, strip_prefix: str = "") -> DataFrame:
    """A table (one row per key) to cells of one family; the key
    column becomes the row key and every other column a qualifier."""
    ts = ts if ts is not None else F.lit(0).cast("long")
    base = df.select(F.col(key).cast("string").alias("row_key"), ts.alias("ts"),
                     *[F.col(c).cast("string").alias(c[len(strip_prefix):] if c.startswith(strip_prefix) else c)
                       for c in cols])
    quals = [c[len(strip_prefix):] if c.startswith(strip_prefix) else c for c in cols]
    long = base.unpivot(["row_key", "ts"], quals, "qualifier", "value")
    return long.select("row_key", F.lit(family).alias("family"), "qualifier", "ts", "value")


def export_tsv(cells: DataFrame) -> DataFrame:
    """Every cell as a TSV line: row key, family, qualifier, value, ts."""
    return cells.select(F.concat_ws("\t", "row_key", "family", "qualifier", "value",
                                    F.col("ts").cast("string")).alias("line"))


def put(cells: DataFrame, new_cells: DataFrame) -> DataFrame:
    """Append cells (upsert happens at read time: newest wins)."""
    return cells.unionByName(new_cells.select(*cells.columns))


def _select(cells: DataFrame, row_key=None, family=None, qualifier=None) -> DataFrame:
    if row_key is not None:
        cells = cells.filter(F.col("row_key") == F.lit(row_key))
    if family is not None:
        cells = cells.filter(F.col("family") == F.lit(family))
    if qualifier is not None:
        cells = cells.filter(F.col("qualifier") == F.lit(qualifier))
    return cells


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell (ties: larger value)."""
    newest = F.max(F.struct("ts", "value"))
    return (cells.groupBy(*CELL).agg(newest.alias("_n"))
                 .select(*CELL, F.col("_n.ts").alias("ts"), F.col("_n.value").alias("value")))


def get(cells: DataFrame, row_key=None, family=None, qualifier=None) -> DataFrame:
    """Newest version of a row, a family of it or one column."""
    return latest(_select(cells, row_key, family, qualifier))


def get_versions(cells: DataFrame, n: int, row_key=None, family=None, qualifier=None) -> DataFrame:
    """Up to ``n`` newest versions per cell (``version`` 1 = newest)."""
    w = Window.partitionBy(*CELL).orderBy(F.col("ts").desc(), F.col("value").desc())
    sel = _select(cells, row_key, family, qualifier)
    return sel.withColumn("version", F.row_number().over(w)).filter(F.col("version") <= n)


def scan(cells: DataFrame, qualifiers: Sequence[tuple[str, str]], family=None) -> DataFrame:
    """Newest cells as one wide row per row key.  ``qualifiers`` lists
    the (family, qualifier) columns to produce, so the pivot needs no
    extra pass to find them."""
    cur = latest(_select(cells, family=family))
    names = [f"{f}:{q}" for f, q in qualifiers]
    keyed = cur.withColumn("_col", F.concat_ws(":", "family", "qualifier")).filter(F.col("_col").isin(names))
    wide = keyed.groupBy("row_key").pivot("_col", names).agg(F.first("value"))
    for f, q in qualifiers:
        wide = wide.withColumnRenamed(f"{f}:{q}", q)
    return wide


def range_scan(cells: DataFrame, start: str, stop: str, condition: Column | None = None) -> DataFrame:
    """Start <= row key < stop, with an optional extra filter; newest
    versions."""
    sel = cells.filter((F.col("row_key") >= F.lit(start)) & (F.col("row_key") < F.lit(stop)))
    out = latest(sel)
    return out.filter(condition) if condition is not None else out


def delete(cells: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Remove cells covered by a tombstone.

    ``tombstones`` has ``row_key``, ``family``, ``qualifier`` and ``ts``;
    a null family deletes the whole row, a null qualifier the whole family,
    and a cell is removed when its version is at or before the tombstone's
    ``ts``.  One equi-join on the row key (a left anti join).
    """
    t = tombstones.select(F.col("row_key").alias("_rk"), F.col("family").alias("_f"),
                          F.col("qualifier").alias("_q"), F.col("ts").alias("_ts"))
    cond = ((F.col("row_key") == F.col("_rk"))
            & (F.col("_f").isNull() | (F.col("family") == F.col("_f")))
            & (F.col("_q").isNull() | (F.col("qualifier") == F.col("_q")))
            & (F.col("ts") <= F.col("_ts")))
    return cells.join(t, cond, "left_anti")


def add_family(declared: Sequence[str], family: str) -> list[str]:
    """The declared families with one more (cells are unchanged)."""
    return sorted({*declared, family})


def drop_family(cells: DataFrame, family: str) -> DataFrame:
    """Drop every cell of a family."""
    return cells.filter(F.col("family") != F.lit(family))


def enforce_families(cells: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Keep cells of declared families only."""
    return cells.filter(F.col("family").isin(list(allowed)))
