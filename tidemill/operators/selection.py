"""Exact order statistics of groups of any size, by counting value ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import materialize


def kth_values(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, tuple[int, int, int]], cells: int = 4096) -> DataFrame:
    """For each group and each named rank the value at that place of the group's sorted values.

    ``ranks`` maps an output column to ``(a, b, c)``: of a group of ``n``
    values the one at place ``(a * n + b) div c`` (from 0).  Null values take
    no part; groups without a value give no row.  Result: keys, n, columns.

    A group is never brought together.  Its range is cut into ``cells`` parts
    and their rows are counted (partial counts on the map side, so a task
    gets counts of cells, not rows); the part that holds the wanted place is
    the next range, until a range holds one value.  A round divides the range
    by ``cells``, so evenly spread values take one or two rounds, and each
    round reads the rows once.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v is not null")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("_name"), F.expr(f"({a} * n + {b}) div {c}").alias("_place"))
                                 for name, (a, b, c) in ranks.items()]))
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = materialize(state.select("*", wanted.alias("_w")).select(*keys, "n", "_lo", "_hi", "_w._name", "_w._place"))
    done = state.where("_lo = _hi")
    open_ = state.where("_lo < _hi")
    while not open_.isEmpty():
        # halves keep the width finite for any doubles; the cell never falls as the value grows
        cell = F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * cells), F.lit(cells - 1))
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
        on = inside
        for c in same:
            on = on & c
        met = rows.alias("r").join(open_.alias("s"), on).select(*[F.col(f"s.{k}").alias(k) for k in keys], "n", "_name", "_place", "_v", cell.alias("_cell"))
        counts = met.groupBy(*keys, "n", "_name", "_place", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        # at most ``cells`` rows a group and rank
        parts = counts.groupBy(*keys, "n", "_name", "_place").agg(F.array_sort(F.collect_list(F.struct("_cell", "_n", "_lo", "_hi"))).alias("_c"))
        start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("struct<before: long, lo: double, hi: double>").alias("hit"))

        def step(acc, c):
            here = acc["hit"].isNull() & (acc["before"] + c["_n"] > F.col("_place"))
            hit = F.when(here, F.struct(acc["before"].alias("before"), c["_lo"].alias("lo"), c["_hi"].alias("hi"))).otherwise(acc["hit"])
            return F.struct((acc["before"] + c["_n"]).alias("before"), hit.alias("hit"))
        found = parts.withColumn("_h", F.aggregate("_c", start, step)["hit"])
        state = materialize(found.select(*keys, "n", F.col("_h.lo").alias("_lo"), F.col("_h.hi").alias("_hi"), "_name",
                                         (F.col("_place") - F.col("_h.before")).alias("_place")))
        done = done.unionByName(state.where("_lo = _hi"))
        open_ = state.where("_lo < _hi")
    return done.groupBy(*keys, "n").pivot("_name", list(ranks)).agg(F.first("_lo"))


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """keys, n and the median: the middle value, or the mean of the two middle ones."""
    both = kth_values(df, keys, value, {"_low": (1, -1, 2), "_high": (1, 0, 2)})
    return both.select(*keys, "n", ((F.col("_low") + F.col("_high")) / 2).alias(out))
