"""Joins (survey 2.3, C01 to C13).

No join is given a broadcast hint: Spark broadcasts a side by its size in
bytes (``spark.sql.autoBroadcastJoinThreshold``, again at run time under
AQE) and shuffles both sides otherwise, so a plan never depends on a count
taken while the query is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_seconds

def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Inner, left, right and full outer equi-joins."""
    return left.join(right, on, how)


def null_as_text(df: DataFrame, cols: Sequence[str], text: str = "null") -> DataFrame:
    """Print a missing partner as the text "null", as the sample does."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(text)))
    return df


def cross_with_small(left: DataFrame, small: DataFrame) -> DataFrame:
    """Every pair of rows, meant for a ``small`` of fixed size (a
    dimension): the product costs one pass over ``left`` for each of its
    rows.  A small enough side is broadcast by Spark's own estimate."""
    return left.crossJoin(small)


def cogroup_lists(inputs: Sequence[tuple[DataFrame, str, Column]], key: str = "key") -> DataFrame:
    """Per key, one sorted list of values per input (empty when absent).

    ``inputs`` holds (frame, key column, value expression).  One shuffle on
    the key for all inputs together.  The lists hold every value of a key,
    so use it where a key's fan-out is bounded; ``cogroup_long`` keeps the
    same grouping without building lists.
    """
    tagged = None
    for i, (df, k, v) in enumerate(inputs):
        part = df.select(F.col(k).alias(key), F.lit(i).alias("_side"), v.alias("_v"))
        tagged = part if tagged is None else tagged.unionByName(part)
    aggs = [F.array_sort(F.collect_list(F.when(F.col("_side") == i, F.col("_v")))).alias(f"values_{i}")
            for i in range(len(inputs))]
    return tagged.groupBy(key).agg(*aggs)


def cogroup_long(inputs: Sequence[tuple[DataFrame, str, Column]], key: str = "key") -> DataFrame:
    """C06 without lists: rows (key, side, value) clustered by key and sorted,
    so each key's group is a contiguous run inside one partition."""
    tagged = None
    for i, (df, k, v) in enumerate(inputs):
        part = df.select(F.col(k).alias(key), F.lit(i).alias("side"), v.alias("value"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.repartition(key).sortWithinPartitions(key, "side", "value")


def subtract_by_key(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows whose key is absent on the right; duplicates kept."""
    return left.join(right, on, "left_anti")


def block_list_filter(df: DataFrame, col: str, blocked: DataFrame, blocked_col: str) -> DataFrame:
    """Drop rows whose ``col`` is on a block list (anti join)."""
    bl = blocked.select(F.col(blocked_col).alias("_blk")).distinct()
    return df.join(bl, F.col(col) == F.col("_blk"), "left_anti")


def lookup_enrich(df: DataFrame, dim: DataFrame, on, default: Mapping | None = None) -> DataFrame:
    """Left join to a dimension map; a missing key gives null, or
    ``default[col]`` when given."""
    out = df.join(dim, on, "left")
    for c, v in (default or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def window_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                size_s: int) -> DataFrame:
    """C11: inner join of rows with the same key inside the same tumbling
    window of ``size_s`` seconds.  Equi-join on (key, window start)."""
    def win(df, ts):
        s = epoch_seconds(ts)
        return df.withColumn("window_start", s - F.pmod(s, F.lit(size_s)))
    return win(left, left_ts).join(win(right, right_ts), [key, "window_start"])


def window_join_counts(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                       size_s: int) -> DataFrame:
    """C11 as pair counts per (key, window): each side is counted first and
    the counts multiplied, so no pair is materialised."""
    def win(df, ts, name):
        s = epoch_seconds(ts)
        return (df.withColumn("window_start", s - F.pmod(s, F.lit(size_s)))
                  .groupBy(key, "window_start").agg(F.count(F.lit(1)).alias(name)))
    j = win(left, left_ts, "n_left").join(win(right, right_ts, "n_right"), [key, "window_start"])
    return j.withColumn("n_pairs", F.col("n_left") * F.col("n_right"))


def asof_context_join(client: DataFrame, server: DataFrame, keys: Sequence[str], ts: str,
                      max_age_s: int, carry: Sequence[str]) -> DataFrame:
    """Each client row gets the latest server row of the same key at or
    before its time and at most ``max_age_s`` older; misses keep nulls.

    Built as a union ordered by time with ``last(..., ignorenulls)`` over
    the preceding rows, so no pair of rows is ever formed; the window runs
    per (key, time bucket of ``max_age_s``) with server rows copied into
    the next bucket too, so a hot key is spread over its buckets.  Server
    rows sort before client rows at the same instant.  Of several server
    rows at one instant the one with the largest carried columns counts.  A
    null key or time meets nothing: such server rows are left out, and such
    client rows keep nulls.
    """
    keys = list(keys)
    bucket_s = max(int(max_age_s), 1)
    # Time buckets of max_age seconds: a client row only needs server rows
    # of its own bucket and the one before, so each server row is copied
    # into its bucket and the next, and the window runs per (key, bucket).
    # A hot key is thereby split across buckets.
    sb = F.floor(epoch_seconds(ts) / F.lit(bucket_s))
    whole = F.col(ts).isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    ctx = F.struct(F.col(ts).alias("ctx_ts"), *[F.col(c).alias(f"ctx_{c}") for c in carry])
    srv = server.filter(whole).select(*keys, F.col(ts).alias("_t"), F.lit(0).alias("_side"), ctx.alias("_ctx"),
                        F.explode(F.array(sb, sb + 1)).alias("_bucket"))
    cli_cols = [c for c in client.columns if c not in keys]
    unkeyed = client.filter(~whole).withColumnRenamed(ts, "_t")
    cli = client.filter(whole).select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), *cli_cols, sb.alias("_bucket"))
    u = srv.unionByName(cli, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, "_bucket").orderBy("_t", "_side", "_ctx")
         .rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn("_ctx", F.last("_ctx", ignorenulls=True).over(w))
    fresh = (epoch_seconds("_t") - epoch_seconds("_ctx.ctx_ts")) <= F.lit(max_age_s)
    out = u.filter(F.col("_side") == 1)
    ctx_cols = ["ctx_ts"] + [f"ctx_{c}" for c in carry]
    out = out.select("*", *[F.when(fresh, F.col(f"_ctx.{c}")).alias(c) for c in ctx_cols]).drop("_side", "_ctx", "_bucket")
    return out.unionByName(unkeyed, allowMissingColumns=True).withColumnRenamed("_t", ts)
