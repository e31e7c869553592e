"""Ranking and top-N.

``top_n_per_group`` is a ``row_number`` filter; Catalyst turns it into a
``WindowGroupLimit`` that keeps only the first N rows of every group on
the map side before the shuffle, so a hot group never sends more than N
rows per task.  ``global_rank`` is a dense 1-based position over a total
order without a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import materialize


def top_n_per_group(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """First ``n`` rows of each group under ``order``.

    ``order`` must be a total order inside a group (add a unique
    tie-breaker) for the result to be deterministic.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def any_n_per_group(df: DataFrame, group: str, n: int) -> DataFrame:
    """Up to ``n`` rows of each group, whichever (E02 without an order).
    The rank's order is the group itself, so nothing is sorted for it, and
    the group limit keeps ``n`` rows a task before the shuffle."""
    w = Window.partitionBy(group).orderBy(group)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def global_rank(df: DataFrame, order: Sequence[str], num_partitions: int | None = None,
                rank_col: str = "rank") -> DataFrame:
    """1-based position of each row in a total order, computed in parallel.

    Plan: range-partition on the order columns (sampled bounds, so ties of
    a hot value spread only if the order has a unique tie-breaker), sort
    each partition, take the position inside it from
    ``monotonically_increasing_id`` (low 33 bits = row number within the
    partition), count rows per partition, turn the counts into offsets with
    a window over one row per partition, and broadcast those offsets back.
    The broadcast holds one row per partition, a bound fixed by
    ``num_partitions`` (``spark.sql.shuffle.partitions`` unless given; size
    it to the input as for any other sort).  The partitioned, indexed rows are checkpointed in
    the shared checkpoint folder: two exchanges would sample different
    range bounds, and a recomputation after a lost executor must not
    change the positions.  ``order`` must be ascending column names that
    make a total order.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    low_bits = (1 << 33) - 1
    # Range bounds are sampled per exchange, so the indexed rows are saved
    # once and both the counts and the final join read the same copy.
    ranged = materialize(df.repartitionByRange(n, *order)
                           .sortWithinPartitions(*order)
                           .withColumn("_pid", F.spark_partition_id())
                           .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(low_bits))))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.withColumn(
        "_offset",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    return (ranged.join(F.broadcast(offsets.select("_pid", "_offset")), "_pid")
                  .withColumn(rank_col, F.col("_offset") + F.col("_local") + 1)
                  .drop("_pid", "_local", "_offset"))


def zip_with_index(df: DataFrame, order: Sequence[str], num_partitions: int | None = None,
                   index_col: str = "index") -> DataFrame:
    """Dense 0-based position (B16), the same plan as ``global_rank``."""
    return (global_rank(df, order, num_partitions, rank_col="_r")
            .withColumn(index_col, F.col("_r") - 1).drop("_r"))


def global_rank_by_buckets(df: DataFrame, value: str, cut_points: Sequence[float], order: Sequence[str],
                           rank_col: str = "rank") -> DataFrame:
    """E03, E04 with fixed cut points: values go to magnitude buckets (bucket
    i holds values below ``cut_points[i]``, the last the rest), and a row's
    rank is the number of rows in lower buckets plus its rank inside its own.

    That is the position in the order (bucket, ``order``), which
    ``global_rank`` finds in parallel however full a bucket is.
    """
    v = F.col(value)
    bucket = F.lit(len(cut_points))
    for i in reversed(range(len(cut_points))):
        bucket = F.when(v < F.lit(cut_points[i]), F.lit(i)).otherwise(bucket)
    return global_rank(df.withColumn("_bucket", bucket), ["_bucket", *order], rank_col=rank_col).drop("_bucket")
