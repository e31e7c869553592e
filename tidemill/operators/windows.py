"""Event-time windows in batch form.

Windows are computed on epoch seconds so results do not depend on the
session time zone.  Sliding windows whose size is a multiple of the slide
are built from slices: rows are first aggregated per (slice, keys), which
collapses dense data to one row per slice and key before the
``size / slide`` copies are made; only decomposable aggregates (count,
sum, min, max) go that way.  Other shapes fall back to ``F.window``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_seconds


def _cols(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def tumbling_agg(df: DataFrame, ts: str, size_s: int, keys=None, aggs: Sequence[Column] | None = None,
                 offset_s: int = 0) -> DataFrame:
    """Aligned fixed windows (J03 keyed, J04 over all rows).

    Returns ``window_start`` and ``window_end`` in epoch seconds plus the
    aggregates (default ``count(*) AS cnt``).  One shuffle on
    (window, keys) with map-side partial aggregation.
    """
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("cnt")]
    sec = epoch_seconds(ts)
    start = sec - F.pmod(sec - F.lit(offset_s), F.lit(size_s))
    return (df.withColumn("window_start", start)
              .groupBy("window_start", *_cols(keys)).agg(*aggs)
              .withColumn("window_end", F.col("window_start") + F.lit(size_s)))


def window_starts(sec: Column, size_s: int, slide_s: int) -> Column:
    """Array of the start times of every sliding window holding ``sec``.

    Works for any size and slide; with ``size < slide`` (gapped windows,
    J05) a row that falls in a gap belongs to no window.
    """
    last = sec - F.pmod(sec, F.lit(slide_s))
    if size_s % slide_s == 0:
        # every candidate holds ``sec``: a plain sequence, no lambda to
        # evaluate per element
        return F.sequence(last - F.lit(size_s - slide_s), last, F.lit(slide_s))
    n = -(-size_s // slide_s)
    starts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: last - i * F.lit(slide_s))
    return F.filter(starts, lambda s: sec < s + F.lit(size_s))


def sliding_counts(df: DataFrame, ts: str, size_s: int, slide_s: int, keys=None,
                   sum_col: str | None = None, by_block: bool = False) -> DataFrame:
    """Count (and optionally sum) per sliding window and keys.

    Two steps: aggregate per (slice, keys), then copy each slice row into
    the windows that hold it and add up.  The copies are made from the
    pre-aggregated slices, so at scale the ``size/slide`` blow-up applies to
    (#slices x #keys), not to the raw rows.

    With ``by_block`` (the size a multiple of the slide) windows are grouped
    in time blocks of ``size_s`` by their start.  A slice goes to the two
    blocks whose windows can hold it, and is copied into windows only there:
    the exchange carries two copies of a slice at most, whatever ``size /
    slide`` is.  It is on the block and the keys, so a block's items are
    spread over the tasks; a top-N per window keeps N rows a task and window
    (``WindowGroupLimit``) before it shuffles them.
    """
    keys = _cols(keys)
    sec = epoch_seconds(ts)
    # Slices of gcd(size, slide) seconds: every window boundary is a slice
    # boundary, so a slice lies wholly inside or outside each window.
    width = math.gcd(size_s, slide_s)
    slice_aggs = [F.count(F.lit(1)).alias("_n")]
    if sum_col:
        slice_aggs.append(F.sum(sum_col).alias("_s"))
    slices = (df.withColumn("_slice", sec - F.pmod(sec, F.lit(width)))
                .groupBy("_slice", *keys).agg(*slice_aggs))
    out_aggs = [F.sum("_n").alias("cnt")]
    if sum_col:
        out_aggs.append(F.sum("_s").alias("total"))
    if by_block:
        first, last = _block_window_starts(size_s, slide_s)
        win = (_in_blocks(slices, size_s).withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
               .repartition(_spread(df), "block", *keys).withColumn("window_start", F.explode(F.sequence("_first", "_last", F.lit(slide_s).cast("long")))))
        grouped = win.groupBy("block", "window_start", *keys)
    else:
        win = slices.withColumn("window_start", F.explode(window_starts(F.col("_slice"), size_s, slide_s)))
        grouped = win.groupBy("window_start", *keys)
    return grouped.agg(*out_aggs).withColumn("window_end", F.col("window_start") + F.lit(size_s))


def _spread(df: DataFrame) -> int:
    """Partitions for slices that grow once they have been shuffled (into
    windows): a stated number, since run-time coalescing goes by the size
    before that."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _in_blocks(slices: DataFrame, size_s: int) -> DataFrame:
    """Each slice once in the block of its time and once in the one before."""
    own = F.floor(F.col("_slice") / F.lit(size_s))
    return slices.withColumn("block", F.explode(F.array(own, own - 1)))


def _block_window_starts(size_s: int, slide_s: int) -> tuple[Column, Column]:
    """First and last start of the block's windows that hold the slice; the
    first is after the last where there is none."""
    first = F.greatest(F.col("_slice") - F.lit(size_s - slide_s), F.col("block") * F.lit(size_s))
    return first, F.least(F.col("_slice"), (F.col("block") + 1) * F.lit(size_s) - F.lit(slide_s))


def sliding_agg(df: DataFrame, ts: str, size_s: int, slide_s: int, keys=None,
                aggs: Sequence[Column] | None = None) -> DataFrame:
    """Any aggregate over sliding windows: each row is copied into its windows."""
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("cnt")]
    return (df.withColumn("window_start", F.explode(window_starts(epoch_seconds(ts), size_s, slide_s)))
              .groupBy("window_start", *_cols(keys)).agg(*aggs)
              .withColumn("window_end", F.col("window_start") + F.lit(size_s)))


def session_agg(df: DataFrame, ts: str, gap_s: int, keys, aggs: Sequence[Column] | None = None) -> DataFrame:
    """Session windows (J07): a session closes after ``gap_s`` without rows.

    Uses ``F.session_window``; the session bounds come back in epoch
    seconds (``session_start`` is the first row's time, ``session_end`` the
    last row's time plus the gap).
    """
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("cnt")]
    sw = F.session_window(F.col(ts), f"{gap_s} seconds")
    out = df.groupBy(*_cols(keys), sw.alias("_sw")).agg(*aggs)
    return (out.withColumn("session_start", epoch_seconds(F.col("_sw.start")))
               .withColumn("session_end", epoch_seconds(F.col("_sw.end")))
               .drop("_sw"))


def session_counts_by_block(df: DataFrame, ts: str, gap_s: int, keys, block_s: int = 86400, value: str | None = None) -> DataFrame:
    """Sessions (J07) without one task a key: count and, with ``value``, sum.

    Rows are cut into stretches per (key, time block), so a key's rows are
    spread over its blocks.  Only the first and the last stretch of a block
    can go on in another block; those, at most two a block and key, are
    chained per key.  Times are compared in microseconds, and rows exactly
    ``gap_s`` apart share a session, as in ``session_window``; rows without
    a time take no part.  Returns the keys, ``cnt`` (and ``total``), and the
    session's bounds in epoch seconds as ``session_agg`` does.
    """
    keys, gap = _cols(keys), gap_s * 1_000_000
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    rows = df.where(F.col(ts).isNotNull()).select(*keys, us.alias("_t"), *([F.col(value).alias("_v")] if value else []))
    rows = rows.withColumn("_block", F.floor(F.col("_t") / F.lit(block_s * 1_000_000)))
    inside = Window.partitionBy(*keys, "_block").orderBy("_t")
    new = F.when(F.col("_t") - F.lag("_t").over(inside) <= gap, 0).otherwise(1)
    rows = rows.withColumn("_new", new).withColumn("_no", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sums = [F.sum("_v").alias("total")] if value else []
    parts = rows.groupBy(*keys, "_block", "_no").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count(F.lit(1)).alias("cnt"), *sums)
    parts = parts.withColumn("_last", F.max("_no").over(Window.partitionBy(*keys, "_block")))
    at_edge = (F.col("_no") == 1) | (F.col("_no") == F.col("_last"))
    chain = Window.partitionBy(*keys).orderBy("_lo")
    edges = parts.where(at_edge).withColumn("_new", F.when(F.col("_lo") - F.lag("_hi").over(chain) <= gap, 0).otherwise(1))
    edges = edges.withColumn("_sid", F.sum("_new").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    add = [F.sum("cnt").alias("cnt"), *([F.sum("total").alias("total")] if value else [])]
    joined = edges.groupBy(*keys, "_sid").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), *add)
    cols = [*keys, "_lo", "_hi", "cnt", *(["total"] if value else [])]
    out = joined.select(*cols).unionByName(parts.where(~at_edge).select(*cols))
    return (out.withColumn("session_start", F.floor(F.col("_lo") / 1_000_000)).withColumn("session_end", F.floor((F.col("_hi") + gap) / 1_000_000))
               .drop("_lo", "_hi"))


def _positions(df: DataFrame, keys: list[str], order: Sequence[str], out: str,
               time_bucket_s: int | None) -> DataFrame:
    """1-based position of each row in its key's order.  With
    ``time_bucket_s`` (order = [timestamp, tiebreak]) the position is a
    running count split by time bucket, so a hot key is not numbered by
    one task."""
    if time_bucket_s:
        from tidemill.operators.patterns import running_total_bucketed
        return running_total_bucketed(df, keys, order[0], order[1], bucket_s=time_bucket_s, out=out)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def count_window(df: DataFrame, keys, order: Sequence[str], n: int,
                 aggs: Sequence[Column] | None = None, time_bucket_s: int | None = None) -> DataFrame:
    """Tumbling count window (J09): each full run of ``n`` rows per key fires.

    ``group_no`` numbers the runs from 0; a trailing partial run never fires.
    """
    keys = _cols(keys)
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("cnt")]
    numbered = _positions(df, keys, order, "_rn", time_bucket_s)
    grouped = (numbered.withColumn("group_no", F.floor((F.col("_rn") - 1) / n).cast("long"))
                       .groupBy(*keys, "group_no")
                       .agg(F.count(F.lit(1)).alias("_size"), *aggs))
    return grouped.filter(F.col("_size") == n).drop("_size")


def accumulating_count_trigger(df: DataFrame, keys, order: Sequence[str], n: int,
                               value: str, time_bucket_s: int | None = None) -> DataFrame:
    """Global window with a count trigger and no purge (J10): at every n-th
    row of a key, the total of all rows so far."""
    keys = _cols(keys)
    if time_bucket_s:
        from tidemill.operators.patterns import running_totals
        both = running_totals(df, keys, order[0], order[1], {"seq": F.lit(1).cast("long"), "total": F.col(value)}, time_bucket_s)
        return both.withColumn("seq", F.col("seq").cast("int")).filter(F.col("seq") % n == 0)
    w = Window.partitionBy(*keys).orderBy(*order)
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("seq", F.row_number().over(w))
              .withColumn("total", F.sum(value).over(running))
              .filter(F.col("seq") % n == 0))


def sliding_count_window(df: DataFrame, keys, order: Sequence[str], size: int, slide: int,
                         value: str, time_bucket_s: int | None = None, block_rows: int = 4096) -> DataFrame:
    """Sliding count window (J11): every ``slide`` rows, the sum of the last
    ``size`` rows of the key.

    With ``time_bucket_s`` (order = [timestamp, tiebreak]) positions come
    from the time-bucketed running count and rows are grouped in blocks of
    ``max(block_rows, size)`` positions, each row copied into the next
    block as well; a frame of ``size`` rows then always lies inside one
    (key, block) partition, so a hot key is split into blocks.
    """
    keys = _cols(keys)
    if not time_bucket_s:
        w = Window.partitionBy(*keys).orderBy(*order)
        frame = w.rowsBetween(-(size - 1), 0)
        return (df.withColumn("seq", F.row_number().over(w))
                  .withColumn("total", F.sum(value).over(frame))
                  .withColumn("n_rows", F.count(F.lit(1)).over(frame))
                  .filter(F.col("seq") % slide == 0))
    block = max(block_rows, size)
    pos = _positions(df, keys, order, "seq", time_bucket_s)
    own = F.floor((F.col("seq") - 1) / F.lit(block))
    blocked = pos.withColumn("_own", own).withColumn("_blk", F.explode(F.array(own, own + 1)))
    frame = Window.partitionBy(*keys, "_blk").orderBy("seq").rowsBetween(-(size - 1), 0)
    out = (blocked.withColumn("total", F.sum(value).over(frame))
                  .withColumn("n_rows", F.count(F.lit(1)).over(frame))
                  .filter((F.col("_own") == F.col("_blk")) & (F.col("seq") % slide == 0)))
    return out.withColumn("seq", F.col("seq").cast("int")).drop("_own", "_blk")


def sliding_counts_prefix(df: DataFrame, ts: str, size_s: int, slide_s: int, keys=None) -> DataFrame:
    """Sliding-window counts without copying slices into windows.

    Needs ``size_s % slide_s == 0``.  Rows are counted per (keys, slice) and
    each slice goes to the two time blocks of ``size_s`` whose windows can
    hold it, so a key's windows are spread over its blocks.  Per key and
    block, each window that holds data is emitted exactly once, by the
    first slice inside it (the windows starting after the key's previous
    slice); its count is the running count up to its last slice minus the
    running count before its first slice.  The last-slice lookup is an
    as-of ``last(..., ignorenulls)`` over slices and window ends ordered by
    time.  Work is proportional to slices plus output windows, and a key's
    rows in a block are bounded by ``2 * size / slide``.
    """
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    keys = _cols(keys)
    span = size_s - slide_s
    sec = epoch_seconds(ts)
    slices = (df.withColumn("_slice", sec - F.pmod(sec, F.lit(slide_s)))
                .groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n")))
    keys = [*keys, "block"]
    slices = _in_blocks(slices, size_s).repartition(_spread(df), *keys)
    by_time = Window.partitionBy(*keys).orderBy("_slice")
    slices = (slices.withColumn("_cum", F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
                    .withColumn("_prev", F.lag("_slice").over(by_time)))
    first, last = _block_window_starts(size_s, slide_s)
    first = F.greatest(F.col("_prev") + F.lit(slide_s), first)
    wins = slices.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    wins = wins.select(*keys, F.explode(F.sequence("_first", "_last", F.lit(slide_s).cast("long")))
                         .alias("window_start"), (F.col("_cum") - F.col("_n")).alias("_before"))
    marks = wins.select(*keys, "window_start", "_before", (F.col("window_start") + F.lit(span)).alias("_t"),
                        F.lit(1).alias("_side"))
    points = slices.select(*keys, F.col("_slice").alias("_t"), F.lit(0).alias("_side"), "_cum")
    merged = marks.unionByName(points, allowMissingColumns=True)
    asof = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.withColumn("_cum_end", F.last("_cum", ignorenulls=True).over(asof))
    out = merged.filter(F.col("_side") == 1).select(*keys[:-1], "window_start",
                                                     (F.col("_cum_end") - F.col("_before")).alias("cnt"))
    return out.withColumn("window_end", F.col("window_start") + F.lit(size_s))
