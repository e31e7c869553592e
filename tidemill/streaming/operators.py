"""Stream operators on Structured Streaming (survey 2.10, 2.3 stream rows,
2.1 stream sinks).

Event time must be a zoned ``TIMESTAMP`` for ``withWatermark``; tables
that carry ``TIMESTAMP_NTZ`` are converted with ``event_time`` (the
session time zone is UTC in this library's sessions).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_seconds
from tidemill.streaming.sinks import drop_batch, read_if_there


def event_time(df: DataFrame, ts: str, delay: str = "10 seconds", out: str | None = None) -> DataFrame:
    """Take event time from a column and declare a watermark of
    max event time minus ``delay`` (J17 re-aimed: a zero delay is the
    "now" watermark)."""
    out = out or ts
    return df.withColumn(out, F.col(ts).cast("timestamp")).withWatermark(out, delay)


def running_count(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total so far per key; run in update or complete mode."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def per_batch_counts(keys: Sequence[str], sink: Callable[[DataFrame, int], None]):
    """A ``foreachBatch`` function counting inside each micro-batch only."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).withColumn("batch_id", F.lit(batch_id)),
             batch_id)
    return run


def windowed_counts(stream: DataFrame, ts: str, size: str, slide: str | None = None,
                    keys: Sequence[str] = (), aggs: Sequence[Column] | None = None) -> DataFrame:
    """Window aggregates on a watermarked stream
    (append mode emits a window once the watermark passes its end; J20:
    later rows are dropped)."""
    win = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("cnt")]
    out = stream.groupBy(win.alias("w"), *keys).agg(*aggs)
    return (out.withColumn("window_start", epoch_seconds(F.col("w.start")))
               .withColumn("window_end", epoch_seconds(F.col("w.end"))).drop("w"))


def session_counts(stream: DataFrame, ts: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Session windows on a watermarked stream."""
    out = stream.groupBy(F.session_window(F.col(ts), gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    return (out.withColumn("session_start", epoch_seconds(F.col("s.start")))
               .withColumn("session_end", epoch_seconds(F.col("s.end"))).drop("s"))


def distinct_per_window(stream: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """D21 on a stream: exact distinct count needs the pairs first
    (``count_distinct`` is refused on streams): drop duplicate (window,
    user) pairs under the watermark; count them at the sink."""
    # The window column carries the event-time watermark, so the dedup
    # state of a window is dropped once the watermark passes its end.
    w = stream.withColumn("w", F.window(F.col(ts), size))
    return w.dropDuplicates(["w", user]).select(epoch_seconds(F.col("w.start")).alias("window_start"), user)


def block_list_stream(stream: DataFrame, col: str, blocked: DataFrame, blocked_col: str) -> DataFrame:
    """Stream-static anti join to a block list."""
    bl = blocked.select(F.col(blocked_col).alias("_blk")).distinct()
    return stream.join(bl, F.col(col) == F.col("_blk"), "left_anti")


def dynamic_enrichment(load_dim: Callable[[], DataFrame], on: str, default: dict,
                       sink: Callable[[DataFrame, int], None]):
    """``foreachBatch`` that re-reads the dimension for every batch, so
    a changed map applies from the next batch on; missing keys get the
    defaults."""
    def run(batch: DataFrame, batch_id: int) -> None:
        dim = load_dim()
        out = batch.join(dim, on, "left")
        for c, v in default.items():
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
        sink(out, batch_id)
    return run


def window_join_stream(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                       size: str) -> DataFrame:
    """C11: stream-stream inner join of rows with the same key in the same
    tumbling window (both sides watermarked)."""
    lw = left.withColumn("_w", F.window(F.col(left_ts), size).getField("start"))
    rw = right.withColumn("_w2", F.window(F.col(right_ts), size).getField("start")).withColumnRenamed(key, "_k2")
    return lw.join(rw, (F.col(key) == F.col("_k2")) & (F.col("_w") == F.col("_w2")), "inner")


class LateSplitter:
    """``foreachBatch`` that sends rows whose window has closed to a
    late output instead of dropping them.

    The watermark for batch b is the largest event time of batches before
    b minus ``delay_s``; it is kept in a small table under ``state_path``
    (a row for each of the last two batch ids), so a restarted or replayed
    batch sees the same watermark.  A row is late when its window end is at or before it.
    Both outputs are written per batch id with overwrite, so a replay
    replaces rather than duplicates.
    """

    def __init__(self, ts: str, window_s: int, delay_s: int, state_path: str, on_time_path: str, late_path: str):
        self.ts, self.window_s, self.delay_s = ts, window_s, delay_s
        self.state_path, self.on_time_path, self.late_path = state_path, on_time_path, late_path

    def _largest_before(self, spark, batch_id: int):
        marks = read_if_there(spark, f"{self.state_path}/b={batch_id - 1}")
        return None if marks is None else marks.first()["max_sec"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._largest_before(spark, batch_id)
        wm = None if before is None else before - self.delay_s
        sec = epoch_seconds(self.ts)
        end = sec - F.pmod(sec, F.lit(self.window_s)) + F.lit(self.window_s)
        tagged = batch.withColumn("_late", (end <= F.lit(wm)) if wm is not None else F.lit(False))
        tagged = tagged.withColumn("batch_id", F.lit(batch_id)).persist()
        (tagged.filter(~F.col("_late")).drop("_late").write.mode("overwrite")
               .parquet(f"{self.on_time_path}/batch_id={batch_id}"))
        (tagged.filter(F.col("_late")).drop("_late").write.mode("overwrite")
               .parquet(f"{self.late_path}/batch_id={batch_id}"))
        mx = max((m for m in (before, tagged.agg(F.max(sec).alias("max_sec")).first()["max_sec"]) if m is not None), default=None)
        spark.createDataFrame([(batch_id, mx)], "batch_id long, max_sec long").write.mode("overwrite").parquet(
            f"{self.state_path}/b={batch_id}")
        drop_batch(spark, f"{self.state_path}/b={batch_id - 2}")
        tagged.unpersist()
