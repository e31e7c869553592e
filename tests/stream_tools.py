"""Helpers of the stream tests: frames staged as micro-batches, streams collected from a memory sink."""

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_seconds
from tidemill.streaming import harness as H


def stage_batches(df: DataFrame, ts: str, n_batches: int, path: str) -> list[str]:
    """Write ``df`` as ``n_batches`` event-time slices, one
    Parquet file each, in time order, so a file stream with one file per
    trigger replays them as successive micro-batches."""
    bounds = df.agg(F.min(epoch_seconds(ts)).alias("lo"), F.max(epoch_seconds(ts)).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    width = max(1, -(-(hi - lo + 1) // n_batches))
    tagged = df.withColumn("_b", F.floor((epoch_seconds(ts) - F.lit(lo)) / F.lit(width)).cast("int"))
    written = []
    for b in range(n_batches):
        out = os.path.join(path, f"batch-{b:05d}")
        part = tagged.filter(F.col("_b") == b).drop("_b")
        part.coalesce(1).write.mode("overwrite").parquet(out)
        written.append(out)
    return written


def stage_rows_as_batches(spark: SparkSession, batches: list[list[tuple]], schema, path: str) -> str:
    """Each inner list becomes one file, i.e. one micro-batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(
            os.path.join(path, f"batch-{i:05d}"))
    return path


def collect_stream(stream: DataFrame, name: str, checkpoint: str, output_mode: str = "append",
                   input_rows: int | None = None, max_wait_s: float = 120.0) -> DataFrame:
    """Run to completion into a memory table and return it.

    With ``input_rows`` the query runs on the default trigger until that
    many input rows were processed, then stops: a processing-time stateful
    query (state TTL) keeps scheduling batches, so neither ``availableNow``
    nor ``processAllAvailable`` would return."""
    if input_rows is None:
        H.run_available_now(stream, checkpoint, output_mode, sink="memory", query_name=name)
        return stream.sparkSession.table(name)
    q = (stream.writeStream.outputMode(output_mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).start())
    deadline = time.time() + max_wait_s
    seen: dict[int, int] = {}
    try:
        while time.time() < deadline:
            if q.exception():
                raise q.exception()
            for p in q.recentProgress:
                seen[p["batchId"]] = p["numInputRows"]
            if sum(seen.values()) >= input_rows:
                break
            time.sleep(0.2)
        else:
            raise TimeoutError(f"stream {name} did not consume {input_rows} rows in {max_wait_s}s")
    finally:
        q.stop()
    return stream.sparkSession.table(name)


def run_until(stream: DataFrame, name: str, checkpoint: str, done, output_mode: str = "append", max_wait_s: float = 90.0):
    """Run on the default trigger into a memory table until ``done(rows)`` holds, then stop; returns the rows and the
    progress reports.  For queries with processing-time timers, which never run out of batches."""
    q = (stream.writeStream.outputMode(output_mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).start())
    deadline = time.time() + max_wait_s
    try:
        while time.time() < deadline:
            if q.exception():
                raise q.exception()
            got = stream.sparkSession.table(name).collect()
            if done(got):
                return got, list(q.recentProgress)
            time.sleep(0.3)
    finally:
        q.stop()
    raise TimeoutError(f"stream {name}: {got}")
