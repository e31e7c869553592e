"""File-stream plumbing: sources, triggers and sinks for Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_files_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Files of a folder as an unbounded stream; with
    ``max_files_per_trigger`` each trigger takes at most so many new files
    (the replay pace), without it all there are."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load(path)


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines (column ``value``) of files landing in a folder."""
    return read_files_stream(spark, path, "value string", fmt="text", max_files_per_trigger=max_files_per_trigger)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a host and port (configuration only; tests use
    ``read_text_stream``)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A10: a topic subscription (needs the Kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**options).load()


def run_available_now(stream: DataFrame, checkpoint: str, output_mode: str = "append",
                      sink: str = "parquet", path: str | None = None, foreach_batch=None,
                      query_name: str | None = None, partition_by: list[str] | None = None) -> StreamingQuery:
    """Run a stream over everything available now, then stop.

    ``foreach_batch`` wins over ``sink``; the checkpoint folder keeps
    offsets and state, so a second run resumes where the first stopped.
    """
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q
