"""Stream forms of the named pipelines.

Each takes watermarked streams and gives a stream, or a ``foreachBatch``
function where the last step is a rank: in append mode all counts of a
window come out in the micro-batch in which the watermark passes its end,
so a batch rank over that micro-batch is the rank of the whole window and
no window's items are gathered in one state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.time import epoch_seconds
from tidemill.operators.ranking import top_n_per_group
from tidemill.streaming.operators import windowed_counts
from tidemill.streaming.sinks import drop_batch, read_if_there, retry_round
from tidemill.streaming.stateful import DailyCap, NewestContext, apply


def hot_items(stream: DataFrame, ts: str, item: str, size: str, slide: str) -> DataFrame:
    """Counts per item and sliding window; rank them with ``ranked``."""
    return windowed_counts(stream, ts, size, slide, [item]).select("window_end", item, "cnt")


def ranked(group: str, order: Sequence[Column], n: int, sink: Callable[[DataFrame, int], None]):
    """E01 on a stream: ``foreachBatch`` keeping the first ``n`` rows of each group of complete windows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(top_n_per_group(batch, group, order, n), batch_id)
    return run


def page_views(stream: DataFrame, ts: str, size: str = "1 hour") -> DataFrame:
    """Rows per tumbling window."""
    return windowed_counts(stream, ts, size).select("window_end", F.col("cnt").alias("pv"))


def unique_visitors(stream: DataFrame, ts: str, user: str, size: str = "1 hour") -> DataFrame:
    """Distinct users per tumbling window.  The pairs are deduplicated
    first, so the state holds one entry per (window, user) and the count's
    partial sums need no list of users."""
    pairs = stream.groupBy(F.window(F.col(ts), size).alias("w"), user).agg(F.count(F.lit(1)).alias("_n"))
    per = pairs.groupBy(F.window("w", size).alias("w")).agg(F.count(user).alias("uv"))
    return per.select(epoch_seconds(F.col("w.end")).alias("window_end"), "uv")


def capped_clicks(stream: DataFrame, ts: str, row_id: str, keys: Sequence[str], cap: int = 100) -> DataFrame:
    """K10 inside M07: rows that pass the daily cap, with their event time;
    a day's state goes once the watermark has passed it."""
    return apply(stream, keys, DailyCap(ts, row_id, cap, expire=True), "id long, kind string", time_mode="EventTime")


def context_join(client: DataFrame, server: DataFrame, keys: Sequence[str], ts: str, max_age_s: int,
                 carry: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Each client row with the newest server row of its key at or
    before its time and at most ``max_age_s`` older, or nulls.

    A client row comes out once the watermark has passed its time, so
    disorder within the watermark's delay doesn't change its context.  Client
    rows with a null key meet nothing and come out at once, with nulls.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    field = {f.name: f.dataType for f in [*client.schema.fields, *server.schema.fields]}
    ctx = T.StructType([T.StructField(c, field[c]) for c in carry])
    own = T.StructType([T.StructField(c, {f.name: f.dataType for f in client.schema.fields}[c]) for c in payload])

    def side(df: DataFrame, name: str, has_ctx: bool) -> DataFrame:
        return df.where(whole).select(
            *keys, ts, F.lit(name).alias("side"),
            F.struct(*carry).cast(ctx).alias("ctx") if has_ctx else F.lit(None).cast(ctx).alias("ctx"),
            F.lit(None).cast(own).alias("own") if has_ctx else F.struct(*payload).cast(own).alias("own"))
    both = side(server, "server", True).unionByName(side(client, "client", False))
    flat = ["ctx_ts long", *[f"ctx_{c} {field[c].simpleString()}" for c in carry]]
    out_schema = ", ".join([*[f"{c} {own[c].dataType.simpleString()}" for c in payload], *flat])
    proc = NewestContext(ts, max_age_s * 1000, list(payload), list(carry), own, ctx)
    met = apply(both, keys, proc, out_schema, time_mode="EventTime")
    nothing = [F.lit(None).cast("long").alias("ctx_ts"), *[F.lit(None).cast(field[c]).alias(f"ctx_{c}") for c in carry]]
    return met.unionByName(client.where(~whole).select(*payload, *nothing))


class RetryLoop:
    """C14 around M10: a ``foreachBatch`` that keeps unmatched rows in a
    pending table and tries them again against the current context.

    Rows wait ``delay_batches`` micro-batches between tries.  The pending
    table of batch N is written with overwrite under its id and read by batch
    N + 1, so a replayed batch sees what it saw before; older ones go.
    """

    def __init__(self, load_context: Callable[[], DataFrame], keys: Sequence[str], path: str, pending_path: str,
                 max_retries: int = 5, delay_batches: int = 1):
        self.load_context, self.keys, self.path, self.pending_path = load_context, list(keys), path, pending_path
        self.max_retries, self.delay_batches = max_retries, delay_batches

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("retry_count", F.lit(0).cast("long")).withColumn("_due", F.lit(batch_id).cast("long"))
        prev = read_if_there(spark, f"{self.pending_path}/b={batch_id - 1}")
        rows = fresh if prev is None else prev.unionByName(fresh)
        emitted, again = retry_round(rows.where(F.col("_due") <= batch_id), self.load_context(), self.keys, self.max_retries)
        emitted.drop("_due").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        later = rows.where(F.col("_due") > batch_id).unionByName(
            again.withColumn("_due", F.lit(batch_id + self.delay_batches).cast("long")))
        later.write.mode("overwrite").parquet(f"{self.pending_path}/b={batch_id}")
        drop_batch(spark, f"{self.pending_path}/b={batch_id - 2}")
