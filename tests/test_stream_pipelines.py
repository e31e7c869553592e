"""Stream forms of the named pipelines give what their batch forms give (sf0.001), and processors under disorder."""

import datetime as dt
import os

from pyspark.sql import functions as F

import stream_tools as TT
from common import SF_SMALL, rows
from tidemill.operators import joins as J
from tidemill.operators import patterns as P
from tidemill.plans import q_named as N
from tidemill.streaming import harness as H
from tidemill.streaming import operators as SO
from tidemill.streaming import pipelines as SP
from tidemill.streaming import sinks as SK
from tidemill.streaming import stateful as ST

FAR = 4_000_000_000


def at(s):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)


def events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def staged(spark, scratch, df, n=3):
    """``df`` as a stream of ``n`` event-time slices and two far-future files that move the watermark past all of it."""
    src = os.path.join(scratch, "src")
    TT.stage_batches(df, "ts", n, src)
    for i in (0, 1):
        row = [(F.timestamp_seconds(F.lit(FAR + i * 100_000)) if c == "ts" else F.lit(None).cast(t)).alias(c) for c, t in df.dtypes]
        spark.range(1).select(*row).fillna("flush").fillna(-1).coalesce(1).write.parquet(os.path.join(src, f"batch-9999{i}"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), df.schema, max_files_per_trigger=1)
    return SO.event_time(stream, "ts", "0 seconds")


def in_time(df, col="window_end"):
    return df.where(F.col(col) < FAR - 1_000_000)


def test_hot_products(spark, scratch):
    views = events(spark).where("event_type = 'view'").select("ts", "k")
    counts = SP.hot_items(staged(spark, scratch, views), "ts", "k", "1 hour", "5 minutes")
    out = os.path.join(scratch, "out")
    sink = SP.ranked("window_end", [F.col("cnt").desc(), F.col("k")], 5,
                     lambda df, b: df.write.mode("overwrite").parquet(f"{out}/batch_id={b}"))
    H.run_available_now(counts, os.path.join(scratch, "ck"), foreach_batch=sink)
    got = in_time(spark.read.parquet(out))
    assert rows(got, "window_end", "k", "cnt", "rn") == rows(N.hot_products(spark, SF_SMALL), "window_end", "item_id", "cnt", "rn")


def test_hot_pages(spark, scratch):
    pages = events(spark).select("ts", F.concat(F.lit("/p/"), "k").alias("url")).limit(400)
    counts = SP.hot_items(staged(spark, scratch, pages), "ts", "url", "10 minutes", "1 minute")
    got = in_time(TT.collect_stream(counts, "t_hot_pages", os.path.join(scratch, "ck")))
    from tidemill.operators.windows import sliding_counts
    want = sliding_counts(pages, "ts", 600, 60, keys=["url"], by_block=True)
    assert rows(got, "window_end", "url", "cnt") == rows(want, "window_end", "url", "cnt")


def test_page_views_and_unique_visitors(spark, scratch):
    views = events(spark).where("event_type = 'view'").select("ts", "user_id")
    got = in_time(TT.collect_stream(SP.page_views(staged(spark, scratch, views), "ts"), "t_pv", os.path.join(scratch, "ck")))
    assert rows(got, "window_end", "pv") == rows(N.m05_page_views_hourly(spark, SF_SMALL), "window_end", "pv")
    visitors = SP.unique_visitors(staged(spark, os.path.join(scratch, "u"), views), "ts", "user_id")
    got = in_time(TT.collect_stream(visitors, "t_uv", os.path.join(scratch, "ck2")))
    want = rows(N.m06_unique_visitors(spark, SF_SMALL), "window_end", "uv")
    # a window that only the last micro-batch could close may still be open
    assert set(rows(got, "window_end", "uv")) <= set(want) and got.count() >= len(want) - 1


def test_capped_clicks(spark, scratch):
    clicks = events(spark).where("event_type = 'click'").select("ts", "user_id", "event_id").withColumn("ad", F.lit(1))
    out = SP.capped_clicks(staged(spark, scratch, clicks), "ts", "event_id", ["user_id", "ad"], cap=2)
    got = TT.collect_stream(out, "t_capped", os.path.join(scratch, "ck")).where("id >= 0")
    want = P.daily_cap(clicks, ["user_id", "ad"], "ts", "event_id", cap=2)
    assert rows(got, "id", "kind") == rows(want, "event_id", "kind")


def test_attribution_takes_the_newest_context(spark, scratch):
    ev = events(spark).select("event_id", "user_id", F.pmod("k", F.lit(5)).alias("k"), "ts", "event_type")
    server, client = ev.where("event_type = 'view'"), ev.where("event_type in ('click', 'purchase')")
    want = J.asof_context_join(client, server.select("user_id", "k", "ts", "event_id"), ["user_id", "k"], "ts", 86_400, carry=["event_id"])
    stream = staged(spark, scratch, ev)
    out = SP.context_join(stream.where("event_type in ('click', 'purchase', 'flush')"), stream.where("event_type in ('view', 'flush')"),
                          ["user_id", "k"], "ts", 86_400, carry=["event_id"], payload=["event_id"])
    got = TT.collect_stream(out, "t_ctx", os.path.join(scratch, "ck"))
    pairs = lambda df: sorted((r["event_id"], -1 if r["ctx_event_id"] is None else r["ctx_event_id"]) for r in df.collect())
    assert want.where("ctx_event_id is not null").count() > 0
    got = [p for p in pairs(got) if p[0] >= 0]
    assert got == pairs(want)


def test_retry_loop(spark, scratch):
    ctx = os.path.join(scratch, "ctx")
    spark.createDataFrame([(1,)], "k long").write.parquet(ctx)
    loop = SP.RetryLoop(lambda: spark.read.schema("k long").parquet(ctx), ["k"], os.path.join(scratch, "out"), os.path.join(scratch, "pending"), max_retries=2)
    batch = lambda *k: spark.createDataFrame([(x,) for x in k], "k long")
    loop(batch(1, 2, 3), 0)
    spark.createDataFrame([(2,)], "k long").write.mode("append").parquet(ctx)
    loop(batch(1), 1)
    loop(batch(1), 1)  # replayed
    loop(batch(), 2)
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert rows(out, "batch_id", "k", "matched", "retry_count") == [(0, 1, True, 0), (1, 1, True, 0), (1, 2, True, 1), (2, 3, False, 2)]


def test_pending_folders_of_old_batches_go(spark, scratch):
    pending = os.path.join(scratch, "pending")
    loop = SP.RetryLoop(lambda: spark.createDataFrame([(1,)], "k long"), ["k"], os.path.join(scratch, "out"), pending, max_retries=9)
    sink = SK.BufferedSink(3, "k", os.path.join(scratch, "flushed"), os.path.join(scratch, "buffer"))
    once = SK.IdempotentBatchWriter(os.path.join(scratch, "once"), os.path.join(scratch, "ledger"))
    late = SO.LateSplitter("ts", 10, 0, os.path.join(scratch, "marks"), os.path.join(scratch, "on"), os.path.join(scratch, "late"))
    for i in range(5):
        loop(spark.createDataFrame([(i + 1,)], "k long"), i)
        sink(spark.createDataFrame([(i,)], "k long"), i)
        once(spark.createDataFrame([(i,)], "k long"), i)
        late(spark.createDataFrame([(at(100 - i if i else 100),)], "ts timestamp"), i)
    for name in ("pending", "buffer", "ledger", "marks"):
        assert sorted(f for f in os.listdir(os.path.join(scratch, name)) if f.startswith("b=")) == ["b=3", "b=4"]
    assert sorted(r["k"] for r in spark.read.parquet(os.path.join(scratch, "flushed")).collect()) == [0, 1, 2]
    once(spark.createDataFrame([(4,)], "k long"), 4)  # replayed
    assert spark.read.parquet(os.path.join(scratch, "once")).count() == 5
    assert spark.read.parquet(os.path.join(scratch, "late")).count() == 4  # the largest time of all batches counts


def test_context_join_keeps_null_keys_and_compares_microseconds(spark, scratch):
    schema = "k long, ts timestamp, id long, side string"
    us = lambda s, m: at(s).replace(microsecond=m)
    batches = [[(1, us(10, 500), 100, "s"), (1, us(10, 400), 1, "c"), (1, us(10, 600), 2, "c"), (None, at(10), 3, "c"), (None, at(9), 101, "s")],
               [(1, us(20, 0), 102, "s"), (1, us(20, 0), 103, "s"), (1, us(20, 0), 4, "c"), (1, us(15, 0), 5, "c")],
               [(7, at(FAR), 8, "c")], [(7, at(FAR + 1), 9, "c")]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1).withWatermark("ts", "10 seconds")
    out = SP.context_join(stream.where("side = 'c'"), stream.where("side = 's'"), ["k"], "ts", 5, carry=["id"], payload=["id"])
    got = TT.collect_stream(out, "t_ctx_null", os.path.join(scratch, "ck"))
    assert sorted((r["id"], r["ctx_id"]) for r in got.where("id < 8").collect()) == [(1, None), (2, 100), (3, None), (4, 103), (5, 100)]


def test_daily_cap_counts_late_rows_in_their_own_day(spark, scratch):
    schema = "u long, ts timestamp, id long"
    day = 86_400
    batches = [[(1, at(10), 1), (1, at(20), 2)], [(1, at(day + 5), 3)], [(1, at(30), 4)], [(1, at(40), 5), (1, at(day + 6), 6)]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    out = ST.apply(stream, ["u"], ST.DailyCap("ts", "id", cap=2), "id long, kind string")
    got = TT.collect_stream(out, "t_late_cap", os.path.join(scratch, "ck"))
    assert rows(got) == [(1, "pass"), (2, "pass"), (3, "pass"), (4, "alert"), (6, "pass")]


def test_sequence_across_batches_in_event_time_order(spark, scratch):
    schema = "u long, ts timestamp, id long, fail boolean"
    batches = [[(1, at(100), 1, True), (1, at(104), 3, True)], [(1, at(102), 2, False), (1, at(106), 4, True), (1, at(108), 5, True)],
               [(9, at(FAR), 8, False)], [(9, at(FAR + 1), 9, False)]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1).withWatermark("ts", "10 seconds")
    out = ST.apply(stream, ["u"], ST.StrictSequence("ts", "id", "fail", 3, 10_000, wait=True),
                   "key long, first_ms long, first_id long, last_ms long, last_id long", time_mode="EventTime")
    got = TT.collect_stream(out, "t_seq_order", os.path.join(scratch, "ck"))
    assert rows(got, "first_id", "last_id") == [(3, 5)]


def test_session_start_moves_to_an_earlier_row(spark, scratch):
    schema = "u long, ts timestamp"
    batches = [[(1, at(100))], [(1, at(60))], [(9, at(FAR))], [(9, at(FAR + 1))]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1).withWatermark("ts", "1 hour")
    out = ST.apply(stream, ["u"], ST.SessionByTimer("ts", 50_000), "key long, session_start_ms long, session_end_ms long, cnt long", time_mode="EventTime")
    got = TT.collect_stream(out, "t_session_start", os.path.join(scratch, "ck"))
    assert [r for r in rows(got) if r[0] == 1] == [(1, 60_000, 150_000, 2)]


def test_replayed_jdbc_batch_and_tied_buffer_rows(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "word string, cnt long")
    url = f"jdbc:derby:{scratch}/db;create=true"
    write = SK.jdbc_batch_writer(url, "replayed")
    write(df, 7)
    write(df, 7)
    write(df, 8)
    assert rows(spark.read.jdbc(url, "replayed"), "batch_id", "word") == [(7, "a"), (7, "b"), (8, "a"), (8, "b")]
    sink = SK.BufferedSink(2, "seq", os.path.join(scratch, "out"), os.path.join(scratch, "pending"))
    sink(spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "word string, seq long").repartition(3), 0)
    assert rows(spark.read.parquet(os.path.join(scratch, "out")), "word") == [("x",), ("y",)]
    assert rows(spark.read.parquet(os.path.join(scratch, "pending")), "word") == [("z",)]
