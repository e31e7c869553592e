"""Stream-equals-batch, restart and replay checks (survey section 5, layer 3)."""

import datetime as dt
import os

from pyspark.sql import functions as F

import stream_tools as TT
from common import DATA, SF_SMALL, rows
from tidemill.operators import patterns as P
from tidemill.operators import windows as W
from tidemill.sources import formats as FMT
from tidemill.streaming import harness as H
from tidemill.streaming import operators as SO
from tidemill.streaming import sinks as SK
from tidemill.streaming import stateful as ST

EVENTS_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
FAR_FUTURE = dt.datetime(2030, 1, 1)


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _stage_events(spark, scratch, n=4, flush=True):
    src = os.path.join(scratch, "src")
    ev = _events(spark)
    TT.stage_batches(ev, "ts", n, src)
    if flush:  # a far-future row moves the watermark past every window; the
        # second file gives the micro-batch that runs under that watermark
        for i, extra in enumerate((0, 1)):
            spark.createDataFrame([(-1 - extra, FAR_FUTURE, -1, "flush", 0.0, "{}")], EVENTS_SCHEMA).coalesce(1) \
                 .write.parquet(os.path.join(src, f"batch-9999{i}"))
    return H.read_files_stream(spark, os.path.join(src, "*"), EVENTS_SCHEMA, max_files_per_trigger=1)


def test_tumbling_counts_stream_equals_batch(spark, scratch):
    stream = SO.event_time(_stage_events(spark, scratch), "ts", "10 seconds")
    # flush rows are dropped after collecting: a filter on the key, even on
    # the aggregated output, is pushed below the watermark, which then never
    # moves
    counts = SO.windowed_counts(stream, "ts", "1 hour", keys=["event_type"])
    got = TT.collect_stream(counts, "t_tumbling", os.path.join(scratch, "ck"))
    batch = W.tumbling_agg(_events(spark), "ts", 3600, keys=["event_type"])
    got_rows = [r for r in rows(got, "window_start", "event_type", "cnt") if r[1] != "flush"]
    assert got_rows == rows(batch, "window_start", "event_type", "cnt")


def test_sliding_counts_stream_equals_batch(spark, scratch):
    stream = SO.event_time(_stage_events(spark, scratch), "ts", "10 seconds")
    counts = SO.windowed_counts(stream, "ts", "2 hours", "30 minutes")
    got = TT.collect_stream(counts, "t_sliding", os.path.join(scratch, "ck"))
    batch = W.sliding_counts(_events(spark), "ts", 7200, 1800)
    got_rows = [r for r in rows(got, "window_start", "cnt") if r[0] < 1_800_000_000]
    assert got_rows == rows(batch, "window_start", "cnt")


def test_sessions_stream_equal_batch_and_timer(spark, scratch):
    stream = SO.event_time(_stage_events(spark, scratch), "ts", "0 seconds")
    sessions = SO.session_counts(stream, "ts", "1 hour", ["user_id"])
    got = TT.collect_stream(sessions, "t_sessions", os.path.join(scratch, "ck1"))
    batch = W.session_agg(_events(spark), "ts", 3600, ["user_id"])
    got_rows = [r for r in rows(got, "user_id", "session_start", "cnt") if r[0] >= 0]
    assert got_rows == rows(batch, "user_id", "session_start", "cnt")
    # The same sessions from value state and an event-time timer
    stream2 = SO.event_time(_stage_events(spark, os.path.join(scratch, "b")), "ts", "0 seconds")
    proc = ST.SessionByTimer("ts", 3600 * 1000)
    timed = ST.apply(stream2.select("user_id", "ts"), ["user_id"], proc,
                     "key long, session_start_ms long, session_end_ms long, cnt long", time_mode="EventTime")
    got2 = TT.collect_stream(timed, "t_timer", os.path.join(scratch, "ck2"))
    assert (sorted((r["key"], r["session_start_ms"] // 1000, r["cnt"]) for r in got2.collect() if r["key"] >= 0)
            == rows(batch, "user_id", "session_start", "cnt"))


def test_late_rows_go_to_side_output(spark, scratch):
    schema = "word string, ts timestamp"
    t = lambda ms: dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None)
    # The late-data sample (ms): two on time, then three late.
    batches = [[("a", t(1461756870000)), ("a", t(1461756883000))],
               [("a", t(1461756870000)), ("a", t(1461756871000)), ("a", t(1461756872000))]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    split = SO.LateSplitter("ts", 3, 10, os.path.join(scratch, "wm"), os.path.join(scratch, "on"),
                            os.path.join(scratch, "late"))
    H.run_available_now(stream, os.path.join(scratch, "ck"), foreach_batch=split)
    on = spark.read.parquet(os.path.join(scratch, "on"))
    late = spark.read.parquet(os.path.join(scratch, "late"))
    assert on.count() == 2 and late.count() == 3
    # replaying batch 1 gives the same split (watermark read from the saved table)
    b1 = spark.createDataFrame(batches[1], schema)
    split(b1, 1)
    assert spark.read.parquet(os.path.join(scratch, "late")).count() == 3


def test_daily_cap_stream(spark, scratch):
    clicks = FMT.read_delimited(spark, os.path.join(DATA, "ad_clicks.csv"),
                                "user_id long, ad_id long, province string, city string, ts long")
    clicks = clicks.withColumn("t", F.timestamp_seconds("ts")).withColumn("rid", F.monotonically_increasing_id())
    src = os.path.join(scratch, "src")
    TT.stage_batches(clicks, "t", 3, src)
    stream = H.read_files_stream(spark, os.path.join(src, "*"), clicks.schema, max_files_per_trigger=1)
    out = ST.apply(stream, ["user_id", "ad_id"], ST.DailyCap("t", "rid", cap=100), "id long, kind string")
    got = TT.collect_stream(out, "t_cap", os.path.join(scratch, "ck"))
    assert got.filter("kind = 'pass'").count() == 122 and got.filter("kind = 'alert'").count() == 1


def test_sequence_stream_equals_batch(spark, scratch):
    logins = FMT.read_delimited(spark, os.path.join(DATA, "logins.csv"),
                                "user_id long, ip string, event_type string, ts long")
    logins = logins.withColumn("t", F.timestamp_seconds("ts")).withColumn("rid", F.monotonically_increasing_id()) \
                   .withColumn("fail", F.col("event_type") == "fail")
    src = os.path.join(scratch, "src")
    TT.stage_batches(logins, "t", 3, src)
    stream = H.read_files_stream(spark, os.path.join(src, "*"), logins.schema, max_files_per_trigger=1)
    out = ST.apply(stream, ["user_id"], ST.StrictSequence("t", "rid", "fail", 3, 86_400_000),
                   "key long, first_ms long, first_id long, last_ms long, last_id long")
    got = TT.collect_stream(out, "t_seq", os.path.join(scratch, "ck"))
    batch = P.strict_sequence(logins, ["user_id"], "t", "rid", F.col("fail"), 3, 86400)
    assert sorted((r["key"], r["first_id"], r["last_id"]) for r in got.collect()) == rows(batch, "user_id", "first_id", "last_id")


def test_one_to_one_join_stream(spark, scratch):
    lines = FMT.read_delimited(spark, os.path.join(DATA, "order_lines.txt"), "order_id long, product string, price double")
    places = FMT.read_delimited(spark, os.path.join(DATA, "order_places.txt"),
                                "order_id long, order_date string, address string")
    tagged = FMT.tagged_union([("left", lines), ("right", places)], tag="side")
    src = os.path.join(scratch, "src")
    tagged.coalesce(1).write.parquet(src)
    stream = H.read_files_stream(spark, src, tagged.schema, max_files_per_trigger=1)
    proc = ST.OneToOneJoin("side", ["product", "price"], ["order_date", "address"])
    out = ST.apply(stream, ["order_id"], proc, "key long, left string, right string")
    got = TT.collect_stream(out, "t_o2o", os.path.join(scratch, "ck"))
    assert got.count() == 5 and got.select("key").distinct().count() == 5


def test_map_with_state_initial_and_running_text(spark, scratch):
    schema = "word string, seq long"
    src = TT.stage_rows_as_batches(spark, [[("hadoop", 1), ("spark", 2)], [("flink", 3), ("hadoop", 4)]], schema,
                                  os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    # The initial state of the map-with-state sample.
    init = spark.createDataFrame([("hadoop", 100), ("flink", 20)], "word string, seq long").groupBy("word")
    out = ST.apply(stream, ["word"], ST.RunningValue("seq", "sum", order_col="seq", ttl_ms=30_000),
                   "key string, value string, order long", time_mode="ProcessingTime", initial_state=init)
    got = TT.collect_stream(out, "t_mws", os.path.join(scratch, "ck"), input_rows=4)
    last = {r["key"]: float(r["value"]) for r in got.orderBy("order").collect()}
    assert last == {"hadoop": 105.0, "spark": 2.0, "flink": 23.0}


def test_count_window_state(spark, scratch):
    schema = "k long, v long, seq long"
    # The keyed pairs sample.
    pairs = [(1, 3, 0), (1, 5, 1), (1, 7, 2), (2, 2, 3), (2, 4, 4), (2, 6, 5)]
    src = TT.stage_rows_as_batches(spark, [pairs[:2], pairs[2:4], pairs[4:]], schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    out = ST.apply(stream, ["k"], ST.CountWindow("v", 3, ttl_ms=10_000), "key long, cnt long, total double, mean double",
                   time_mode="ProcessingTime")
    got = TT.collect_stream(out, "t_cw", os.path.join(scratch, "ck"), input_rows=6)
    assert rows(got, "key", "mean") == [(1, 5.0), (2, 4.0)]


def test_running_count_update_mode_and_per_batch(spark, scratch):
    schema = "word string"
    src = TT.stage_rows_as_batches(spark, [[("a",), ("b",)], [("a",)], [("a",), ("b",)]], schema,
                                  os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    got = TT.collect_stream(SO.running_count(stream, ["word"]), "t_rc", os.path.join(scratch, "ck"), "update")
    assert max(r["cnt"] for r in got.filter("word = 'a'").collect()) == 3
    seen = []
    H.run_available_now(H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1), os.path.join(scratch, "ck2"),
                        foreach_batch=SO.per_batch_counts(["word"], lambda df, b: seen.extend(df.collect())))
    assert sorted((r["batch_id"], r["word"], r["cnt"]) for r in seen) == [
        (0, "a", 1), (0, "b", 1), (1, "a", 1), (2, "a", 1), (2, "b", 1)]


def test_buffered_sink_survives_restart(spark, scratch):
    schema = "word string, n long, seq long"
    # The buffered-sink sample, threshold 2.
    data = [[("Spark", 3, 0)], [("Hadoop", 5, 1), ("Hadoop", 7, 2)], [("Spark", 4, 3)]]
    src = os.path.join(scratch, "src")
    sink = SK.BufferedSink(2, "seq", os.path.join(scratch, "out"), os.path.join(scratch, "pending"))
    ck = os.path.join(scratch, "ck")
    for i, batch in enumerate(data):  # one run per batch: a restart between batches
        TT.stage_rows_as_batches(spark, [batch], schema, os.path.join(src, f"run{i}"))
        H.run_available_now(H.read_files_stream(spark, os.path.join(src, "*", "*"), schema, max_files_per_trigger=1), ck, foreach_batch=sink)
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert rows(out, "batch_id", "word") == [(1, "Hadoop"), (1, "Spark"), (2, "Hadoop"), (2, "Spark")]


def test_idempotent_sink_and_jdbc(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "word string, cnt long")
    w = SK.IdempotentBatchWriter(os.path.join(scratch, "out"), os.path.join(scratch, "ledger"))
    w(df, 0)
    w(df, 0)  # replay of the same batch
    w(df, 1)
    assert spark.read.parquet(os.path.join(scratch, "out")).count() == 4
    url = f"jdbc:derby:{scratch}/db;create=true"
    SK.jdbc_batch_writer(url, "wordcount")(df, 7)
    back = spark.read.jdbc(url, "wordcount")
    assert rows(back, "word", "cnt", "batch_id") == [("a", 1, 7), ("b", 2, 7)]


def test_block_list_and_dynamic_dimension(spark, scratch):
    schema = "word string, country string"
    src = os.path.join(scratch, "src")
    dim_path = os.path.join(scratch, "dim")
    spark.createDataFrame([("US", "america")], "country string, area string").write.mode("overwrite").parquet(dim_path)
    seen = []
    enrich = SO.dynamic_enrichment(lambda: spark.read.parquet(dim_path), "country", {"area": ""},
                                   lambda df, b: seen.extend(df.collect()))
    blocked = spark.createDataFrame([("?",), ("!",), ("&",)], "w string")
    ck = os.path.join(scratch, "ck")
    for i, (batch, dim) in enumerate([([("hi", "US"), ("?", "US")], None),
                                      ([("yo", "CN"), ("ok", "US")], [("US", "america"), ("CN", "asia")])]):
        if dim:  # the dimension changes between two runs
            spark.createDataFrame(dim, "country string, area string").write.mode("overwrite").parquet(dim_path)
        TT.stage_rows_as_batches(spark, [batch], schema, os.path.join(src, f"run{i}"))
        stream = SO.block_list_stream(H.read_files_stream(spark, os.path.join(src, "*", "*"), schema, max_files_per_trigger=1), "word", blocked, "w")
        H.run_available_now(stream, ck, foreach_batch=enrich)
    assert sorted((r["word"], r["area"]) for r in seen) == [("hi", "america"), ("ok", "america"), ("yo", "asia")]


def test_window_join_stream(spark, scratch):
    schema = "k long, ts timestamp, side string"
    base = dt.datetime(2024, 1, 1)
    data = [(1, base, "l"), (1, base + dt.timedelta(seconds=2), "r"), (2, base + dt.timedelta(seconds=1), "l"),
            (2, base + dt.timedelta(seconds=7), "r"), (3, base + dt.timedelta(seconds=100), "l")]
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.parquet(os.path.join(scratch, "src"))
    s = H.read_files_stream(spark, os.path.join(scratch, "src"), schema, max_files_per_trigger=1)
    left = SO.event_time(s.filter("side = 'l'").select("k", F.col("ts").alias("lt")), "lt", "5 seconds")
    right = SO.event_time(s.filter("side = 'r'").select("k", F.col("ts").alias("rt")), "rt", "5 seconds")
    got = TT.collect_stream(SO.window_join_stream(left, right, "k", "lt", "rt", "5 seconds"), "t_wj",
                           os.path.join(scratch, "ck"))
    assert [r["k"] for r in got.collect()] == [1]


def test_text_object_sequence_and_partitioned_sinks(spark, scratch):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    FMT.write_text(o, os.path.join(scratch, "txt"), ["o_orderkey", "o_orderstatus"])
    FMT.write_text(o, os.path.join(scratch, "txt"), ["o_orderkey", "o_orderstatus"])  # overwrite, not append
    assert spark.read.text(os.path.join(scratch, "txt")).count() == o.count()
    FMT.write_objects(o, os.path.join(scratch, "obj"))
    assert rows(spark.read.parquet(os.path.join(scratch, "obj"))) == rows(o)
    FMT.write_sequence_file(o, os.path.join(scratch, "seq"), "o_orderkey", "o_orderstatus")
    assert FMT.read_sequence_file(spark, os.path.join(scratch, "seq")).count() == o.count()
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    FMT.write_dt_hour(ev, "ts", os.path.join(scratch, "dh"))
    back = spark.read.parquet(os.path.join(scratch, "dh"))
    assert back.count() == ev.count() and {"dt", "hour"} <= set(back.columns)
    acc = spark.sparkContext.accumulator(0)

    def count_part(it):
        for _ in it:
            acc.add(1)
    FMT.for_each_partition(o, count_part)
    assert acc.value == o.count()


def test_parsers(spark, scratch):
    log = os.path.join(scratch, "access.log")
    with open(log, "w") as f:
        f.write("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash\n")
        f.write("10.0.0.1 bob - 17/05/2015:10:05:43 +0000 POST /login\n")
    parsed = FMT.parse_access_log(FMT.read_text(spark, log))
    got = parsed.orderBy("ts").collect()
    assert got[0]["ip"] == "83.149.9.216" and got[1]["method"] == "POST" and got[1]["url"] == "/login"
    js = os.path.join(scratch, "events.json")
    with open(js, "w") as f:
        f.write('{"dt":"2019-11-11 10:11:12","countryCode":"US","data":[{"type":"s1","score":0.3,"level":"A"},'
                '{"type":"s2","score":0.5,"level":"B"}]}\n')
        f.write('{"dt":"2019-11-11 10:11:13","countryCode":"XX","data":[{"type":"s3","score":0.1,"level":"C"}]}\n')
    schema = "dt string, countryCode string, data array<struct<type:string,score:double,level:string>>"
    recs = FMT.parse_json_lines(FMT.read_text(spark, js), schema)
    flat = recs.select("dt", "countryCode", F.inline("data"))
    areas = spark.createDataFrame([("america", "US,CA")], "area string, countries string")
    from tidemill.functions.scalar import invert_csv_map
    inv = invert_csv_map(areas, "area", "countries", "countryCode", "area")
    from tidemill.operators.joins import lookup_enrich
    out = lookup_enrich(flat, inv, "countryCode", default={"area": ""})
    assert sorted((r["type"], r["area"]) for r in out.collect()) == [("s1", "america"), ("s2", "america"), ("s3", "")]


def test_retry_round(spark):
    pending = spark.createDataFrame([(1, 0), (2, 4), (3, 5)], "k long, retry_count long")
    ctx = spark.createDataFrame([(1,)], "k long")
    emitted, again = SK.retry_round(pending, ctx, ["k"], max_retries=5)
    assert rows(emitted, "k", "matched", "retry_count") == [(1, True, 0), (3, False, 5)]
    assert rows(again, "k", "retry_count") == [(2, 5)]


def test_top_n_from_list_state_and_timer(spark, scratch):
    schema = "window_end long, item string, cnt long, t timestamp"
    at = lambda s: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
    batches = [[(100, "a", 3, at(100)), (100, "b", 5, at(100)), (200, "x", 1, at(200))],
               [(100, "c", 1, at(100)), (100, "d", 5, at(100))],
               [(10 ** 9, "flush", 1, at(10 ** 9))], [(10 ** 9 + 1, "flush", 1, at(10 ** 9 + 1))]]
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1).withWatermark("t", "0 seconds")
    out = ST.apply(stream, ["window_end"], ST.TopNPerWindow(2), "window_end long, item string, cnt long, rn long",
                   time_mode="EventTime")
    got = TT.collect_stream(out, "t_topn", os.path.join(scratch, "ck"))
    assert [r for r in rows(got) if r[0] < 10 ** 9] == [(100, "b", 5, 1), (100, "d", 5, 2), (200, "x", 1, 1)]
