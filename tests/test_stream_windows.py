"""Triggers, lateness, timers and the one-to-one join on streams: fixed rows, and stream against batch query."""

import datetime as dt
import os
import time
from decimal import Decimal

from pyspark.sql import functions as F

import stream_tools as TT
from common import SF_SMALL, rows
from tidemill.plans import registry
from tidemill.streaming import harness as H
from tidemill.streaming import windowed as WD

BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def staged(spark, scratch, batches, schema, name="src"):
    src = TT.stage_rows_as_batches(spark, batches, schema, os.path.join(scratch, name))
    return H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)


def events(spark, scratch, n=4, where=None):
    """The events of sf0.001 in event-time order as ``n`` micro-batches."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ev = ev.where(where) if where is not None else ev
    src = os.path.join(scratch, "src")
    TT.stage_batches(ev, "ts", n, src)
    return ev, src, H.read_files_stream(spark, os.path.join(src, "*"), ev.schema, max_files_per_trigger=1)


# ---- J20, J21

def lateness(spark, scratch, batches, name):
    """10 s windows, 2 s disorder allowed, 5 s lateness."""
    stream = staged(spark, scratch, batches, "k string, ts timestamp, v double")
    out = WD.windows_with_lateness(stream, ["k"], "ts", "v", 10, 2, 5)
    q = H.run_available_now(out, os.path.join(scratch, "ck"), sink="memory", query_name=name)
    sec = int((BASE - dt.datetime(1970, 1, 1)).total_seconds())
    got = sorted((r["k"], r["window_start"] - sec, r["kind"], r["cnt"], r["total"], r["firing"]) for r in spark.table(name).collect())
    dropped = sum(int(op["numRowsDroppedByWatermark"]) for p in q.recentProgress for op in p["stateOperators"])
    return got, dropped


def test_late_rows_correct_a_fired_window(spark, scratch):
    got, dropped = lateness(spark, scratch, [
        [("a", at(1), 1.0), ("a", at(9), 2.0), ("b", at(3), 5.0)],
        [("a", at(12), 4.0)],             # nominal watermark 10: windows [0, 10) fire
        [("a", at(5), 8.0)],              # late by less than 5 s: a second, corrected row
        [("a", at(2), 16.0), ("a", at(14), 1.0)],  # and a third
        [("c", at(4), 1.0)],              # first row of its window, late: fires at once
        [("a", at(17), 1.0)],             # watermark 15: lateness of [0, 10) is over
        [("a", at(9), 64.0)],             # too late for the window
        [("a", at(60), 0.0)], [("a", at(60), 0.0)]], "t_late")
    assert [r for r in got if r[1] == 0] == [("a", 0, "dropped", 1, 64.0, 0), ("a", 0, "fired", 2, 3.0, 1), ("a", 0, "fired", 3, 11.0, 2),
                                             ("a", 0, "fired", 4, 27.0, 3), ("b", 0, "fired", 1, 5.0, 1), ("c", 0, "fired", 1, 1.0, 1)]
    assert [r for r in got if r[1] == 10] == [("a", 10, "fired", 3, 6.0, 1)]
    assert dropped == 0


def test_rows_past_all_lateness_are_dropped_and_counted(spark, scratch):
    got, dropped = lateness(spark, scratch, [
        [("a", at(100), 1.0)], [("a", at(100), 1.0)],  # Spark's watermark is now 100 - 17
        [("a", at(1), 1.0), ("b", at(50), 1.0), ("a", at(99), 1.0)], [("a", at(300), 0.0)], [("a", at(300), 0.0)]], "t_far")
    assert dropped == 2
    assert [r for r in got if r[1] < 200] == [("a", 90, "fired", 1, 1.0, 1), ("a", 100, "fired", 2, 2.0, 1)]


def test_lateness_state_goes_and_survives_a_restart(spark, scratch):
    schema, src, ck = "k string, ts timestamp, v double", os.path.join(scratch, "src"), os.path.join(scratch, "ck")
    out = os.path.join(scratch, "out")
    for i, batch in enumerate([[("a", at(1), 1.0)], [("a", at(12), 1.0)], [("a", at(5), 1.0)], [("a", at(90), 1.0)], [("a", at(90), 1.0)]]):
        TT.stage_rows_as_batches(spark, [batch], schema, os.path.join(src, f"run{i}"))  # one run for each batch
        stream = H.read_files_stream(spark, os.path.join(src, "*", "*"), schema, max_files_per_trigger=1)
        H.run_available_now(WD.windows_with_lateness(stream, ["k"], "ts", "v", 10, 2, 5), ck, path=out)
        if i == 1:
            assert WD.state_rows(spark, ck, "windows").count() == 2
    got = spark.read.parquet(out).where("kind = 'fired'")
    assert rows(got.select("cnt", "firing")) == [(1, 1), (1, 1), (2, 2)]
    assert WD.state_rows(spark, ck, "windows").count() == 1  # the last window alone


# ---- J10, J11, J22

def batch_rows(spark, name, *cols):
    return rows(registry.QUERIES[name].fn(spark, SF_SMALL), *cols)


def test_accumulating_trigger_across_restarts(spark, scratch):
    _, src, _ = events(spark, scratch)
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")
    schema = spark.read.parquet(os.path.join(src, "batch-00000")).schema
    for i in range(4):  # a run for each slice
        stream = H.read_files_stream(spark, os.path.join(src, f"batch-0000[0-{i}]"), schema)
        H.run_available_now(WD.accumulating_trigger_stream(stream, ["user_id"], ["ts", "event_id"], "value", 3), ck, path=out)
    got = spark.read.parquet(out).select("user_id", F.col("seq").cast("int").alias("seq"), F.round("total", 2).alias("total"))
    assert rows(got) == batch_rows(spark, "j10_accumulating_trigger", "user_id", "seq", "total")


def test_sliding_count_window_keeps_size_values_a_key(spark, scratch):
    ev, _, stream = events(spark, scratch)
    ck = os.path.join(scratch, "ck")
    out = WD.sliding_count_window_stream(stream, ["user_id"], ["ts", "event_id"], "value", 10, 5)
    got = TT.collect_stream(out, "t_ring", ck).select("user_id", F.col("seq").cast("int").alias("seq"), F.round("total", 2).alias("total"), "n_rows")
    assert rows(got) == batch_rows(spark, "j11_sliding_count_window", "user_id", "seq", "total", "n_rows")
    slots = WD.state_rows(spark, ck, "ring").groupBy("key").count()
    most = ev.groupBy("user_id").count().select(F.max("count")).first()[0]
    assert most > 10 and slots.agg(F.max("count")).first()[0] == 10


def test_fire_on_every_element(spark, scratch):
    _, _, stream = events(spark, scratch, where="event_type = 'view'")
    ck = os.path.join(scratch, "ck")
    out = WD.running_distinct_stream(stream.withWatermark("ts", "1 day"), "ts", "event_id", "user_id", 86400)
    got = TT.collect_stream(out, "t_every", ck)
    assert rows(got, "event_id", "window_start", "running") == batch_rows(spark, "j22_fire_every_element", "event_id", "window_start", "running_uv")
    # state of windows that the watermark has passed is gone
    left = WD.state_rows(spark, ck, "users", operator=0)
    assert left.count() < got.select("window_start").distinct().count()


# ---- J17, K02, K08

def now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def test_wall_clock_windows_close_without_new_rows(spark, scratch):
    for delay in (0, 5):
        t = now()
        old, fresh = t - dt.timedelta(seconds=600), t + dt.timedelta(seconds=2)
        stream = staged(spark, scratch, [[("a", old, 1.0), ("a", fresh, 2.0), ("a", fresh, 3.0)]], "k string, ts timestamp, v double", f"src{delay}")
        out = WD.wall_clock_windows(stream, ["k"], "ts", "v", 2, delay)
        got, _ = TT.run_until(out, f"t_wall{delay}", os.path.join(scratch, f"ck{delay}"), lambda g: any(r["kind"] == "fired" for r in g))
        ended = time.time()
        assert sorted((r["kind"], r["cnt"], r["total"]) for r in got) == [("fired", 2, 5.0), ("late", 1, 1.0)]
        fired = next(r for r in got if r["kind"] == "fired")
        assert ended >= fired["window_end"] + delay


def test_idle_key_reports_once_and_state_is_a_table(spark, scratch):
    ck = os.path.join(scratch, "ck")
    schema = "word string, n long"
    src = TT.stage_rows_as_batches(spark, [[("a", 1), ("a", 2), ("b", 5)]], schema, os.path.join(scratch, "src"))
    stream = H.read_files_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    got, _ = TT.run_until(WD.map_with_timeout(stream, ["word"], "n", 3600), "t_idle0", ck, lambda g: len(g) == 3)
    snapshot = WD.state_rows(spark, ck, "running")  # of the stopped query
    assert sorted((r["key"]["word"], r["value"]["total"], r["value"]["cnt"]) for r in snapshot.collect()) == [("a", 3.0, 2), ("b", 5.0, 1)]
    ended = []

    def over(g):
        if sum(r["timed_out"] for r in g) >= 2:
            ended.append(time.time())
        return len(ended) > 8  # a while longer: nothing comes twice
    got, _ = TT.run_until(WD.map_with_timeout(stream, ["word"], "n", 2), "t_idle", os.path.join(scratch, "ck2"), over)
    assert sorted((r["word"], r["total"], r["cnt"], r["timed_out"]) for r in got) == [
        ("a", 1.0, 1, False), ("a", 3.0, 2, False), ("a", 3.0, 2, True), ("b", 5.0, 1, False), ("b", 5.0, 1, True)]


def test_processing_time_timer_rearms(spark, scratch):
    stream = staged(spark, scratch, [[("a",), ("a",), ("b",)]], "word string")
    got, _ = TT.run_until(WD.heartbeat(stream, ["word"], 1, idle=3), "t_beat", os.path.join(scratch, "ck"), lambda g: len(g) >= 6)
    assert sorted(tuple(r) for r in got) == [("a", 1, 2), ("a", 2, 2), ("a", 3, 2), ("b", 1, 1), ("b", 2, 1), ("b", 3, 1)]


# ---- C12

def test_one_to_one_join_keeps_types_and_reports_unmatched_once(spark, scratch):
    left = "id long, ts timestamp, product string, price decimal(10,2), day date"
    right = "id long, ts timestamp, address string, tags array<string>"
    day = dt.date(2024, 2, 29)
    ls = [[(1, at(1), "tea, green", Decimal("12.30"), day), (2, at(2), None, Decimal("0.01"), None), (4, at(3), "first", None, None)],
          [(4, at(4), "second", Decimal("1.00"), day), (5, at(6), "late partner", None, None), (None, at(5), "no key", None, None)],
          [(9, at(200), "flush", None, None)], [(9, at(201), "flush", None, None)]]
    rs = [[(1, at(2), "12, Main St", ["a,b", "c"])], [(4, at(5), "x", None), (3, at(5), "alone", [])], [(5, at(8), "y", None)], [(8, at(201), "z", None)]]
    a = staged(spark, scratch, ls, left, "left")
    b = staged(spark, scratch, rs, right, "right")
    out = WD.one_to_one_join(a, b, ["id"], "ts", 1, 30)
    got = [r for r in TT.collect_stream(out, "t_pairs", os.path.join(scratch, "ck")).collect() if r["id"] < 8]
    by = {(r["id"], r["kind"]): r for r in got}
    assert len(by) == len(got) and sorted(by) == [(1, "match"), (2, "left_only"), (3, "right_only"), (4, "left_only"), (4, "match"), (5, "match")]
    one = by[(1, "match")]
    assert tuple(one["left"]) == (at(1), "tea, green", Decimal("12.30"), day) and tuple(one["right"]) == (at(2), "12, Main St", ["a,b", "c"])
    assert by[(2, "left_only")]["left"]["price"] == Decimal("0.01") and by[(2, "left_only")]["right"] is None
    assert by[(4, "left_only")]["left"]["product"] == "first" and by[(4, "match")]["left"]["product"] == "second"
