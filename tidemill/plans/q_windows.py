"""Queries for survey 2.10 (windows in batch form) and 2.11 (keyed state
in batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.scalar import int_div
from tidemill.functions.time import epoch_seconds
from tidemill.operators import patterns as P
from tidemill.operators import windows as W
from tidemill.plans.registry import query
from tidemill.sources.tables import events_with_item, load

EV_ORDER = ["ts", "event_id"]


def _hour(col="ts", size=3600):
    return f"CAST(floor(epoch({col}) / {size}) AS BIGINT) * {size}"


@query("j01_running_count", "J01", oracle="""
SELECT event_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_count
FROM events
""")
def j01_running_count(spark, sf):
    """Running count per user, one update per event (split by day)."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts")
    out = P.running_total_bucketed(ev, ["user_id"], "ts", "event_id", out="running_count")
    return out.select("event_id", "user_id", "running_count")


@query("j03_tumbling_keyed", "J03", oracle=f"""
SELECT {_hour()} AS window_start, event_type, count(*) AS cnt, {_hour()} + 3600 AS window_end
FROM events GROUP BY 1, 2
""")
def j03_tumbling_keyed(spark, sf):
    return W.tumbling_agg(load(spark, sf, "events"), "ts", 3600, keys=["event_type"])


@query("j04_tumbling_all", "J04", oracle=f"""
SELECT {_hour(size=86400)} AS window_start, count(*) AS cnt, {_hour(size=86400)} + 86400 AS window_end
FROM events GROUP BY 1
""")
def j04_tumbling_all(spark, sf):
    return W.tumbling_agg(load(spark, sf, "events"), "ts", 86400)


@query("j05_sliding", "J05", oracle="""
WITH s AS (SELECT CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS slice, event_type FROM events)
SELECT slice - 1800 * i AS window_start, event_type, count(*) AS cnt, slice - 1800 * i + 7200 AS window_end
FROM s, (SELECT range AS i FROM range(4)) t GROUP BY 1, 2, 4
""")
def j05_sliding(spark, sf):
    """2 h windows sliding 30 min, per event type."""
    return W.sliding_counts(load(spark, sf, "events"), "ts", 7200, 1800, keys=["event_type"])


@query("j05_gapped_sliding", "J05", oracle="""
SELECT CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS window_start, count(*) AS cnt,
       CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 + 600 AS window_end
FROM events WHERE floor(epoch(ts)) - CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 < 600 GROUP BY 1, 3
""")
def j05_gapped_sliding(spark, sf):
    """10 min windows every 30 min: rows in the gaps belong to no window."""
    return W.sliding_counts(load(spark, sf, "events"), "ts", 600, 1800)


@query("j06_sliding_sum", "J06 J12", oracle="""
WITH s AS (SELECT CAST(floor(epoch(ts) / 120) AS BIGINT) * 120 AS last, floor(epoch(ts)) AS sec, event_type, value
           FROM events)
SELECT last - 120 * i AS window_start, event_type, round(sum(value), 2) AS total, count(*) AS cnt,
       last - 120 * i + 240 AS window_end
FROM s, (SELECT range AS i FROM range(2)) t WHERE sec < last - 120 * i + 240 GROUP BY 1, 2, 5
""")
def j06_sliding_sum(spark, sf):
    """4 min windows every 2 min: value sum and count per event type
    (rows copied into their windows, any aggregate)."""
    out = W.sliding_agg(load(spark, sf, "events"), "ts", 240, 120, keys=["event_type"],
                        aggs=[F.sum("value").alias("total"), F.count(F.lit(1)).alias("cnt")])
    return out.withColumn("total", F.round("total", 2))


SESSION_SQL = """
WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))
                                   < 3600000000 THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, count(*) AS cnt, CAST(floor(epoch(min(ts))) AS BIGINT) AS session_start,
       CAST(floor(epoch(max(ts) + INTERVAL 1 HOUR)) AS BIGINT) AS session_end
FROM s GROUP BY user_id, sid
"""


@query("j07_session_window", "J07", oracle=SESSION_SQL)
def j07_session_window(spark, sf):
    """Sessions per user closing after 1 h without events."""
    ev = load(spark, sf, "events")
    return W.session_counts_by_block(ev, "ts", 3600, ["user_id"])


@query("j09_count_window", "J09", oracle="""
SELECT user_id, CAST((rn - 1) // 5 AS BIGINT) AS group_no, count(*) AS cnt, round(sum(value), 2) AS total FROM (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING count(*) = 5
""")
def j09_count_window(spark, sf):
    """Every 5 events of a user fire once with their value sum."""
    out = W.count_window(load(spark, sf, "events"), ["user_id"], EV_ORDER, 5,
                         aggs=[F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("total")], time_bucket_s=86400)
    return out.withColumn("total", F.round("total", 2))


@query("j10_accumulating_trigger", "J10", oracle="""
SELECT user_id, CAST(seq AS INTEGER) AS seq, round(total, 2) AS total FROM (
  SELECT user_id, row_number() OVER w AS seq, sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS total
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE seq % 3 = 0
""")
def j10_accumulating_trigger(spark, sf):
    out = W.accumulating_count_trigger(load(spark, sf, "events"), ["user_id"], EV_ORDER, 3, "value",
                                       time_bucket_s=86400)
    return out.select("user_id", "seq", F.round("total", 2).alias("total"))


@query("j11_sliding_count_window", "J11", oracle="""
SELECT user_id, CAST(seq AS INTEGER) AS seq, round(total, 2) AS total, n_rows FROM (
  SELECT user_id, row_number() OVER w AS seq, sum(value) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS total,
         count(*) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n_rows
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE seq % 5 = 0
""")
def j11_sliding_count_window(spark, sf):
    """Every 5 events of a user, the sum over its last 10."""
    out = W.sliding_count_window(load(spark, sf, "events"), ["user_id"], EV_ORDER, 10, 5, "value",
                                 time_bucket_s=86400)
    return out.select("user_id", "seq", F.round("total", 2).alias("total"), "n_rows")


@query("j12_incremental_reduce", "J12 N02", oracle=f"""
SELECT {_hour()} AS window_start, max(value) AS max_value, min(value) AS min_value FROM events GROUP BY 1
""")
def j12_incremental_reduce(spark, sf):
    out = W.tumbling_agg(load(spark, sf, "events"), "ts", 3600,
                         aggs=[F.max("value").alias("max_value"), F.min("value").alias("min_value")])
    return out.drop("window_end")


@query("j13_integer_mean", "J13", oracle=f"""
SELECT {_hour()} AS window_start, CAST(sum(user_id) // count(user_id) AS DOUBLE) AS mean FROM events GROUP BY 1
""")
def j13_integer_mean(spark, sf):
    """(count, sum) accumulator, integer-divided mean cast to double."""
    out = W.tumbling_agg(load(spark, sf, "events"), "ts", 3600,
                         aggs=[F.sum("user_id").alias("s"), F.count("user_id").alias("n")])
    return out.select("window_start", int_div(F.col("s"), F.col("n")).cast("double").alias("mean"))


@query("j14_full_window", "J14 N03", oracle=f"""
SELECT event_id, {_hour()} AS window_start,
       CAST(row_number() OVER (PARTITION BY {_hour()} ORDER BY value, event_id) AS INTEGER) AS pos,
       count(*) OVER (PARTITION BY {_hour()}) AS n
FROM events
""")
def j14_full_window(spark, sf):
    """All rows of each 1 h window seen together: position in the window's
    sorted order and window size.  Positions come from the parallel global
    rank over (window, value, id) minus the window's first rank, so even a
    hot window is never sorted by one task."""
    from tidemill.operators.ranking import global_rank
    ev = load(spark, sf, "events").select("event_id", "ts", "value")
    sec = epoch_seconds("ts")
    ev = ev.withColumn("window_start", sec - F.pmod(sec, F.lit(3600)))
    ranked = global_rank(ev, ["window_start", "value", "event_id"], rank_col="_r")
    per = ranked.groupBy("window_start").agg(F.min("_r").alias("_first"), F.count(F.lit(1)).alias("n"))
    out = ranked.join(per, "window_start")
    return out.select("event_id", "window_start", (F.col("_r") - F.col("_first") + 1).cast("int").alias("pos"), "n")


@query("j22_fire_every_element", "J22", oracle="""
WITH v AS (SELECT event_id, user_id, ts, CAST(floor(epoch(ts) / 86400) AS BIGINT) * 86400 AS window_start
           FROM events WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_start, user_id ORDER BY ts, event_id) = 1
                     THEN 1 ELSE 0 END AS first_seen FROM v)
SELECT event_id, window_start,
       CAST(sum(first_seen) OVER (PARTITION BY window_start ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
       AS running_uv
FROM f
""")
def j22_fire_every_element(spark, sf):
    """Unique visitors per day window, emitted after every view.

    A view counts when it is its user's first in the day: the first
    (ts, event_id) per (day, user) comes from an aggregate, and the running
    count per day is split by hour, so neither a hot user nor a hot day is
    handled by one task."""
    ev = load(spark, sf, "events").filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    sec = epoch_seconds("ts")
    ev = ev.withColumn("window_start", sec - F.pmod(sec, F.lit(86400)))
    firsts = (ev.groupBy("window_start", "user_id").agg(F.min(F.struct("ts", "event_id")).alias("_f"))
                .select(F.col("_f.event_id").alias("event_id"), F.lit(1).cast("long").alias("first_seen")))
    flagged = ev.join(firsts, "event_id", "left").fillna(0, ["first_seen"])
    out = P.running_total_bucketed(flagged, ["window_start"], "ts", "event_id", value="first_seen", bucket_s=3600,
                                   out="running_uv")
    return out.select("event_id", "window_start", "running_uv")


# ---- 2.11 keyed state, batch forms ----------------------------------------------------

@query("k03_mean_of_three", "K03", oracle="""
SELECT user_id, CAST((rn - 1) // 3 AS BIGINT) AS group_no, round(avg(value), 4) AS mean FROM (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING count(*) = 3
""")
def k03_mean_of_three(spark, sf):
    """Value state: the mean of every 3 values of a key, then reset."""
    out = W.count_window(load(spark, sf, "events"), ["user_id"], EV_ORDER, 3, aggs=[F.avg("value").alias("mean")],
                         time_bucket_s=86400)
    return out.withColumn("mean", F.round("mean", 4))


@query("k04_reducing_state", "K04", oracle="""
SELECT event_id, user_id,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running_total
FROM events
""")
def k04_reducing_state(spark, sf):
    """Running sum of values per user, one output per event (split by day)."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = P.running_total_bucketed(ev, ["user_id"], "ts", "event_id", value="value")
    return out.select("event_id", "user_id", F.round("running_total", 2).alias("running_total"))


LI_ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("k05_aggregating_state", "K05", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       'content: ' || string_agg(l_returnflag, ' and ') OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS text
FROM lineitem
""")
def k05_aggregating_state(spark, sf):
    """Running text of an order's return flags, in line order."""
    li = load(spark, sf, "lineitem")
    out = P.running_text(li, ["l_orderkey"], LI_ROW[1:], "l_returnflag")
    return out.select(*LI_ROW, "text")


def _cap_sql(cap):
    return f"""
SELECT event_id, user_id, k, day, CASE WHEN rn <= {cap} THEN 'pass' ELSE 'alert' END AS kind FROM (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(floor(epoch(ts) / 86400) AS BIGINT) * 86400 AS day,
         row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k'),
                            CAST(floor(epoch(ts) / 86400) AS BIGINT) ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type = 'click')
WHERE rn <= {cap} + 1
"""


def click_cap(spark, sf, cap):
    clicks = events_with_item(spark, sf).filter(F.col("event_type") == "click")
    out = P.daily_cap(clicks, ["user_id", "k"], "ts", "event_id", cap=cap)
    return out.select("event_id", "user_id", "k", "day", "kind")


query("k10_daily_cap", "K10 K09", oracle=_cap_sql(100))(lambda spark, sf: click_cap(spark, sf, 100))
query("k10_daily_cap_of_one", "K10 K09", oracle=_cap_sql(1))(lambda spark, sf: click_cap(spark, sf, 1))


LOGIN_FAIL_SQL = """
SELECT user_id, first_ts, first_id, last_ts, last_id FROM (
  SELECT user_id, ts AS first_ts, event_id AS first_id, event_type = 'error' AS h0,
         lead(event_type = 'error', 1) OVER w AS h1, lead(event_type = 'error', 2) OVER w AS h2,
         lead(ts, 2) OVER w AS last_ts, lead(event_id, 2) OVER w AS last_id
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE h0 AND h1 AND h2 AND epoch_us(last_ts) - epoch_us(first_ts) < 86400000000
"""


@query("k11_sequence_pattern", "K11 M08", oracle=LOGIN_FAIL_SQL)
def k11_sequence_pattern(spark, sf):
    """Three adjacent failures (error events) of a user within one day."""
    ev = load(spark, sf, "events")
    return P.strict_sequence(ev, ["user_id"], "ts", "event_id", F.col("event_type") == "error",
                             length=3, within_s=86400)


@query("k11_sequence_unkeyed", "K11", oracle="""
SELECT user_id, first_ts, first_id, last_ts, last_id FROM (
  SELECT user_id, ts AS first_ts, event_id AS first_id, event_type = 'error' AS h0,
         lead(event_type = 'error', 1) OVER w AS h1, lead(event_type = 'error', 2) OVER w AS h2,
         lead(ts, 2) OVER w AS last_ts, lead(event_id, 2) OVER w AS last_id
  FROM events WINDOW w AS (ORDER BY ts, event_id))
WHERE h0 AND h1 AND h2 AND epoch_us(last_ts) - epoch_us(first_ts) < 3600000000
""")
def k11_sequence_unkeyed(spark, sf):
    """The source's un-keyed pattern: three adjacent failures in the global
    event order within one hour (user of the first failure reported)."""
    ev = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    out = P.strict_sequence_unkeyed(ev, "ts", "event_id", F.col("event_type") == "error", length=3, within_s=3600)
    return out.select("user_id", "first_ts", "first_id", "last_ts", "last_id")
