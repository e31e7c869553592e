"""Queries for survey 2.3 (joins) and 2.4 (aggregations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.operators import joins as J
from tidemill.operators import windows as W
from tidemill.plans.registry import query
from tidemill.sources.tables import events_with_item, load

K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


# ---- 2.3 joins ----------------------------------------------------------------

@query("c01_inner_join", "C01", oracle="""
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
""")
def c01_inner_join(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return J.join(o, c, "o_custkey").select("o_orderkey", "c_name", "o_totalprice")


@query("c02_left_outer_join", "C02", oracle="""
SELECT c_custkey, coalesce(CAST(o_orderkey AS VARCHAR), 'null') AS o_orderkey
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def c02_left_outer_join(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey")
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return J.null_as_text(J.join(c, o, "c_custkey", "left"), ["o_orderkey"])


@query("c03_right_outer_join", "C03", oracle="""
SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey
""")
def c03_right_outer_join(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = load(spark, sf, "customer").select("c_custkey")
    return J.join(o, c, "c_custkey", "right").select("c_custkey", "o_orderkey")


@query("c04_full_outer_join", "C04", oracle="""
SELECT c_custkey, c_name, n_orders
FROM customer FULL JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
USING (c_custkey)
""")
def c04_full_outer_join(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    per = (load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.count(F.lit(1)).alias("n_orders")))
    return J.join(c, per, "c_custkey", "full")


@query("c05_cross_with_small", "C05", oracle="""
SELECT s_suppkey, r_name FROM supplier CROSS JOIN region
""")
def c05_cross_with_small(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey")
    r = load(spark, sf, "region").select("r_name")
    return J.cross_with_small(s, r)


@query("c06_cogroup", "C06", oracle="""
WITH u AS (SELECT o_orderkey AS key, 0 AS side, o_orderstatus AS v FROM orders
           UNION ALL SELECT l_orderkey, 1, CAST(l_linenumber AS VARCHAR) FROM lineitem)
SELECT key,
       coalesce(array_to_string(list_sort(list(v) FILTER (WHERE side = 0)), ','), '') AS values_0,
       coalesce(array_to_string(list_sort(list(v) FILTER (WHERE side = 1)), ','), '') AS values_1
FROM u GROUP BY key
""")
def c06_cogroup(spark, sf):
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    g = J.cogroup_lists([(o, "o_orderkey", F.col("o_orderstatus")),
                         (li, "l_orderkey", F.col("l_linenumber").cast("string"))])
    return g.select("key", F.array_join("values_0", ",").alias("values_0"),
                    F.array_join("values_1", ",").alias("values_1"))


@query("c07_subtract_by_key", "C07", oracle="""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def c07_subtract_by_key(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.subtract_by_key(c, o, "c_custkey")


@query("c08_block_list_filter", "C08", oracle="""
SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')
""")
def c08_block_list_filter(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type")
    blocked = spark.createDataFrame([("error",), ("signup",)], "word string")
    return J.block_list_filter(ev, "event_type", blocked, "word")


@query("c09_broadcast_lookup", "C09", oracle="""
SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def c09_broadcast_lookup(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = load(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.lookup_enrich(s, n, "n_nationkey").select("s_suppkey", "n_name")


@query("c10_area_enrichment", "C10 H07", oracle="""
SELECT c_custkey, n_name AS country, coalesce(r_name, '') AS area
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def c10_area_enrichment(spark, sf):
    """Country to area through a small dimension; a missing area is ""."""
    n = load(spark, sf, "nation")
    r = load(spark, sf, "region")
    dim = (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"),
                    F.col("r_name").alias("area")))
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    out = J.lookup_enrich(c, dim, "c_nationkey", default={"area": ""})
    return out.select("c_custkey", "country", "area")


@query("c11_window_join", "C11", oracle="""
WITH c AS (SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, count(*) AS n_left
           FROM events WHERE event_type = 'click' GROUP BY 1, 2),
     p AS (SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, count(*) AS n_right
           FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT user_id, window_start, n_left, n_right, n_left * n_right AS n_pairs FROM c JOIN p USING (user_id, window_start)
""")
def c11_window_join(spark, sf):
    """Clicks and purchases of a user in the same 1 h window: pair counts."""
    ev = load(spark, sf, "events").select("user_id", "ts", "event_type")
    clicks = ev.filter(F.col("event_type") == "click")
    buys = ev.filter(F.col("event_type") == "purchase")
    return J.window_join_counts(clicks, buys, "user_id", "ts", "ts", 3600)


CONTEXT_JOIN_SQL = f"""
WITH e AS (SELECT event_id, user_id, {K_SQL} AS k, ts, event_type FROM events),
u AS (
  SELECT user_id, k, ts, 0 AS side, event_id AS srv_id, ts AS srv_ts, NULL AS event_id, NULL AS event_type
  FROM e WHERE event_type = 'view'
  UNION ALL
  SELECT user_id, k, ts, 1, NULL, NULL, event_id, event_type FROM e WHERE event_type IN ('click', 'purchase')),
x AS (
  SELECT *, last_value(srv_id IGNORE NULLS) OVER w AS cid, last_value(srv_ts IGNORE NULLS) OVER w AS cts
  FROM u WINDOW w AS (PARTITION BY user_id, k ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, k, event_type, ts,
       CASE WHEN floor(epoch(ts)) - floor(epoch(cts)) <= 3600 THEN cid END AS ctx_event_id,
       CASE WHEN floor(epoch(ts)) - floor(epoch(cts)) <= 3600 THEN cts END AS ctx_ts
FROM x WHERE side = 1
"""


def context_join(spark, sf):
    """Client events (click, purchase) enriched with the latest server
    context (a view of the same user and item) at most 1 h older."""
    ev = events_with_item(spark, sf).select("event_id", "user_id", "k", "ts", "event_type")
    server = ev.filter(F.col("event_type") == "view").select("user_id", "k", "ts", "event_id")
    client = ev.filter(F.col("event_type").isin("click", "purchase"))
    return J.asof_context_join(client, server, ["user_id", "k"], "ts", 3600, carry=["event_id"])


@query("c13_context_join", "C13", oracle=f"""
SELECT event_id, ctx_event_id FROM ({CONTEXT_JOIN_SQL})
""")
def c13_context_join(spark, sf):
    return context_join(spark, sf).select("event_id", "ctx_event_id")


# ---- 2.4 aggregations -------------------------------------------------------------

@query("d01_reduce_by_key", "D01", oracle="""
SELECT l_suppkey, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY 1
""")
def d01_reduce_by_key(spark, sf):
    return A.reduce_by_key(load(spark, sf, "lineitem"), "l_suppkey", "l_quantity", out="sum_qty")


@query("d02_group_by_function", "D02", oracle="""
SELECT concat(CAST(o_custkey AS VARCHAR), '-', CAST(year(o_orderdate) AS VARCHAR)) AS key,
       array_to_string(list_sort(list(o_orderkey)), ',') AS "values"
FROM orders GROUP BY 1
""")
def d02_group_by_function(spark, sf):
    o = load(spark, sf, "orders")
    f = F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.year("o_orderdate").cast("string"))
    return A.group_values(o, f, "o_orderkey", sep=",")


@query("d03_group_by_key", "D03", oracle="""
SELECT l_orderkey AS key, string_agg(CAST(l_linenumber AS VARCHAR), '-' ORDER BY l_linenumber) AS "values"
FROM lineitem GROUP BY 1
""")
def d03_group_by_key(spark, sf):
    return A.group_values(load(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", order="l_linenumber", sep="-")


@query("d04_aggregate_by_key", "D04", oracle="""
SELECT l_suppkey, sum(p) AS result FROM (
  SELECT l_suppkey, l_orderkey % 4 AS b, greatest(30.0, max(l_quantity)) AS p FROM lineitem GROUP BY 1, 2)
GROUP BY 1
""")
def d04_aggregate_by_key(spark, sf):
    li = load(spark, sf, "lineitem")
    return A.aggregate_by_key(li, "l_suppkey", "l_quantity", F.pmod("l_orderkey", F.lit(4)), 30.0)


@query("d05_combine_by_key", "D05", oracle="""
SELECT l_partkey, sum(l_quantity) AS total, count(l_quantity) AS n, sum(l_quantity) / count(l_quantity) AS mean
FROM lineitem GROUP BY 1
""")
def d05_combine_by_key(spark, sf):
    return A.mean_by_key(load(spark, sf, "lineitem"), "l_partkey", "l_quantity")


@query("d06_fold_by_key", "D06", oracle="""
SELECT l_orderkey, string_agg(l_returnflag || ' ', '' ORDER BY l_linenumber, l_returnflag) AS folded
FROM lineitem GROUP BY 1
""")
def d06_fold_by_key(spark, sf):
    return A.fold_by_key_text(load(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", "l_linenumber")


@query("d07_reduce", "D07 D15", oracle="""
SELECT sum(l_quantity) AS sum_qty, max(l_extendedprice) AS max_price FROM lineitem
""")
def d07_reduce(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.agg(F.sum("l_quantity").alias("sum_qty"), F.max("l_extendedprice").alias("max_price"))


@query("d07_ordered_fold", "D07", oracle="""
SELECT CAST(arg_min(o_custkey, o_orderkey) + sum(CASE WHEN o_custkey % 2 = 0 THEN -o_custkey ELSE o_custkey END)
            - arg_min(CASE WHEN o_custkey % 2 = 0 THEN -o_custkey ELSE o_custkey END, o_orderkey) AS BIGINT) AS folded
FROM orders
""")
def d07_ordered_fold(spark, sf):
    """Order-dependent reduce over the customer keys of orders in order-key order."""
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return A.signed_fold(o, "o_custkey", ["o_orderkey"])


@query("d08_fold_with_zero", "D08", oracle="""
SELECT CAST(sum(p) + 10 AS BIGINT) AS folded FROM (
  SELECT l_orderkey % 8 AS b, sum(CAST(l_quantity AS BIGINT)) + 10 AS p FROM lineitem GROUP BY 1)
""")
def d08_fold_with_zero(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_quantity").cast("long").alias("q"), "l_orderkey")
    return A.fold_with_zero(li, "q", F.pmod("l_orderkey", F.lit(8)), 10)


@query("d09_aggregate", "D09", oracle="""
SELECT CAST(sum(s) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT l_orderkey % 8 AS b, sum(CAST(l_quantity AS BIGINT)) AS s, count(*) AS n FROM lineitem GROUP BY 1)
""")
def d09_aggregate(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_quantity").cast("long").alias("q"), "l_orderkey")
    return A.aggregate_all(li, "q", F.pmod("l_orderkey", F.lit(8)), 0)


@query("d10_tree_aggregate", "D10", oracle="""
SELECT sum(l_quantity) AS result FROM lineitem
""")
def d10_tree_aggregate(spark, sf):
    li = load(spark, sf, "lineitem")
    return A.tree_aggregate(li, "l_quantity", F.col("l_orderkey"), fanouts=(64, 8))


@query("d12_count_by_key", "D12", oracle="""
SELECT l_suppkey, count(*) AS cnt FROM lineitem GROUP BY 1
""")
def d12_count_by_key(spark, sf):
    return A.count_by(load(spark, sf, "lineitem"), "l_suppkey")


@query("d13_count_by_value", "D13", oracle="""
SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY 1, 2
""")
def d13_count_by_value(spark, sf):
    return A.count_by(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("d14_count", "D14", oracle="SELECT count(*) AS cnt FROM lineitem")
def d14_count(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("cnt"))


@query("d17_stats", "D15 D16 D17", oracle="""
SELECT count(o_totalprice) AS cnt, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean,
       max(o_totalprice) AS max, min(o_totalprice) AS min,
       round(var_pop(o_totalprice), 0) AS variance, round(stddev_pop(o_totalprice), 4) AS stdev
FROM orders
""")
def d17_stats(spark, sf):
    s = A.stats(load(spark, sf, "orders"), "o_totalprice")
    return s.select("cnt", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), "max", "min",
                    F.round("variance", 0).alias("variance"), F.round("stdev", 4).alias("stdev"))


@query("d18_histogram", "D18", oracle="""
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bucket, count(*) AS cnt
      FROM orders, b GROUP BY 1)
SELECT g.bucket, round(lo + g.bucket * (hi - lo) / 10, 4) AS lower, coalesce(cnt, 0) AS cnt
FROM (SELECT CAST(range AS INTEGER) AS bucket FROM range(10)) g CROSS JOIN b LEFT JOIN c ON g.bucket = c.bucket
""")
def d18_histogram(spark, sf):
    h = A.histogram_even(load(spark, sf, "orders").select("o_totalprice"), "o_totalprice", 10)
    return h.select("bucket", F.round("lower", 4).alias("lower"), "cnt")


@query("d19_histogram_bounds", "D19", oracle="""
WITH g AS (SELECT * FROM (VALUES (0, 0.0, 50000.0), (1, 50000.0, 100000.0), (2, 100000.0, 200000.0),
                                  (3, 200000.0, 300000.0), (4, 300000.0, 1000000.0)) t(bucket, lower, upper)),
c AS (SELECT CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 100000 THEN 1
                  WHEN o_totalprice < 200000 THEN 2 WHEN o_totalprice < 300000 THEN 3 ELSE 4 END AS bucket,
             count(*) AS cnt
      FROM orders WHERE o_totalprice BETWEEN 0 AND 1000000 GROUP BY 1)
SELECT CAST(g.bucket AS INTEGER) AS bucket, CAST(lower AS DOUBLE) AS lower, CAST(upper AS DOUBLE) AS upper,
       coalesce(cnt, 0) AS cnt
FROM g LEFT JOIN c ON g.bucket = c.bucket
""")
def d19_histogram_bounds(spark, sf):
    return A.histogram_bounds(load(spark, sf, "orders"), "o_totalprice",
                              [0, 50000, 100000, 200000, 300000, 1000000])


@query("d20_distinct", "D20", oracle="SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def d20_distinct(spark, sf):
    return load(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("d21_exact_distinct_per_hour", "D21 M06", oracle="""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def d21_exact_distinct_per_hour(spark, sf):
    views = load(spark, sf, "events").filter(F.col("event_type") == "view")
    return W.tumbling_agg(views, "ts", 3600, aggs=[F.count_distinct("user_id").alias("uv")]).drop("window_end")


BITMAP_SQL = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: unicode(c)), "
              "lambda a, x: (a * 62 + x) & 134217727)")


@query("d22_bitmap_distinct_per_hour", "D22 M06", oracle=f"""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, count(DISTINCT {BITMAP_SQL}) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def d22_bitmap_distinct_per_hour(spark, sf):
    views = load(spark, sf, "events").filter(F.col("event_type") == "view")
    sec = F.unix_timestamp("ts")
    views = views.withColumn("window_start", sec - F.pmod(sec, F.lit(3600)))
    return A.bitmap_distinct_count(views, ["window_start"], "user_id")


@query("d23_counters", "D23", oracle="""
SELECT CAST(count_if(event_type = 'click') AS BIGINT) AS clicks, CAST(count_if(event_type = 'view') AS BIGINT) AS views,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases, CAST(count_if(value > 50) AS BIGINT) AS big_values
FROM events
""")
def d23_counters(spark, sf):
    ev = load(spark, sf, "events")
    return A.counter_totals(ev, clicks=F.col("event_type") == "click", views=F.col("event_type") == "view",
                            purchases=F.col("event_type") == "purchase", big_values=F.col("value") > 50)


@query("d24_minute_summary", "D24", oracle="""
SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, event_type AS language, count(*) AS pv,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY 1, 2
""")
def d24_minute_summary(spark, sf):
    """pv and uv per minute and language (event type stands for language)."""
    ev = load(spark, sf, "events")
    return (ev.groupBy(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"), F.col("event_type").alias("language"))
              .agg(F.count(F.lit(1)).alias("pv"), F.count_distinct("user_id").alias("uv")))
