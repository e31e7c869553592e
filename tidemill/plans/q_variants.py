"""Named variants of survey operators that have a query of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.operators import cells as C
from tidemill.operators import joins as J
from tidemill.operators import ordering as O
from tidemill.operators import ranking as R
from tidemill.operators import transforms as T
from tidemill.operators import windows as W
from tidemill.plans.q_cells import CELLS_SQL, customer_cells
from tidemill.plans.registry import query
from tidemill.sources.tables import load


@query("c11_window_join_rows", "C11", oracle="""
WITH c AS (SELECT user_id, event_id, floor(epoch(ts) / 600) AS w FROM events WHERE event_type = 'click'),
     v AS (SELECT user_id, event_id, floor(epoch(ts) / 600) AS w FROM events WHERE event_type = 'view')
SELECT c.event_id AS click_id, v.event_id AS view_id, CAST(c.w AS BIGINT) * 600 AS window_start
FROM c JOIN v ON c.user_id = v.user_id AND c.w = v.w
""")
def c11_window_join_rows(spark, sf):
    """Clicks with the views of the same user in the same 10 min window."""
    ev = load(spark, sf, "events")
    clicks = ev.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    views = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    out = J.window_join(clicks, views, "user_id", "click_ts", "view_ts", 600)
    return out.select("click_id", "view_id", "window_start")


@query("d05_combine_list", "D05", oracle="""
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY 1
""")
def d05_combine_list(spark, sf):
    """combineByKey to a list: the parts of each order (as many as its lines)."""
    li = load(spark, sf, "lineitem")
    return A.group_values(li, "l_orderkey", "l_partkey", sep=",", key_name="l_orderkey", out="parts")


@query("d09_product", "D09", oracle="""
SELECT product(1 + c_nationkey / 1e6) AS product, sum(1 + c_nationkey / 1e6) AS total, count(*) AS n FROM customer
""")
def d09_product(spark, sf):
    """Aggregate with a product accumulator."""
    return A.product_all(load(spark, sf, "customer").select((1 + F.col("c_nationkey") / F.lit(1e6)).alias("v")), "v")


@query("d09_text", "D09", oracle="""
WITH r AS (SELECT o_orderkey // 64 AS b, o_orderkey AS k, o_orderpriority AS p FROM orders),
a AS (SELECT b, k, p FROM r UNION ALL SELECT DISTINCT b, -1, 'x' FROM r UNION ALL SELECT -1, -1, 'x')
SELECT CAST(sum(length(p)) OVER (ORDER BY b, k) - length(p) AS BIGINT) AS at, p AS piece FROM a
""")
def d09_text(spark, sf):
    """Aggregate with a text accumulator: priorities in key order, a zero before all and before each run of 64 keys."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return A.text_aggregate(o, "o_orderpriority", F.floor(F.col("o_orderkey") / 64), ["o_orderkey"], "x")


MINUTES_SQL = """
SELECT strftime(ts, '%Y-%m-%d %H:00') AS hour, event_type AS language, count(*) AS pv FROM events WHERE event_id % 2 = {} GROUP BY 1, 2"""


@query("d24_keep_first", "D24", oracle=f"""
WITH a AS ({MINUTES_SQL.format(0)}), b AS ({MINUTES_SQL.format(1)})
SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.hour = b.hour AND a.language = b.language)
""")
def d24_keep_first(spark, sf):
    """Two summaries saved one after the other: a repeated (hour, language) keeps its first row."""
    ev = load(spark, sf, "events")

    def summary(part):
        return (part.groupBy(F.date_format("ts", "yyyy-MM-dd HH:00").alias("hour"), F.col("event_type").alias("language"))
                .agg(F.count(F.lit(1)).alias("pv")))
    return A.keep_first(summary(ev.filter("event_id % 2 = 0")), summary(ev.filter("event_id % 2 = 1")), ["hour", "language"])


@query("e02_any_n_per_group", "E02", oracle="""
SELECT o_custkey, least(count(*), 2) AS n_kept, CAST(0 AS BIGINT) AS n_unknown FROM orders GROUP BY 1
""")
def e02_any_n_per_group(spark, sf):
    """Any two orders of each customer, without an order: how many were kept, and how many are not the customer's."""
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey")
    kept = R.any_n_per_group(o, "o_custkey", 2)
    known = o.select("o_orderkey", F.col("o_custkey").alias("_own")).distinct()
    return kept.join(known, "o_orderkey").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_kept"), F.count_if(F.col("_own") != F.col("o_custkey")).alias("n_unknown"))


@query("f02_first_n_in_partitions", "F02", oracle="""
SELECT l_suppkey, least(count(*), 3) AS n_kept, min(l_extendedprice) AS least FROM lineitem GROUP BY 1
""")
def f02_first_n_in_partitions(spark, sf):
    """Sort inside the partitions that a key is dealt to, and keep the first three rows of each key's run."""
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    run = O.sort_within_partitions(li.repartition("l_suppkey"), [F.col("l_suppkey"), F.col("l_extendedprice")])
    kept = T.map_partitions_iter(run, O.first_of_each_run("l_suppkey", 3), li.schema)
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_kept"), F.min("l_extendedprice").alias("least"))


@query("j18_arrival_against_event_time", "J18", oracle="""
WITH e AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(floor(epoch(ts)) AS BIGINT) + (event_id * 7919) % 90 AS arrived FROM events),
a AS (SELECT arrived - arrived % 300 AS window_start, event_type, count(*) AS by_arrival FROM e GROUP BY 1, 2),
b AS (SELECT t - t % 300 AS window_start, event_type, count(*) AS by_event FROM e GROUP BY 1, 2)
SELECT window_start, event_type, coalesce(by_arrival, 0) AS by_arrival, coalesce(by_event, 0) AS by_event
FROM a FULL JOIN b USING (window_start, event_type)
""")
def j18_arrival_against_event_time(spark, sf):
    """5 min counts by arrival time against those by event time; arrival is up to 89 s late by a rule of the row's id."""
    late = F.pmod(F.col("event_id") * 7919, F.lit(90))
    ev = load(spark, sf, "events").withColumn("arrived", F.timestamp_seconds(F.floor(F.col("ts").cast("timestamp").cast("double")) + late))
    by_arrival = W.tumbling_agg(ev, "arrived", 300, ["event_type"], [F.count(F.lit(1)).alias("by_arrival")]).drop("window_end")
    by_event = W.tumbling_agg(ev, "ts", 300, ["event_type"], [F.count(F.lit(1)).alias("by_event")]).drop("window_end")
    return by_arrival.join(by_event, ["window_start", "event_type"], "full").fillna(0, ["by_arrival", "by_event"])


@query("l07_add_family", "L07", oracle=f"""
WITH {CELLS_SQL}
SELECT row_key, family, qualifier, ts, value FROM cells
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'flags', 'debt', 1, 'yes' FROM customer WHERE c_acctbal < 0
""")
def l07_add_family(spark, sf):
    """A family is added to the declared ones and written to; a family that was never declared is refused."""
    cells = customer_cells(spark, sf)
    debt = load(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("row_key"), F.lit("flags").alias("family"), F.lit("debt").alias("qualifier"),
        F.lit(1).cast("long").alias("ts"), F.lit("yes").alias("value"))
    families = C.add_family(["info", "orders"], "flags")
    undeclared = debt.withColumn("family", F.lit("other"))
    return C.enforce_families(C.put(C.put(cells, debt), undeclared), families)
