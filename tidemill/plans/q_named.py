"""Composite named queries (survey section 2.13, M01 to M13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import windows as W
from tidemill.operators.ranking import top_n_per_group
from tidemill.plans.registry import query
from tidemill.sources.tables import events_with_item

# DuckDB expression for the item id of an event.
K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def hot_products(spark, sf_dir, size_s=3600, slide_s=300, top=5):
    """Viewed items, 1 h windows sliding 5 min, top 5 per window by
    view count, ties broken by item id."""
    views = events_with_item(spark, sf_dir).filter(F.col("event_type") == "view")
    counts = W.sliding_counts(views, "ts", size_s, slide_s, keys=["k"], by_block=True)
    ranked = top_n_per_group(counts, "window_start", [F.col("cnt").desc(), F.col("k")], top)
    return ranked.select("window_end", F.col("k").alias("item_id"), "cnt", "rn")


query("m03_hot_products", "M03 E01 J05", bench=True, oracle=f"""
WITH v AS (
  SELECT {K_SQL} AS k, CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS slice
  FROM events WHERE event_type = 'view'),
w AS (
  SELECT slice - 300 * i AS window_start, k, count(*) AS cnt
  FROM v, (SELECT range AS i FROM range(12)) t GROUP BY 1, 2),
r AS (
  SELECT window_start + 3600 AS window_end, k AS item_id, cnt,
         row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, k) AS rn
  FROM w)
SELECT window_end, item_id, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 5
""")(hot_products)


# ---- further named queries -------------------------------------------------------

from tidemill.functions import scalar as S  # noqa: E402
from tidemill.functions.time import epoch_millis  # noqa: E402
from tidemill.operators import aggregates as A  # noqa: E402
from tidemill.operators import joins as J  # noqa: E402
from tidemill.operators import patterns as P  # noqa: E402
from tidemill.operators.ordering import first_n  # noqa: E402
from tidemill.sources.tables import load  # noqa: E402

# Fixed value: the word separators of the word count (the texts hold only
# spaces and newlines, but any ASCII blank separates words).
WORD_SEPARATOR = r"[ \t\n\r\f]+"


@query("m01_word_count", "M01 B02 D01 F01", bench=True, oracle="""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents) WHERE word <> ''
GROUP BY word ORDER BY cnt DESC, word
""")
def m01_word_count(spark, sf):
    """Words of every document (whole texts), counted, most frequent first."""
    docs = load(spark, sf, "documents").select("text")
    words = docs.select(F.explode(F.split("text", WORD_SEPARATOR)).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), "word")


@query("m02_category_top10", "M02 F06", bench=True, oracle=f"""
SELECT {K_SQL} AS category, CAST(count_if(event_type = 'click') AS BIGINT) AS click_count,
       CAST(count_if(event_type = 'view') AS BIGINT) AS order_count,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS pay_count
FROM events GROUP BY 1 ORDER BY click_count DESC, order_count DESC, pay_count DESC, category LIMIT 10
""")
def m02_category_top10(spark, sf):
    """Click, order (view) and pay (purchase) counts per category, top 10 by
    click, then order, then pay count (category id breaks ties)."""
    ev = events_with_item(spark, sf)
    counts = ev.groupBy(F.col("k").alias("category")).agg(
        F.count_if(F.col("event_type") == "click").alias("click_count"),
        F.count_if(F.col("event_type") == "view").alias("order_count"),
        F.count_if(F.col("event_type") == "purchase").alias("pay_count"))
    return first_n(counts, [F.col("click_count").desc(), F.col("order_count").desc(),
                            F.col("pay_count").desc(), F.col("category")], 10)


@query("m04_hot_pages", "M04 A04 J05 E01", bench=True, oracle="""
WITH s AS (SELECT CAST(floor(epoch(ts) / 5) AS BIGINT) * 5 AS slice, '/p/' || json_extract_string(props, '$.k') AS url
           FROM events),
c AS (SELECT slice, url, count(*) AS n FROM s GROUP BY 1, 2),
w AS (SELECT slice - 5 * i AS window_start, url, CAST(sum(n) AS BIGINT) AS cnt
      FROM c, (SELECT range AS i FROM range(120)) t GROUP BY 1, 2),
r AS (SELECT window_start + 600 AS window_end, url, cnt,
             row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, url) AS rn FROM w)
SELECT window_end, url, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 5
""")
def m04_hot_pages(spark, sf, size_s=600, slide_s=5, top=5):
    """Requests of any method per url, 10 min windows sliding 5 s, top 5 urls
    per window.  Counts are taken per 5 s slice first and only then copied
    into the 120 windows of each slice."""
    ev = load(spark, sf, "events").select("ts", F.concat(F.lit("/p/"), F.get_json_object("props", "$.k")).alias("url"))
    counts = W.sliding_counts(ev, "ts", size_s, slide_s, keys=["url"], by_block=True)
    ranked = top_n_per_group(counts, "window_start", [F.col("cnt").desc(), F.col("url")], top)
    return ranked.select("window_end", "url", "cnt", "rn")


@query("m05_page_views_hourly", "M05 J04", bench=True, oracle="""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 + 3600 AS window_end, count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def m05_page_views_hourly(spark, sf):
    views = load(spark, sf, "events").filter(F.col("event_type") == "view")
    out = W.tumbling_agg(views, "ts", 3600, aggs=[F.count(F.lit(1)).alias("pv")])
    return out.select("window_end", "pv")


@query("m06_unique_visitors", "M06 D21 D22", bench=True, oracle=f"""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 + 3600 AS window_end, count(DISTINCT user_id) AS uv,
       count(DISTINCT list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: unicode(c)),
                                  lambda a, x: (a * 62 + x) & 134217727)) AS uv_bitmap
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def m06_unique_visitors(spark, sf):
    """Distinct viewers per hour, exact and by the one-hash bitmap."""
    views = load(spark, sf, "events").filter(F.col("event_type") == "view")
    # distinct (window, user) first, so that each user is hashed once a window
    pairs = W.tumbling_agg(views, "ts", 3600, keys=["user_id"]).withColumn("_bit", A.bitmap_hash(F.col("user_id").cast("string")))
    out = pairs.groupBy("window_end").agg(F.count("user_id").alias("uv"), F.count_distinct("_bit").alias("uv_bitmap"))
    return out.select("window_end", "uv", "uv_bitmap")


@query("m07_ad_clicks_by_province", "M07 K10 J05", bench=True, oracle="""
WITH cl AS (SELECT event_id, user_id, ts, json_extract_string(props, '$.k') AS k FROM events WHERE event_type = 'click'),
capped AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, k, floor(epoch(ts) / 86400) ORDER BY ts, event_id) AS rn FROM cl)
  WHERE rn <= 100),
p AS (SELECT CAST(floor(epoch(ts) / 5) AS BIGINT) * 5 AS slice, n_name AS province
      FROM capped JOIN nation ON n_nationkey = user_id % 25),
c AS (SELECT slice, province, count(*) AS n FROM p GROUP BY 1, 2)
SELECT slice - 5 * i + 3600 AS window_end, province, CAST(sum(n) AS BIGINT) AS cnt
FROM c, (SELECT range AS i FROM range(720)) t GROUP BY 1, 2
""")
def m07_ad_clicks_by_province(spark, sf, cap=100, size_s=3600, slide_s=5):
    """Clicks after the per-user, per-ad daily cap, counted per province
    (the user's nation) in 1 h windows sliding 5 s.  Every window holding
    data is produced once; its count is a difference of running sums, so
    the work follows slices and output windows, not 720 copies per slice."""
    clicks = events_with_item(spark, sf).filter(F.col("event_type") == "click")
    passed = P.daily_cap(clicks, ["user_id", "k"], "ts", "event_id", cap=cap).filter(F.col("kind") == "pass")
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("_nk"),
                                              F.col("n_name").alias("province"))
    located = J.lookup_enrich(passed.withColumn("_nk", F.pmod("user_id", F.lit(25))), nation, "_nk")
    # 720 windows per slice: count by running sums instead of copying
    # slices into windows (see ``sliding_counts_prefix``)
    counts = W.sliding_counts_prefix(located, "ts", size_s, slide_s, keys=["province"])
    return counts.select("window_end", "province", "cnt")


@query("m09_log_enrichment", "M09 A05 H06 C10 H04", oracle="""
SELECT event_id, key AS type, CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS score,
       n_name AS country, coalesce(r_name, '') AS area, epoch_us(ts) // 1000 AS ts_ms
FROM (SELECT *, unnest(json_keys(props)) AS key FROM events) e
LEFT JOIN nation ON n_nationkey = e.user_id % 25 LEFT JOIN region ON n_regionkey = r_regionkey
""")
def m09_log_enrichment(spark, sf):
    """JSON payload exploded to one row per entry, the country (the user's
    nation) mapped to its area (region), event time in ms."""
    ev = load(spark, sf, "events")
    entries = ev.select("event_id", "user_id", "ts",
                        F.explode(S.parse_json(F.col("props"), "map<string,long>")).alias("type", "score"))
    n = load(spark, sf, "nation")
    r = load(spark, sf, "region")
    dim = (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("_nk"), F.col("n_name").alias("country"),
                    F.col("r_name").alias("area")))
    out = J.lookup_enrich(entries.withColumn("_nk", F.pmod("user_id", F.lit(25))), dim, "_nk",
                          default={"area": ""})
    return out.select("event_id", "type", "score", "country", "area", epoch_millis("ts").alias("ts_ms"))


@query("m10_ad_attribution", "M10 C13 H08 H05 K09", bench=True, oracle="""
WITH e AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, ts, event_type FROM events),
u AS (
  SELECT user_id, k, ts, 0 AS side, event_id AS srv_id, ts AS srv_ts, NULL AS event_id, NULL AS event_type
  FROM e WHERE event_type = 'view'
  UNION ALL
  SELECT user_id, k, ts, 1, NULL, NULL, event_id, event_type FROM e WHERE event_type IN ('click', 'purchase')),
x AS (
  SELECT *, last_value(srv_id IGNORE NULLS) OVER w AS cid, last_value(srv_ts IGNORE NULLS) OVER w AS cts
  FROM u WINDOW w AS (PARTITION BY user_id, k ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
y AS (SELECT event_id, user_id, k, event_type,
             CASE WHEN floor(epoch(ts)) - floor(epoch(cts)) <= 3600 THEN cid END AS ctx_event_id
      FROM x WHERE side = 1)
SELECT event_id, ctx_event_id, CASE WHEN ctx_event_id IS NULL THEN 'retry' ELSE 'report' END AS kind,
       CAST(event_type = 'click' AS BIGINT) AS click, CAST(event_type = 'purchase' AS BIGINT) AS pay,
       to_json(struct_pack(event_id := event_id, user_id := user_id, item_id := k, event_type := event_type)) AS report
FROM y
""")
def m10_ad_attribution(spark, sf):
    """Client events joined to the server context of the same user and item
    (latest view at most 1 h older), flags set from the event type, a JSON
    report line, and misses routed to the retry output."""
    from tidemill.plans.q_relational import context_join
    j = context_join(spark, sf)
    flagged = S.indicator_columns(j, "event_type", ["click", "purchase"])
    return flagged.select(
        "event_id", "ctx_event_id",
        F.when(F.col("ctx_event_id").isNull(), F.lit("retry")).otherwise(F.lit("report")).alias("kind"),
        "click", F.col("purchase").alias("pay"),
        F.to_json(F.struct("event_id", "user_id", F.col("k").alias("item_id"), "event_type")).alias("report"))


@query("m11_followers", "M11", oracle="""
SELECT l_orderkey AS friend, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS followers,
       count(DISTINCT l_suppkey) AS n_followers
FROM lineitem GROUP BY 1
""")
def m11_followers(spark, sf):
    """Friend lists (supplier -> the orders it supplies) inverted: for each
    order, the suppliers that list it.  A list holds the lines of one order,
    so it is bounded by the order size."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    g = li.groupBy(F.col("l_orderkey").alias("friend")).agg(F.array_sort(F.collect_set("l_suppkey")).alias("_f"))
    return g.select("friend", F.array_join("_f", ",").alias("followers"), F.size("_f").cast("long").alias("n_followers"))


@query("m12_common_friends", "M12", bench=True, oracle="""
WITH fs AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT a.l_suppkey AS person_a, b.l_suppkey AS person_b, count(*) AS n_common,
       array_to_string(list_sort(list(a.l_orderkey)), ',') AS common
FROM fs a JOIN fs b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey
GROUP BY 1, 2
""")
def m12_common_friends(spark, sf):
    """For every pair of suppliers (a < b), the orders both supply.  Pairs
    are formed inside one order's supplier set only."""
    fs = load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    a = fs.select("l_orderkey", F.col("l_suppkey").alias("person_a"))
    b = fs.select("l_orderkey", F.col("l_suppkey").alias("person_b"))
    pairs = a.join(b, "l_orderkey").filter(F.col("person_a") < F.col("person_b"))
    g = pairs.groupBy("person_a", "person_b").agg(F.count(F.lit(1)).alias("n_common"),
                                                  F.array_sort(F.collect_list("l_orderkey")).alias("_c"))
    return g.select("person_a", "person_b", "n_common", F.array_join("_c", ",").alias("common"))


@query("m13_order_enrichment", "M13 C12", oracle="""
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_date, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def m13_order_enrichment(spark, sf):
    """Order lines joined with the order's customer details on the key."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return o.join(c, "o_custkey").drop("o_custkey")

