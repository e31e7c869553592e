"""Queries for survey 2.5 (ranking), 2.6 (sorts), 2.7 (sets), 2.8 (scalar
functions) and 2.9 (sampling and partitioning)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.functions import scalar as S
from tidemill.functions.time import epoch_millis, epoch_seconds, format_time
from tidemill.operators import ordering as O
from tidemill.operators import ranking as R
from tidemill.operators import sampling as SM
from tidemill.operators import sets as G
from tidemill.operators import windows as W
from tidemill.plans.registry import query
from tidemill.sources.tables import events_with_item, load

K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
LI_ORDER = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# ---- 2.5 ranking ---------------------------------------------------------------

@query("e01_top_n_per_window", "E01 J03", oracle=f"""
WITH c AS (SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) * 86400 AS window_start, {K_SQL} AS k, count(*) AS cnt
           FROM events GROUP BY 1, 2),
r AS (SELECT window_start + 86400 AS window_end, k AS item_id, cnt,
             row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, k) AS rn FROM c)
SELECT window_end, item_id, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 3
""")
def e01_top_n_per_window(spark, sf):
    """Top 3 items per day window by event count, ties by item id."""
    ev = events_with_item(spark, sf)
    counts = W.tumbling_agg(ev, "ts", 86400, keys=["k"])
    ranked = R.top_n_per_group(counts, "window_start", [F.col("cnt").desc(), F.col("k")], 3)
    return ranked.select("window_end", F.col("k").alias("item_id"), "cnt", "rn")


@query("e02_first_n_per_group", "E02", oracle="""
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 2
""")
def e02_first_n_per_group(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.top_n_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2)


GLOBAL_RANK_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank
FROM lineitem
"""


@query("e03_global_rank", "E03", oracle=GLOBAL_RANK_SQL)
def e03_global_rank(spark, sf):
    li = load(spark, sf, "lineitem").select(*LI_ORDER)
    return R.global_rank(li, LI_ORDER).select("l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@query("e04_bucket_rank", "E04 H10", oracle=GLOBAL_RANK_SQL)
def e04_bucket_rank(spark, sf):
    """The fixed cut-point plan (100 and 10000) of the counter-based rank."""
    li = load(spark, sf, "lineitem").select(*LI_ORDER)
    return (R.global_rank_by_buckets(li, "l_extendedprice", [100, 10000], LI_ORDER)
            .select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("rank").cast("long").alias("rank")))


# ---- 2.6 sorts, limits, top-k ------------------------------------------------------

@query("f01_global_sort", "F01", oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey
""")
def f01_global_sort(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.sort_by(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("f02_sorted_first_n", "F02", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY l_orderkey, l_linenumber DESC, l_partkey, l_suppkey, l_extendedprice LIMIT 20
""")
def f02_sorted_first_n(spark, sf):
    li = load(spark, sf, "lineitem")
    out = O.first_n(li, [F.col("l_orderkey"), F.col("l_linenumber").desc(), F.col("l_partkey"),
                         F.col("l_suppkey"), F.col("l_extendedprice")], 20)
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query("f03_first_take", "F03", oracle="""
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5
""")
def f03_first_take(spark, sf):
    return O.first_n(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), [F.col("o_orderkey")], 5)


@query("f04_take_ordered", "F04", oracle="""
SELECT o_totalprice FROM orders ORDER BY o_totalprice LIMIT 10
""")
def f04_take_ordered(spark, sf):
    return O.take_ordered(load(spark, sf, "orders").select("o_totalprice"), "o_totalprice", 10)


@query("f05_top", "F05", oracle="""
SELECT o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 10
""")
def f05_top(spark, sf):
    return O.top(load(spark, sf, "orders").select("o_totalprice"), "o_totalprice", 10)


@query("f06_secondary_sort", "F06", oracle=f"""
SELECT {K_SQL} AS k, CAST(count_if(event_type = 'click') AS BIGINT) AS clicks,
       CAST(count_if(event_type = 'view') AS BIGINT) AS views,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases
FROM events GROUP BY 1 ORDER BY clicks DESC, views DESC, purchases DESC, k
""")
def f06_secondary_sort(spark, sf):
    ev = events_with_item(spark, sf)
    counts = ev.groupBy("k").agg(F.count_if(F.col("event_type") == "click").alias("clicks"),
                                 F.count_if(F.col("event_type") == "view").alias("views"),
                                 F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return counts.orderBy(F.col("clicks").desc(), F.col("views").desc(), F.col("purchases").desc(), F.col("k"))


@query("f07_lookup", "F07", oracle="""
SELECT l_linenumber, l_quantity FROM lineitem WHERE l_orderkey = 7
""")
def f07_lookup(spark, sf):
    return O.lookup(load(spark, sf, "lineitem"), "l_orderkey", 7, ["l_linenumber", "l_quantity"])


# ---- 2.7 set operations --------------------------------------------------------------

@query("g01_union", "G01", oracle="""
SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier
""")
def g01_union(spark, sf):
    return G.union_all(load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")),
                       load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey")))


@query("g02_intersection", "G02", oracle="""
SELECT l_suppkey AS suppkey FROM lineitem WHERE l_quantity > 45
INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000
""")
def g02_intersection(spark, sf):
    a = load(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select(F.col("l_suppkey").alias("suppkey"))
    b = load(spark, sf, "supplier").filter(F.col("s_acctbal") > 3000).select(F.col("s_suppkey").alias("suppkey"))
    return G.intersection(a, b)


@query("g03_subtract", "G03", oracle="""
SELECT a.l_partkey, a.l_suppkey FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_quantity > 40
                  AND b.l_partkey IS NOT DISTINCT FROM a.l_partkey AND b.l_suppkey IS NOT DISTINCT FROM a.l_suppkey)
""")
def g03_subtract(spark, sf):
    li = load(spark, sf, "lineitem")
    a = li.select("l_partkey", "l_suppkey")
    b = li.filter(F.col("l_quantity") > 40).select("l_partkey", "l_suppkey")
    return G.subtract(a, b)


@query("g04_union_distinct_sorted", "G04", oracle="""
SELECT nationkey FROM (SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
ORDER BY nationkey
""")
def g04_union_distinct_sorted(spark, sf):
    a = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    b = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return G.union_distinct_sorted(a, b, [F.col("nationkey")])


# ---- 2.8 scalar functions ---------------------------------------------------------

@query("h01_tokenize", "H01 B02", oracle="""
SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda t: t <> '')) AS INTEGER)
       AS n_tokens FROM documents
""")
def h01_tokenize(spark, sf):
    """Tokens per document on non-word characters, lower-cased, whole texts."""
    d = load(spark, sf, "documents")
    return d.select("doc_id", F.size(S.tokenize(F.col("text"), r"\W+", lower=True)).alias("n_tokens"))


@query("h02_text_build", "H02", oracle="""
SELECT c_custkey, concat(c_name, '@', c_mktsegment) AS label, concat_ws('|', c_name, c_mktsegment) AS line
FROM customer
""")
def h02_text_build(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", S.build_text([F.col("c_name"), F.lit("@"), F.col("c_mktsegment")]).alias("label"),
                    S.build_text([F.col("c_name"), F.col("c_mktsegment")], "|").alias("line"))


@query("h03_trim_cast_substring", "H03", oracle="""
SELECT event_id, substring(strftime(ts, '%Y-%m-%d %H:%M:%S'), 1, 16) AS minute,
       CAST(length(props) AS INTEGER) AS props_len,
       TRY_CAST(trim(concat('  ', CAST(user_id AS VARCHAR), ' ')) AS BIGINT) AS user_id
FROM events
""")
def h03_trim_cast_substring(spark, sf):
    ev = load(spark, sf, "events")
    padded = F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" "))
    return ev.select("event_id", S.minute_prefix(format_time("ts")).alias("minute"),
                     F.length("props").alias("props_len"), S.clean_long(padded).alias("user_id"))


@query("h04_time_parse_format", "H04", oracle="""
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       epoch_ms(strptime(strftime(ts, '%d/%m/%Y:%H:%M:%S'), '%d/%m/%Y:%H:%M:%S')) AS reparsed_ms
FROM events
""")
def h04_time_parse_format(spark, sf):
    ev = load(spark, sf, "events")
    log_text = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    reparsed = F.try_to_timestamp(log_text, F.lit("dd/MM/yyyy:HH:mm:ss")).cast("timestamp_ntz")
    return ev.select("event_id", epoch_millis("ts").alias("ts_ms"), epoch_seconds("ts").alias("ts_s"),
                     format_time("ts").alias("ts_text"), epoch_millis(reparsed).alias("reparsed_ms"))


@query("h05_json_read_write", "H05", oracle=f"""
SELECT event_id, to_json(struct_pack(event_id := event_id, user_id := user_id, item_id := {K_SQL})) AS report
FROM events
""")
def h05_json_read_write(spark, sf):
    ev = load(spark, sf, "events")
    parsed = ev.withColumn("p", S.parse_json(F.col("props"), "map<string,long>"))
    parsed = parsed.withColumn("item_id", F.col("p").getItem("k"))
    return parsed.select("event_id", S.to_json_record(["event_id", "user_id", "item_id"]).alias("report"))


@query("h06_explode_nested", "H06", oracle="""
SELECT l_orderkey, l_linenumber, kind, amount FROM (
  SELECT l_orderkey, l_linenumber, 'price' AS kind, l_extendedprice AS amount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_extendedprice * l_tax FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_extendedprice * l_discount FROM lineitem)
""")
def h06_explode_nested(spark, sf):
    li = load(spark, sf, "lineitem")
    items = F.array(F.struct(F.lit("price").alias("kind"), F.col("l_extendedprice").alias("amount")),
                    F.struct(F.lit("tax").alias("kind"), (F.col("l_extendedprice") * F.col("l_tax")).alias("amount")),
                    F.struct(F.lit("discount").alias("kind"),
                             (F.col("l_extendedprice") * F.col("l_discount")).alias("amount")))
    return li.select("l_orderkey", "l_linenumber", F.inline(items))


@query("h07_map_inversion", "H07", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_custkey AS custkey FROM orders
""")
def h07_map_inversion(spark, sf):
    """customer -> "o1,o2,..." inverted to order -> customer."""
    o = load(spark, sf, "orders")
    lists = o.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.concat_ws(",", F.collect_list(F.col("o_orderkey").cast("string"))).alias("orders"))
    return S.invert_csv_map(lists, "custkey", "orders", "orderkey", "custkey")


@query("h08_indicator_columns", "H08", oracle="""
SELECT event_id, event_type,
       CAST(event_type = 'click' AS BIGINT) AS click, CAST(event_type = 'view' AS BIGINT) AS view,
       CAST(event_type = 'purchase' AS BIGINT) AS purchase, CAST(event_type = 'error' AS BIGINT) AS error,
       CAST(event_type = 'signup' AS BIGINT) AS signup
FROM events
""")
def h08_indicator_columns(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type")
    return S.indicator_columns(ev, "event_type", ["click", "view", "purchase", "error", "signup"])


@query("h09_composite_key", "H09", oracle=f"""
SELECT event_id, concat(CAST(user_id AS VARCHAR), CAST({K_SQL} AS VARCHAR), CAST(event_id AS VARCHAR)) AS key
FROM events
""")
def h09_composite_key(spark, sf):
    ev = events_with_item(spark, sf)
    return ev.select("event_id", S.composite_key([F.col("user_id"), F.col("k"), F.col("event_id")]).alias("key"))


@query("h10_magnitude_bucket", "H10", oracle="""
SELECT bucket, count(*) AS cnt FROM (
  SELECT CASE WHEN v < 10 THEN 0 WHEN v < 100 THEN 1 WHEN v < 1000 THEN 2 WHEN v < 10000 THEN 3
              WHEN v < 100000 THEN 4 ELSE 5 END AS bucket
  FROM (SELECT l_quantity * 1000 AS v FROM lineitem)) GROUP BY 1
""")
def h10_magnitude_bucket(spark, sf):
    li = load(spark, sf, "lineitem")
    b = S.magnitude_bucket(F.col("l_quantity") * 1000, 6)
    return li.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


@query("h11_arithmetic", "H11", oracle="""
SELECT l_orderkey, l_linenumber, l_linenumber * 2 AS doubled, l_linenumber % 2 AS parity,
       greatest(l_quantity, 25.0) AS at_least_25, least(l_quantity, 25.0) AS at_most_25,
       CAST(trunc(l_quantity / 7) AS BIGINT) AS int_div, l_quantity / 7 AS real_div
FROM lineitem
""")
def h11_arithmetic(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 2).alias("doubled"),
                     (F.col("l_linenumber") % 2).alias("parity"),
                     F.greatest("l_quantity", F.lit(25.0)).alias("at_least_25"),
                     F.least("l_quantity", F.lit(25.0)).alias("at_most_25"),
                     S.int_div(F.col("l_quantity"), F.lit(7)).alias("int_div"),
                     (F.col("l_quantity") / 7).alias("real_div"))


# ---- 2.9 sampling and partitioning --------------------------------------------------

def _sample_facts(sample, table, keys, least, most):
    """One row about a random sample: whether its size lies in the bounds, by
    how many rows its keys outnumber the table's, and how many it made up."""
    facts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_in"))
    return facts.join(known, keys, "left").agg(
        F.sum("n").between(least, most).alias("size_in_bounds"), F.sum(F.greatest(F.col("n") - F.col("_in"), F.lit(0))).alias("n_repeated"),
        F.count_if(F.col("_in").isNull()).alias("n_unknown"))


SAMPLE_FACTS = "SELECT true AS size_in_bounds, CAST(0 AS BIGINT) AS n_repeated, CAST(count(*) AS BIGINT) AS n_unknown FROM {} WHERE false"
LINE = ["l_orderkey", "l_linenumber"]


@query("i01_sample", "I01", oracle=SAMPLE_FACTS.format("lineitem"))
def i01_sample(spark, sf):
    """A tenth of the lines: 6 standard deviations about the mean size."""
    li = load(spark, sf, "lineitem").select(*LINE)
    n = li.count()
    spread = 6 * (n * 0.1 * 0.9) ** 0.5
    return _sample_facts(SM.sample(li, 0.1, seed=7), li, LINE, 0.1 * n - spread, 0.1 * n + spread)


@query("i01_hash_sample", "I01", oracle="""
SELECT * FROM lineitem
WHERE CAST('0x' || substr(md5('7:' || CAST(l_orderkey AS VARCHAR)), 1, 15) AS BIGINT) < CAST(115292150460684704 AS BIGINT)
""")
def i01_hash_sample(spark, sf):
    li = load(spark, sf, "lineitem")
    return SM.hash_sample(li, F.col("l_orderkey"), 0.1, seed=7)


@query("i02_sample_by_key", "I02", oracle=f"""
SELECT l_returnflag, s.* FROM (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')) f,
  (SELECT true AS size_in_bounds, CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_unknown) s
""")
def i02_sample_by_key(spark, sf):
    """A fraction for each return flag, each with its own bounds."""
    li = load(spark, sf, "lineitem").select(*LINE, "l_returnflag")
    rates = {"A": 0.1, "N": 0.5, "R": 0.2}
    total = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("_n"))
    rate = F.element_at(F.create_map(*[F.lit(x) for kv in rates.items() for x in kv]), F.col("l_returnflag"))
    got = SM.sample_by_key(li, "l_returnflag", rates, seed=7).groupBy(*LINE, "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    known = li.groupBy(*LINE, "l_returnflag").agg(F.count(F.lit(1)).alias("_in"))
    per = got.join(known, [*LINE, "l_returnflag"], "left").groupBy("l_returnflag").agg(
        F.sum("n").alias("n"), F.sum(F.greatest(F.col("n") - F.col("_in"), F.lit(0))).alias("n_repeated"), F.count_if(F.col("_in").isNull()).alias("n_unknown"))
    spread = 6 * F.sqrt(F.col("_n") * rate * (1 - rate))
    return per.join(total, "l_returnflag").select(
        "l_returnflag", (F.abs(F.col("n") - F.col("_n") * rate) <= spread).alias("size_in_bounds"), "n_repeated", "n_unknown")


@query("i03_take_sample", "I03", oracle=SAMPLE_FACTS.format("orders"))
def i03_take_sample(spark, sf):
    """Exactly 100 orders, none twice."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    return _sample_facts(SM.take_sample(orders, 100, seed=7), orders, ["o_orderkey"], 100, 100)


@query("i04_random_split", "I04", oracle="""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_missing, CAST(3 AS BIGINT) AS n_parts FROM orders
""")
def i04_random_split(spark, sf):
    """Split into three parts: disjoint, complete and none empty."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    total = None
    for i, p in enumerate(SM.random_split(orders, [0.5, 0.3, 0.2], seed=7)):
        p = p.withColumn("part", F.lit(i))
        total = p if total is None else total.unionByName(p)
    per = total.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("part"))
    every = orders.withColumn("_in", F.lit(1)).join(per, "o_orderkey", "full")
    return every.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_repeated"),
                     F.count_if(F.col("n").isNull()).alias("n_missing"), F.count_distinct("part").alias("n_parts"))


@query("i05_hash_partition", "I05", oracle="""
SELECT l_suppkey, CAST(1 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM lineitem GROUP BY 1
""")
def i05_hash_partition(spark, sf):
    """Every key lands in exactly one partition, with all its rows."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = SM.hash_partition(load(spark, sf, "lineitem").select("l_suppkey"), n, "l_suppkey")
    li = li.withColumn("pid", F.spark_partition_id())
    return li.groupBy("l_suppkey").agg(F.count_distinct("pid").alias("n_partitions"), F.count(F.lit(1)).alias("n_rows"))


@query("i06_range_partition", "I06", oracle="SELECT CAST(0 AS BIGINT) AS n_overlaps, count(*) AS n_rows FROM lineitem")
def i06_range_partition(spark, sf):
    """Key ranges of the partitions do not overlap and hold every row."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = SM.range_partition(load(spark, sf, "lineitem").select("l_orderkey"), n, "l_orderkey")
    per = li.groupBy(F.spark_partition_id().alias("pid")).agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"),
                                                               F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("lo")  # one row for each partition
    nxt = per.withColumn("next_lo", F.lead("lo").over(w))
    return nxt.agg(F.count_if(F.col("next_lo") <= F.col("hi")).alias("n_overlaps"), F.sum("n").alias("n_rows"))


@query("i07_custom_partitioner", "I07", oracle="""
SELECT CAST(l_orderkey % 7 AS INTEGER) AS bucket, count(*) AS cnt FROM lineitem GROUP BY 1
""")
def i07_custom_partitioner(spark, sf):
    li = SM.custom_partition(load(spark, sf, "lineitem").select("l_orderkey"), F.col("l_orderkey"), 7)
    return li.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"))


@query("i07_magnitude_partitioner", "I07 H10", oracle="""
SELECT CAST(CASE WHEN o_totalprice < 10 THEN 0 WHEN o_totalprice < 100 THEN 1 WHEN o_totalprice < 1000 THEN 2
                 WHEN o_totalprice < 10000 THEN 3 WHEN o_totalprice < 100000 THEN 4 ELSE 5 END AS INTEGER) AS bucket,
       count(*) AS cnt, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1
""")
def i07_magnitude_partitioner(spark, sf):
    o = SM.magnitude_partition(load(spark, sf, "orders").select("o_totalprice"), F.col("o_totalprice"), 6)
    return o.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
