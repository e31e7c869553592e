"""Queries for survey 2.1 (scans, sinks as row shapes) and 2.2 (transforms)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemill.functions import scalar as S
from tidemill.operators import transforms as T
from tidemill.plans.registry import query
from tidemill.sources import formats as FMT
from tidemill.sources.tables import load

K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


# ---- 2.1 sources and sinks ------------------------------------------------

@query("a02_text_lines", "A02", oracle="""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, string_split(text, chr(10))[i] AS line
FROM documents, LATERAL (SELECT range AS i FROM range(1, len(string_split(text, chr(10))) + 1))
""")
def a02_text_lines(spark, sf):
    """Every document's text split into lines (the text-file scan's rows)."""
    return FMT.split_lines(load(spark, sf, "documents"), "text", keep=["doc_id"])


@query("a05_json_props", "A05 H05", oracle=f"""
SELECT event_id, {K_SQL} AS k FROM events
""")
def a05_json_props(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", S.parse_json(F.col("props"), "k long").getField("k").alias("k"))


@query("a05_inferred_json", "A05", oracle=f"""
SELECT event_id, {K_SQL} AS k, CASE WHEN event_type = 'purchase' THEN value END AS price,
       CASE WHEN event_type IN ('click', 'view') THEN user_id END AS "user" FROM events
""")
def a05_inferred_json(spark, sf):
    """Records of differing fields, read through the schema of the whole
    batch: purchases carry a price, clicks and views a user."""
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    kind = F.col("event_type")
    line = F.when(kind == "purchase", F.to_json(F.struct(k, F.col("value").alias("price")))).when(
        kind.isin("click", "view"), F.to_json(F.struct(k, F.col("user_id").alias("user")))).otherwise(F.col("props"))
    out = FMT.read_json_lines(load(spark, sf, "events").select("event_id", line.alias("value")), keep=["event_id"])
    return out.select("event_id", F.col("k").cast("long").alias("k"), F.col("price").cast("double").alias("price"),
                      F.col("user").cast("long").alias("user"))


@query("a11_kafka_payload", "A11 H05", oracle="""
SELECT CAST(event_id AS VARCHAR) AS key,
       to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type)) AS value
FROM events
""")
def a11_kafka_payload(spark, sf):
    """Key and JSON value rows as written to a message topic."""
    ev = load(spark, sf, "events")
    return FMT.kafka_payload(ev, "event_id", ["event_id", "user_id", "event_type"])


@query("a12_text_sink_lines", "A12", oracle="""
SELECT concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                 o_orderpriority) AS value
FROM orders
""")
def a12_text_sink_lines(spark, sf):
    """The lines the text sink writes: one tab-joined line per row."""
    o = load(spark, sf, "orders")
    return FMT.to_text_lines(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("a19_dt_hour_counts", "A19", oracle="""
SELECT strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hour, count(*) AS cnt
FROM events GROUP BY 1, 2
""")
def a19_dt_hour_counts(spark, sf):
    """Rows per dt=yyyyMMdd/hour=HH partition of the date-hour layout."""
    ev = FMT.with_dt_hour(load(spark, sf, "events"), "ts")
    return ev.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("cnt"))


CUSTOMER_CELLS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'info' AS family, q AS qualifier, v AS value
FROM (
  SELECT c_custkey, 'name' AS q, c_name AS v FROM customer
  UNION ALL SELECT c_custkey, 'nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'mktsegment', c_mktsegment FROM customer)
"""


@query("a20_cell_export", "A20", oracle=f"""
SELECT concat_ws(chr(9), row_key, family, qualifier, value, '0') AS line
FROM ({CUSTOMER_CELLS_SQL})
""")
def a20_cell_export(spark, sf):
    from tidemill.operators import cells as C
    cells = C.cells_from_table(load(spark, sf, "customer"), "c_custkey", "info",
                               ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], strip_prefix="c_")
    return C.export_tsv(cells)


@query("a21_cell_import", "A21", oracle=CUSTOMER_CELLS_SQL)
def a21_cell_import(spark, sf):
    from tidemill.operators import cells as C
    cells = C.cells_from_table(load(spark, sf, "customer"), "c_custkey", "info",
                               ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], strip_prefix="c_")
    return cells.select("row_key", "family", "qualifier", "value")


# ---- 2.2 transforms ------------------------------------------------------------

@query("b01_map", "B01 H11", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity * 2 AS qty_x2, CAST(l_linenumber % 2 AS INTEGER) AS parity
FROM lineitem
""")
def b01_map(spark, sf):
    li = load(spark, sf, "lineitem")
    return T.map_rows(li, {"l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber"),
                           "qty_x2": F.col("l_quantity") * 2, "parity": F.col("l_linenumber") % 2})


@query("b02_flat_map", "B02 H01", oracle="""
SELECT p_partkey, tok AS token FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tok FROM part) WHERE tok <> ''
""")
def b02_flat_map(spark, sf):
    return T.flat_map_split(load(spark, sf, "part"), "p_name", " ", keep=["p_partkey"])


def _revenue_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"],
                         "revenue": pdf["l_extendedprice"] * (1 - pdf["l_discount"])})


@query("b03_map_partitions", "B03", oracle="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem
""")
def b03_map_partitions(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return T.map_partitions(li, _revenue_batch, "l_orderkey long, l_linenumber int, revenue double")


@query("b04_partition_index", "B04", oracle="SELECT count(*) AS n_rows, true AS dense, CAST(0 AS BIGINT) AS least FROM lineitem")
def b04_partition_index(spark, sf):
    """Partition numbers run from 0 without gaps and hold every row (how
    many there are depends on the file layout)."""
    li = T.with_partition_index(load(spark, sf, "lineitem").select("l_orderkey").repartition(F.col("l_orderkey")))
    per = li.groupBy("partition_id").agg(F.count(F.lit(1)).alias("cnt"))
    parts = F.max("partition_id") - F.min("partition_id") + 1
    return per.agg(F.sum("cnt").alias("n_rows"), (F.count(F.lit(1)) <= parts).alias("dense"),
                   F.min("partition_id").cast("long").alias("least"))


@query("b05_filter", "B05", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'
""")
def b05_filter(spark, sf):
    li = load(spark, sf, "lineitem")
    return (li.filter((F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))
              .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("b06_filter_by_range", "B06", oracle="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000
""")
def b06_filter_by_range(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return T.filter_by_range(o, "o_totalprice", 100000, 150000)


@query("b07_key_by", "B07", oracle="""
SELECT CAST(length(p_name) AS INTEGER) AS key, p_partkey, p_name FROM part
""")
def b07_key_by(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    return T.key_by(p, F.length("p_name"))


@query("b08_keys", "B08", oracle="SELECT c_custkey AS key FROM customer")
def b08_keys(spark, sf):
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("key"))


@query("b08_values", "B08", oracle="SELECT c_name AS value FROM customer")
def b08_values(spark, sf):
    return load(spark, sf, "customer").select(F.col("c_name").alias("value"))


@query("b09_map_values", "B09 H02", oracle="""
SELECT c_custkey, concat('name:', c_name) AS c_name FROM customer
""")
def b09_map_values(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    return T.map_values(c, "c_name", F.concat(F.lit("name:"), F.col("c_name")))


@query("b10_flat_map_values", "B10", oracle="""
SELECT p_partkey, ch FROM (
  SELECT p_partkey, unnest(string_split(p_type, '')) AS ch FROM part) WHERE ch <> ''
""")
def b10_flat_map_values(spark, sf):
    return T.flat_map_value_chars(load(spark, sf, "part"), "p_partkey", "p_type")


@query("b11_swap", "B11", oracle="""
SELECT cnt, word FROM (SELECT p_brand AS word, count(*) AS cnt FROM part GROUP BY 1)
""")
def b11_swap(spark, sf):
    counts = load(spark, sf, "part").groupBy(F.col("p_brand").alias("word")).agg(F.count(F.lit(1)).alias("cnt"))
    return T.swap(counts, "word", "cnt")


@query("b12_glom_by_bucket", "B12", oracle="""
SELECT l_orderkey AS bucket, array_to_string(list_sort(list(l_linenumber)), ',') AS items
FROM lineitem GROUP BY 1
""")
def b12_glom_by_bucket(spark, sf):
    """Glom over an explicit bucket (the order): each bucket one array row."""
    g = T.glom_by(load(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return g.select(F.col("l_orderkey").alias("bucket"), F.array_join("items", ",").alias("items"))


@query("b14_zip", "B14", oracle="""
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders),
     b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS p FROM customer)
SELECT o_orderkey, c_custkey FROM a JOIN b USING (p)
""")
def b14_zip(spark, sf):
    a = load(spark, sf, "orders").select("o_orderkey")
    b = load(spark, sf, "customer").select("c_custkey")
    return T.zip_frames(a, ["o_orderkey"], b, ["c_custkey"])


@query("b15_zip_partitions", "B15", oracle="""
WITH a AS (SELECT c_custkey, c_custkey % 8 AS bucket,
                  row_number() OVER (PARTITION BY c_custkey % 8 ORDER BY c_custkey) AS position FROM customer),
     b AS (SELECT s_suppkey, s_suppkey % 8 AS bucket,
                  row_number() OVER (PARTITION BY s_suppkey % 8 ORDER BY s_suppkey) AS position FROM supplier),
     c AS (SELECT p_partkey, p_partkey % 8 AS bucket,
                  row_number() OVER (PARTITION BY p_partkey % 8 ORDER BY p_partkey) AS position FROM part)
SELECT CAST(bucket AS BIGINT) AS bucket, CAST(position AS INTEGER) AS position, c_custkey, s_suppkey, p_partkey
FROM a JOIN b USING (bucket, position) JOIN c USING (bucket, position)
""")
def b15_zip_partitions(spark, sf):
    a = load(spark, sf, "customer").select("c_custkey", F.pmod("c_custkey", F.lit(8)).alias("b"))
    b = load(spark, sf, "supplier").select("s_suppkey", F.pmod("s_suppkey", F.lit(8)).alias("b"))
    c = load(spark, sf, "part").select("p_partkey", F.pmod("p_partkey", F.lit(8)).alias("b"))
    return T.zip_partitions([(a, "b", [F.col("c_custkey")]), (b, "b", [F.col("s_suppkey")]),
                             (c, "b", [F.col("p_partkey")])])


@query("b16_zip_with_index", "B16 E03", oracle="""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS index FROM orders
""")
def b16_zip_with_index(spark, sf):
    from tidemill.operators.ranking import zip_with_index
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return zip_with_index(o, ["o_totalprice", "o_orderkey"])


@query("b17_unique_id", "B17", oracle="""
SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem
""")
def b17_unique_id(spark, sf):
    """Property check as a result: as many distinct ids as rows."""
    li = T.zip_with_unique_id(load(spark, sf, "lineitem").select("l_orderkey"))
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("uid").alias("n_ids"))


@query("b18_split_tags", "B18", oracle="""
SELECT l_orderkey, l_linenumber,
       concat_ws(',', CASE WHEN l_quantity > 40 THEN 'big' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END,
                 CASE WHEN l_discount >= 0.09 THEN 'discounted' END) AS tags
FROM lineitem WHERE l_quantity > 40 OR l_returnflag = 'R'
""")
def b18_split_tags(spark, sf):
    li = load(spark, sf, "lineitem")
    tagged = T.tag_rows(li, {"big": F.col("l_quantity") > 40, "returned": F.col("l_returnflag") == "R",
                             "discounted": F.col("l_discount") >= 0.09})
    sel = T.select_tags(tagged, ["big", "returned"])
    return sel.select("l_orderkey", "l_linenumber", F.array_join("tags", ",").alias("tags"))


@query("b19_co_map", "B19", oracle="""
SELECT 'customer' AS kind, c_custkey AS id, upper(c_name) AS name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, lower(s_name) FROM supplier
""")
def b19_co_map(spark, sf):
    return T.co_map(
        load(spark, sf, "customer"),
        lambda d: d.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
                           F.upper("c_name").alias("name")),
        load(spark, sf, "supplier"),
        lambda d: d.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
                           F.lower("s_name").alias("name")))


@query("b20_sql_view", "B20", oracle="""
SELECT event_type, count(*) AS cnt, count(DISTINCT user_id) AS users FROM events GROUP BY event_type
""")
def b20_sql_view(spark, sf):
    return T.sql_over(load(spark, sf, "events"), "tidemill_events_view",
                      "SELECT event_type, count(*) AS cnt, count(DISTINCT user_id) AS users "
                      "FROM tidemill_events_view GROUP BY event_type")

