"""Queries for survey 2.12: the versioned cell table.

The table is ``customer`` unpivoted into family ``info`` (version 0) plus
one ``orders:last_order`` version per order, stamped with the order date.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.time import epoch_millis
from tidemill.operators import cells as C
from tidemill.plans.registry import query
from tidemill.sources.tables import load

QUALIFIERS = [("info", "name"), ("info", "nationkey"), ("info", "acctbal"), ("info", "mktsegment"),
              ("orders", "last_order")]


def customer_cells(spark, sf, custkey=None):
    """The cells of all customers, or of one (the typed key is filtered in the scan)."""
    customer, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    if custkey is not None:
        customer, o = customer.filter(F.col("c_custkey") == custkey), o.filter(F.col("o_custkey") == custkey)
    info = C.cells_from_table(customer, "c_custkey", "info",
                              ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], strip_prefix="c_")
    versions = o.select(F.col("o_custkey").cast("string").alias("row_key"), F.lit("orders").alias("family"),
                        F.lit("last_order").alias("qualifier"), epoch_millis("o_orderdate").alias("ts"),
                        F.col("o_orderkey").cast("string").alias("value"))
    return C.put(info, versions)


CELLS_SQL = """
cells AS (
  SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'info' AS family, q AS qualifier, CAST(0 AS BIGINT) AS ts, v AS value
  FROM (SELECT c_custkey, 'name' AS q, c_name AS v FROM customer
        UNION ALL SELECT c_custkey, 'nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
        UNION ALL SELECT c_custkey, 'acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
        UNION ALL SELECT c_custkey, 'mktsegment', c_mktsegment FROM customer)
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), 'orders', 'last_order', epoch_us(o_orderdate) // 1000, CAST(o_orderkey AS VARCHAR)
  FROM orders)"""

LATEST_SQL = """
latest AS (
  SELECT row_key, family, qualifier, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, value DESC) AS version
    FROM cells) WHERE version = 1)"""


@query("l01_put_latest", "L01", oracle=f"WITH {CELLS_SQL}, {LATEST_SQL} SELECT * FROM latest")
def l01_put_latest(spark, sf):
    return C.latest(customer_cells(spark, sf))


@query("l02_get_row", "L02", oracle=f"WITH {CELLS_SQL}, {LATEST_SQL} SELECT * FROM latest WHERE row_key = '7'")
def l02_get_row(spark, sf):
    return C.get(customer_cells(spark, sf, custkey=7), row_key="7")


@query("l02_get_column", "L02", oracle=f"""
WITH {CELLS_SQL}, {LATEST_SQL} SELECT * FROM latest WHERE family = 'orders' AND qualifier = 'last_order'
""")
def l02_get_column(spark, sf):
    return C.get(customer_cells(spark, sf), family="orders", qualifier="last_order")


@query("l03_get_versions", "L03", oracle=f"""
WITH {CELLS_SQL}
SELECT row_key, family, qualifier, ts, value, CAST(version AS INTEGER) AS version FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, value DESC) AS version
  FROM cells WHERE family = 'orders') WHERE version <= 3
""")
def l03_get_versions(spark, sf):
    return C.get_versions(customer_cells(spark, sf), 3, family="orders")


@query("l04_scan_pivot", "L04", oracle=f"""
WITH {CELLS_SQL}, {LATEST_SQL}
SELECT row_key,
       max(CASE WHEN family = 'info' AND qualifier = 'name' THEN value END) AS name,
       max(CASE WHEN family = 'info' AND qualifier = 'nationkey' THEN value END) AS nationkey,
       max(CASE WHEN family = 'info' AND qualifier = 'acctbal' THEN value END) AS acctbal,
       max(CASE WHEN family = 'info' AND qualifier = 'mktsegment' THEN value END) AS mktsegment,
       max(CASE WHEN family = 'orders' AND qualifier = 'last_order' THEN value END) AS last_order
FROM latest GROUP BY row_key
""")
def l04_scan_pivot(spark, sf):
    return C.scan(customer_cells(spark, sf), QUALIFIERS)


@query("l05_range_scan", "L05", oracle=f"""
WITH {CELLS_SQL}, {LATEST_SQL} SELECT * FROM latest WHERE row_key >= '100' AND row_key < '200' AND family = 'info'
""")
def l05_range_scan(spark, sf):
    return C.range_scan(customer_cells(spark, sf), "100", "200", F.col("family") == "info")


TOMBSTONES_SQL = """
tomb AS (
  SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'orders' AS family, NULL AS qualifier, 820454400000 AS ts
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'info', 'acctbal', 0 FROM customer WHERE c_nationkey = 3
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, NULL, 9000000000000000 FROM customer WHERE c_acctbal < 0)"""


@query("l06_delete", "L06", oracle=f"""
WITH {CELLS_SQL}, {TOMBSTONES_SQL}
SELECT * FROM cells c WHERE NOT EXISTS (
  SELECT 1 FROM tomb t WHERE t.row_key = c.row_key AND (t.family IS NULL OR t.family = c.family)
    AND (t.qualifier IS NULL OR t.qualifier = c.qualifier) AND c.ts <= t.ts)
""")
def l06_delete(spark, sf):
    """Delete the orders family up to 1996-01-01 for one segment, one column
    for one nation, and whole rows of customers in debt."""
    c = load(spark, sf, "customer")
    key = F.col("c_custkey").cast("string").alias("row_key")
    tomb = (c.filter(F.col("c_mktsegment") == "AUTOMOBILE")
             .select(key, F.lit("orders").alias("family"), F.lit(None).cast("string").alias("qualifier"),
                     F.lit(820454400000).alias("ts"))
             .unionByName(c.filter(F.col("c_nationkey") == 3)
                          .select(key, F.lit("info").alias("family"), F.lit("acctbal").alias("qualifier"),
                                  F.lit(0).cast("long").alias("ts")))
             .unionByName(c.filter(F.col("c_acctbal") < 0)
                          .select(key, F.lit(None).cast("string").alias("family"),
                                  F.lit(None).cast("string").alias("qualifier"),
                                  F.lit(9000000000000000).alias("ts"))))
    return C.delete(customer_cells(spark, sf), tomb)


@query("l07_drop_family", "L07", oracle=f"WITH {CELLS_SQL} SELECT * FROM cells WHERE family <> 'orders'")
def l07_drop_family(spark, sf):
    return C.drop_family(customer_cells(spark, sf), "orders")
