"""Queries for survey 2.14 (user-defined functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import udf as U
from tidemill.functions.time import epoch_seconds
from tidemill.operators.selection import grouped_median
from tidemill.plans.registry import query
from tidemill.sources.tables import load


@query("n01_pandas_scalar_udf", "N01", oracle="""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) AS BIGINT) AS n_words FROM documents
""")
def n01_pandas_scalar_udf(spark, sf):
    """Words per document (whole texts) by an Arrow-batched pandas UDF."""
    return load(spark, sf, "documents").select("doc_id", U.count_words("text").alias("n_words"))


@query("n01_table_function", "N01 B02", oracle="""
SELECT p_partkey, tok AS token, CAST(pos - 1 AS INTEGER) AS position FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tok, generate_subscripts(string_split(p_name, ' '), 1) AS pos
  FROM part) WHERE tok <> ''
""")
def n01_table_function(spark, sf):
    """A Python table function (flat-map) over part names, a batch at a time."""
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    return p.mapInPandas(U.tokens, "p_partkey long, token string, position int")


@query("n02_grouped_agg_udf", "N02", oracle="""
SELECT l_orderkey, round(avg(l_quantity), 4) AS mean_qty FROM lineitem GROUP BY 1
""")
def n02_grouped_agg_udf(spark, sf):
    """Mean quantity per order by a custom aggregate with partial merging."""
    li = load(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("double").alias("q"))
    out = U.custom_aggregate(li, "l_orderkey", "q", U.MeanAggregate, out="mean_qty")
    return out.withColumn("mean_qty", F.round("mean_qty", 4))


@query("n03_window_function_as_code", "N03 J14", oracle="""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, event_type, count(*) AS n,
       round(median(value), 4) AS median
FROM events GROUP BY 1, 2
""")
def n03_window_function_as_code(spark, sf):
    """A statistic of all rows of each (1 h window, event type): the exact
    median, by distributed selection, so no task sees a whole window."""
    ev = load(spark, sf, "events")
    sec = epoch_seconds("ts")
    ev = ev.select((sec - F.pmod(sec, F.lit(3600))).alias("window_start"), "event_type", "value")
    out = grouped_median(ev, ["window_start", "event_type"], "value")
    return out.withColumn("median", F.round("median", 4))
