"""Readers for the driver tables (one Parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_with_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the item id parsed from ``props`` (``{"k": n}``)."""
    ev = load(spark, sf_dir, "events")
    return ev.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
