"""Nulls, ties, constants and exact arithmetic beyond what the driver tables hold."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from common import rows
from tidemill import session
from tidemill.functions import scalar as S
from tidemill.operators import aggregates as A
from tidemill.operators import joins as J
from tidemill.operators import patterns as P
from tidemill.operators import sampling as SM
from tidemill.streaming import sinks as SK


def t(h, m=0):
    return dt.datetime(2024, 1, 1 + h // 24, h % 24, m)


def test_running_total_keeps_null_keys_and_times(spark):
    df = spark.createDataFrame([("a", t(1), 1, 5), ("a", t(30), 2, 6), (None, t(2), 3, 7), (None, t(50), 4, 8), ("a", None, 5, 9), (None, None, 6, 1)],
                               "k string, ts timestamp, i long, v long")
    plain = df.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("ts", "i").rowsBetween(Window.unboundedPreceding, 0)))
    got = P.running_total_bucketed(df, ["k"], "ts", "i", "v", out="r")
    assert rows(got, "i", "k", "r") == rows(plain, "i", "k", "r") and got.count() == 6


def test_histogram_nulls_and_constant(spark):
    h = A.histogram_even(spark.createDataFrame([(1.0,), (2.0,), (11.0,), (None,), (None,)], "v double"), "v", 5)
    assert rows(h, "bucket", "cnt") == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]
    assert rows(A.histogram_even(spark.createDataFrame([(3,), (3,), (None,)], "v int"), "v", 4), "bucket", "lower", "cnt") == [(0, 3.0, 2)]
    assert A.histogram_even(spark.createDataFrame([(None,)], "v int"), "v", 4).count() == 0


def test_context_join_null_keys_and_ties(spark):
    server = spark.createDataFrame([("a", t(1), 5), ("a", t(1), 9), ("a", t(1), 7), (None, t(1), 1), ("b", None, 3)], "k string, ts timestamp, c int")
    client = spark.createDataFrame([("a", t(1, 10), 1), (None, t(1, 10), 2), ("b", t(1), 3), ("b", None, 4), ("a", t(9), 5)], "k string, ts timestamp, i int")
    out = J.asof_context_join(client, server, ["k"], "ts", 3600, carry=["c"])
    assert rows(out, "i", "ctx_c") == [(1, 9), (2, None), (3, None), (4, None), (5, None)]


def test_exact_integer_division(spark):
    df = spark.createDataFrame([(9007199254740993, 1), (-7, 2), (7, -2)], "a long, b long")
    assert [r[0] for r in df.select(S.int_div(F.col("a"), F.col("b"))).collect()] == [9007199254740993, -3, -3]


def test_separator_of_two_characters(spark):
    df = spark.createDataFrame([("1^A2^A33",)], "t string")
    assert df.select(S.tokenize(F.col("t"), S.SEPARATORS["ctrl_a"])).first()[0] == ["1", "2", "33"]


def test_partition_of_text_and_null_keys(spark):
    df = spark.createDataFrame([("abc",), ("cab",), (None,), ("12",)], "k string")
    a, b, none, number = (r[0] for r in df.select(SM.bucket_of(F.col("k"), 7)).collect())
    assert a == b and 0 <= a < 7 and none == 0 and number == 5
    assert [r[0] for r in spark.createDataFrame([(-1,), (8,), (None,)], "k long").select(SM.bucket_of(F.col("k"), 7)).collect()] == [6, 1, 0]


def test_small_hash_sample_is_not_empty(spark):
    n = SM.hash_sample(spark.range(4_000_000), F.col("id"), 2e-6, seed=3).count()
    assert 1 <= n <= 40
    assert SM.hash_sample(spark.range(100), F.col("id"), 1.0).count() == 100


def test_a_damaged_ledger_is_an_error(spark, scratch):
    assert SK.read_if_there(spark, f"{scratch}/none") is None
    (__import__("pathlib").Path(scratch) / "bad").mkdir()
    with pytest.raises(AnalysisException):
        SK.read_if_there(spark, f"{scratch}/bad")


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()
    with pytest.raises(ValueError):
        session.checkpoint_dir(Fake())
