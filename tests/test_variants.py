"""Readers and small variants without a driver table of their own."""

import pandas as pd
from pyspark.sql import functions as F

from common import rows
from tidemill.operators import aggregates as A
from tidemill.operators import ordering as O
from tidemill.sources import formats as FMT


def test_category_record(spark):
    lines = ["0,1,2,3,4,5,6,c1,8,o1^Ao2^A,10,p1", "0,1,2,3,4,5,6,,8,,10, p1 ^Ap2", "short,line"]
    got = FMT.category_actions(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(got) == [("click", "c1"), ("order", "o1"), ("order", "o2"), ("pay", "p1"), ("pay", "p1"), ("pay", "p2")]


def test_friend_record(spark):
    got = FMT.friend_lists(spark.createDataFrame([("1:2,3",), ("2: 1 ,",), ("3:",), ("4",)], "value string"))
    assert rows(got) == [("1", "2"), ("1", "3"), ("2", "1")]


def test_kafka_options():
    assert FMT.kafka_source_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest"}
    full = FMT.kafka_source_options("h:9092", "t", "earliest", 50)
    assert full["startingOffsets"] == "earliest" and full["maxOffsetsPerTrigger"] == "50"


def test_keep_first_with_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([("x", 9), (None, 8), ("y", 7)], "k string, v int")
    assert sorted(r["v"] for r in A.keep_first(a, b, ["k"]).collect()) == [1, 2, 7]


def text_of(df):
    got, text = sorted(df.collect(), key=lambda r: r["at"]), ""
    for r in got:
        assert r["at"] == len(text)
        text += r["piece"]
    return text


def test_text_aggregate(spark):
    df = spark.createDataFrame([(i, c, i // 3) for i, c in enumerate("abcdef")], "i long, v string, b long").repartition(4)
    assert text_of(A.text_aggregate(df, "v", F.col("b"), ["i"])) == "abcdef"
    for group in (1, 2, 4096):
        assert text_of(A.text_aggregate(df, "v", F.col("b"), ["i"], "x", group)) == "xxabcxdef"
    odd = spark.createDataFrame([(1, "é", -5), (2, None, -5), (3, "", 0), (4, "yz", 9000), (5, None, 7)], "i long, v string, b long")
    assert text_of(A.text_aggregate(odd, "v", F.col("b"), ["i"], "..")) == "....é....yz"
    assert text_of(A.text_aggregate(odd.where("i > 9"), "v", F.col("b"), ["i"], "x")) == "x"


def test_runs_that_span_batches():
    frames = [pd.DataFrame({"k": [1, 1, 2], "v": [1, 2, 3]}), pd.DataFrame({"k": [2, 2, 3], "v": [4, 5, 6]}), pd.DataFrame({"k": [3], "v": [7]})]
    got = pd.concat(list(O.first_of_each_run("k", 2)(iter(frames))))
    assert got["v"].tolist() == [1, 2, 3, 4, 6, 7]
