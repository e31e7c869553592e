"""Fixed-row checks (survey section 5, layer 1) for batch operators."""

import os

from pyspark.sql import functions as F

from common import DATA, rows
from tidemill.operators import aggregates as A
from tidemill.operators import joins as J
from tidemill.operators import ordering as O
from tidemill.operators import patterns as P
from tidemill.operators import ranking as R
from tidemill.operators import sets as G
from tidemill.operators import transforms as T
from tidemill.operators import windows as W
from tidemill.sources import formats as FMT

# Literal collections of the reference's samples.
PETS = [("cat", 2), ("cat", 5), ("mouse", 4), ("cat", 12), ("dog", 12), ("mouse", 2)]
LEFT_PETS = [("cat", 2), ("cat", 5), ("book", 4), ("cat", 12)]
RIGHT_PETS = [("cat", 2), ("cup", 5), ("mouse", 4), ("cat", 12)]
FRUITS = [(1, "apple"), (2, "banana"), (3, "orange"), (4, "kiwi")]
DEVICES = [(5, "computer"), (1, "laptop"), (1, "desktop"), (4, "iPad")]
NAMES = [(2, "zs"), (4, "ls"), (3, "ww"), (1, "xw"), (1, "aw"), (1, "mw")]
HISTOGRAM_VALUES = [1.0, 1.2, 1.3, 2.0, 2.1, 7.4, 7.5, 7.6, 8.8, 9.0, 11.0]
SCORES = [("huangbo", "math", 35), ("huangbo", "english", 98),
          ("xuzheng", "math", 55), ("xuzheng", "english", 72), ("xuzheng", "java", 80),
          ("wangbaoqiang", "math", 77), ("wangbaoqiang", "english", 87), ("wangbaoqiang", "scala", 67)]
KEYED_PAIRS = [(1, 3), (1, 5), (1, 7), (2, 2), (2, 4), (2, 6)]


def _pets(spark, data=PETS, parts=2):
    # bucket = the partition a 2-way split of the literal list would give
    n = len(data)
    return spark.createDataFrame([(k, v, i * parts // n) for i, (k, v) in enumerate(data)], "k string, v long, b int")


def test_aggregate_by_key_zero_per_bucket(spark):
    df = _pets(spark)
    assert rows(A.aggregate_by_key(df, "k", "v", "b", 0)) == [("cat", 17), ("dog", 12), ("mouse", 6)]
    assert rows(A.aggregate_by_key(df, "k", "v", "b", 100)) == [("cat", 200), ("dog", 100), ("mouse", 200)]


def test_fold_zero_per_bucket(spark):
    df = spark.createDataFrame([(v, (v - 1) // 3) for v in range(1, 7)], "v long, b int")
    assert A.fold_with_zero(df, "v", "b", 10).first()["folded"] == 51


def test_histogram_even(spark):
    df = spark.createDataFrame([(v,) for v in HISTOGRAM_VALUES], "x double")
    h = A.histogram_even(df, "x", 5)
    assert [r["cnt"] for r in h.orderBy("bucket").collect()] == [5, 0, 0, 4, 2]


def test_histogram_bounds(spark):
    df = spark.createDataFrame([(v,) for v in HISTOGRAM_VALUES], "x double")
    h = A.histogram_bounds(df, "x", [1.0, 3.0, 9.0, 11.0])
    assert [r["cnt"] for r in h.orderBy("bucket").collect()] == [5, 4, 2]


def test_combine_by_key_mean(spark):
    df = spark.createDataFrame(SCORES, "name string, subject string, score long")
    got = {r["name"]: r["mean"] for r in A.mean_by_key(df, "name", "score").collect()}
    assert got == {"huangbo": 66.5, "xuzheng": 69.0, "wangbaoqiang": 77.0}


def test_group_values_text(spark):
    df = spark.createDataFrame(PETS, "k string, v long")
    got = rows(A.group_values(df, "k", "v", sep="-"))
    assert got == [("cat", "2-5-12"), ("dog", "12"), ("mouse", "2-4")]


def test_fold_by_key_text(spark):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(PETS)], "k string, v long, o int")
    got = dict(rows(A.fold_by_key_text(df, "k", "v", "o")))
    assert got["cat"] == "2 5 12 " and got["mouse"] == "4 2 "


def test_signed_fold(spark):
    vals = [4, 5, 6, 7, 8, 9, 10]
    acc = vals[0]
    for y in vals[1:]:
        acc = acc - y if y % 2 == 0 else acc + y
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v long, o int")
    assert A.signed_fold(df, "v", ["o"]).first()["folded"] == acc


def test_tree_aggregate_and_stats(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"), F.col("id").alias("s"))
    assert A.tree_aggregate(df, "v", F.col("s"), (16, 4)).first()["result"] == 500500.0
    st = A.stats(df, "v").first()
    assert st["cnt"] == 1000 and st["min"] == 1.0 and st["max"] == 1000.0
    assert abs(st["variance"] - (1000 ** 2 - 1) / 12) < 1e-6


def test_outer_joins(spark):
    a = spark.createDataFrame(LEFT_PETS, "k string, a long")
    b = spark.createDataFrame(RIGHT_PETS, "k string, b long")
    # three left and two right "cat" rows pair up six ways
    assert J.join(a, b, "k").count() == 6
    left = J.null_as_text(J.join(a, b, "k", "left"), ["b"])
    assert left.count() == 7 and ("book", 4, "null") in rows(left, "k", "a", "b")
    assert J.join(a, b, "k", "right").count() == 8
    assert J.join(a, b, "k", "full").count() == 9


def test_cogroup(spark):
    a = spark.createDataFrame(FRUITS, "k long, v string")
    b = spark.createDataFrame(DEVICES, "k long, v string")
    g = {r["key"]: (r["values_0"], r["values_1"]) for r in
         J.cogroup_lists([(a, "k", F.col("v")), (b, "k", F.col("v"))]).collect()}
    assert g[1] == (["apple"], ["desktop", "laptop"])
    assert g[2] == (["banana"], [])
    assert g[5] == ([], ["computer"])
    long = J.cogroup_long([(a, "k", F.col("v")), (b, "k", F.col("v"))])
    assert long.count() == 8


def test_subtract_by_key_and_block_list(spark):
    a = spark.createDataFrame(PETS, "k string, v long")
    b = spark.createDataFrame([("cat", 0)], "k string, w long")
    assert sorted(r["k"] for r in J.subtract_by_key(a, b, "k").collect()) == ["dog", "mouse", "mouse"]
    words = spark.createDataFrame([("a",), ("?",), ("b",), ("!",), ("&",)], "w string")
    blocked = spark.createDataFrame([("?",), ("!",), ("&",)], "x string")
    assert rows(J.block_list_filter(words, "w", blocked, "x")) == [("a",), ("b",)]


def test_cross_product_of_any_size(spark):
    small, big = spark.range(3), spark.range(20_000)
    assert J.cross_with_small(big, small.withColumnRenamed("id", "j")).count() == 60_000
    assert J.cross_with_small(small, big.withColumnRenamed("id", "j")).count() == 60_000


def test_set_operations(spark):
    a = spark.createDataFrame([(v,) for v in (5, 6, 4, 3)], "v long")
    b = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "v long")
    assert G.union_all(a, b).count() == 8
    assert rows(G.intersection(a, b)) == [(3,), (4,)]
    assert rows(G.subtract(a, b)) == [(5,), (6,)]
    assert [r["v"] for r in G.union_distinct_sorted(a, b, [F.col("v")]).collect()] == [1, 2, 3, 4, 5, 6]


def test_first_n_per_group_and_sorted_first_n(spark):
    df = spark.createDataFrame(NAMES, "id long, name string")
    top = R.top_n_per_group(df, "id", [F.col("name")], 2)
    assert rows(top, "id", "name") == [(1, "aw"), (1, "mw"), (2, "zs"), (3, "ww"), (4, "ls")]
    first = O.first_n(df, [F.col("id"), F.col("name").desc()], 3).collect()
    assert [tuple(r) for r in first] == [(1, "xw"), (1, "mw"), (1, "aw")]


def test_global_rank_matches_sorted_order(spark):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2000).alias("v"), F.col("id"))
    ranked = R.global_rank(df, ["v", "id"], num_partitions=5)
    got = [r["v"] for r in ranked.orderBy("rank").collect()]
    assert got == sorted(got) and ranked.agg(F.max("rank")).first()[0] == 2000
    by_cut = R.global_rank_by_buckets(df, "v", [10, 100, 1000], ["v", "id"])
    assert rows(by_cut, "v", "id", "rank") == rows(ranked, "v", "id", "rank")


def test_pipe_first_line_per_partition(spark):
    df = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(1, 10)], 3), "v long")
    assert sorted(int(r["line"]) for r in T.pipe(df, "head -n 1").collect()) == [1, 4, 7]


def test_zip_partitions_and_zip(spark):
    a = spark.createDataFrame([(i, i % 2) for i in range(6)], "a long, b long")
    b = spark.createDataFrame([(i * 10, i % 2) for i in range(5)], "c long, b long")
    z = T.zip_partitions([(a, "b", [F.col("a")]), (b, "b", [F.col("c")])])
    assert rows(z, "bucket", "position", "a", "c") == [(0, 1, 0, 0), (0, 2, 2, 20), (0, 3, 4, 40),
                                                       (1, 1, 1, 10), (1, 2, 3, 30)]
    zz = T.zip_frames(a.select("a"), ["a"], b.select("c"), ["c"])
    assert rows(zz, "a", "c") == [(i, i * 10) for i in range(5)]


def test_map_partitions_and_index(spark):
    df = spark.createDataFrame([(2, "cat"), (6, "mouse"), (7, "cup"), (3, "book"), (4, "tv"), (1, "screen"),
                                (5, "heater")], "id long, name string").repartition(3)
    out = T.map_partitions(df, lambda p: p.assign(name=p["name"].str.upper()), "id long, name string")
    assert sorted(r["name"] for r in out.collect())[0] == "BOOK"
    idx = T.with_partition_index(df)
    assert idx.select("partition_id").distinct().count() <= 3 and idx.count() == 7


def test_count_windows(spark):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(KEYED_PAIRS)], "k long, v long, o int")
    m = W.count_window(df, ["k"], ["o"], 3, aggs=[F.avg("v").alias("mean")])
    assert rows(m, "k", "mean") == [(1, 5.0), (2, 4.0)]
    acc = W.accumulating_count_trigger(df, ["k"], ["o"], 2, "v")
    assert rows(acc, "k", "total") == [(1, 8), (2, 6)]
    sl = W.sliding_count_window(df, ["k"], ["o"], 2, 1, "v")
    assert rows(sl.filter("k = 1"), "seq", "total") == [(1, 3), (2, 8), (3, 12)]


def test_running_state_batch(spark):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(KEYED_PAIRS)], "k long, v long, o int")
    assert rows(P.running_sum(df, ["k"], ["o"], "v").filter("k = 1"), "running_total") == [(3,), (8,), (15,)]
    txt = P.running_text(df, ["k"], ["o"], "v").filter("k = 2").orderBy("o").collect()
    assert txt[-1]["text"] == "content: 2 and 4 and 6"


def test_daily_cap_on_ad_clicks(spark):
    clicks = FMT.read_delimited(spark, os.path.join(DATA, "ad_clicks.csv"),
                                "user_id long, ad_id long, province string, city string, ts long")
    clicks = clicks.withColumn("t", F.timestamp_seconds("ts")).withColumn("rid", F.monotonically_increasing_id())
    assert clicks.count() == 143
    scala_rule = P.daily_cap(clicks, ["user_id", "ad_id"], "t", "rid", cap=100)
    assert scala_rule.filter("kind = 'pass'").count() == 122
    assert scala_rule.filter("kind = 'alert'").count() == 1
    java_rule = P.daily_cap(clicks, ["user_id", "ad_id"], "t", "rid", cap=99)
    assert java_rule.filter("kind = 'pass'").count() == 121


def test_login_failure_pattern(spark):
    logins = FMT.read_delimited(spark, os.path.join(DATA, "logins.csv"),
                                "user_id long, ip string, event_type string, ts long")
    logins = logins.withColumn("t", F.timestamp_seconds("ts")).withColumn("rid", F.monotonically_increasing_id())
    got = P.strict_sequence_unkeyed(logins, "t", "rid", F.col("event_type") == "fail", length=3, within_s=5)
    out = [(r["user_id"], int(r["first_ts"].timestamp()), int(r["last_ts"].timestamp())) for r in got.collect()]
    assert out == [(1035, 1558430842, 1558430844)]


def test_word_count_file(spark):
    lines = FMT.read_text(spark, os.path.join(DATA, "words.txt"))
    words = T.flat_map_split(lines, "value", " ", out="word")
    got = dict(rows(A.count_by(words, "word")))
    assert got["Hello"] == 4 and got["Ada"] == 1 and len(got) == 5


def test_order_enrichment_files(spark):
    lines = FMT.read_delimited(spark, os.path.join(DATA, "order_lines.txt"), "order_id long, product string, price double")
    places = FMT.read_delimited(spark, os.path.join(DATA, "order_places.txt"),
                                "order_id long, order_date string, address string")
    assert J.join(lines, places, "order_id").count() == 5


def test_prefix_sliding_counts_equal_copies(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for size, slide, keys in ((7200, 1800, ["event_type"]), (600, 5, ["user_id"]), (86400, 3600, [])):
        a = W.sliding_counts(ev, "ts", size, slide, keys=keys)
        b = W.sliding_counts_prefix(ev, "ts", size, slide, keys=keys)
        cols = [*keys, "window_start", "window_end", "cnt"]
        assert rows(a, *cols) == rows(b, *cols)


def test_block_split_sliding_count_window_equals_plain(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for size, slide in ((3, 2), (5, 1)):
        plain = W.sliding_count_window(ev, ["user_id"], ["ts", "event_id"], size, slide, "value")
        split = W.sliding_count_window(ev, ["user_id"], ["ts", "event_id"], size, slide, "value",
                                       time_bucket_s=3600, block_rows=size)
        cols = ["user_id", "seq", "n_rows"]
        assert rows(plain, *cols) == rows(split, *cols)
        assert [round(r[0], 6) for r in rows(plain, "total")] == [round(r[0], 6) for r in rows(split, "total")]
