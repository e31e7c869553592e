"""Property checks for sampling, partitioning and ids (survey section 5, layer 4)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions.scalar import magnitude_bucket
from tidemill.operators import sampling as SM
from tidemill.operators import transforms as T


def test_sample_bounds_and_seed(spark):
    df = spark.range(20000)
    a = SM.sample(df, 0.1, seed=3)
    n = a.count()
    assert 1500 < n < 2500
    assert a.count() == SM.sample(df, 0.1, seed=3).count()
    h = SM.hash_sample(df, F.col("id"), 0.2, seed=1)
    assert sorted(r[0] for r in h.collect()) == sorted(r[0] for r in SM.hash_sample(df.repartition(7), F.col("id"), 0.2, seed=1).collect())


def test_stratified_and_fixed_size(spark):
    df = spark.range(10000).withColumn("k", F.col("id") % 2)
    s = SM.sample_by_key(df, "k", {0: 0.5, 1: 0.0}, seed=2)
    assert s.filter("k = 1").count() == 0 and 2000 < s.count() < 3000
    assert SM.take_sample(df, 123, seed=5).count() == 123


def test_random_split_disjoint_and_complete(spark):
    df = spark.range(5000)
    parts = SM.random_split(df, [0.5, 0.3, 0.2], seed=9)
    ids = [set(r[0] for r in p.collect()) for p in parts]
    assert sum(len(i) for i in ids) == 5000 and len(set().union(*ids)) == 5000
    tagged = SM.random_split_tagged(df, [1, 1], seed=4)
    assert tagged.count() == 5000 and tagged.select("part").distinct().count() == 2


def test_hash_and_range_partitioning(spark):
    df = spark.range(3000).withColumn("k", F.col("id") % 37)
    h = SM.hash_partition(df, 6, "k").withColumn("p", F.spark_partition_id())
    assert h.groupBy("k").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0
    r = SM.range_partition(df, 6, "id").withColumn("p", F.spark_partition_id())
    spans = sorted((x["lo"], x["hi"]) for x in r.groupBy("p").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect())
    assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))
    c = SM.custom_partition(df, F.col("id"), 5).withColumn("p", F.spark_partition_id())
    assert c.groupBy("bucket").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0
    assert c.select("bucket").distinct().count() == 5


def test_unique_ids(spark):
    df = T.zip_with_unique_id(spark.range(5000).repartition(5))
    assert df.select("uid").distinct().count() == 5000


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=10 ** 7))
def test_magnitude_bucket_rule(spark, v):
    n = 4
    expect = next((i for i in range(n - 1) if v < 10 ** (i + 1)), n - 1)
    got = spark.range(1).select(magnitude_bucket(F.lit(v), n).alias("b")).first()["b"]
    assert got == expect
