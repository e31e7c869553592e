"""Operators that spread one group over many tasks: sessions by block, top lists, selection, schema inference."""

import random

import pytest
from pyspark.sql import functions as F

from common import SF_SMALL, rows
from tidemill.operators import sampling as SM
from tidemill.operators import windows as W
from tidemill.operators.patterns import running_totals
from tidemill.operators.selection import grouped_median, kth_values
from tidemill.plans import registry
from tidemill.sources import formats as FMT


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def timed(spark, data):
    return spark.createDataFrame(data, "k string, s double, v double").select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "v")


@pytest.mark.parametrize("block_s", [7, 60, 86400])
def test_sessions_by_block_equal_session_window(spark, block_s):
    rng = random.Random(block_s)
    data = [(rng.choice(["a", "a", "b", None]), rng.uniform(0, 900) if rng.random() < 0.9 else float(rng.randrange(0, 900, 10)), 1.0)
            for _ in range(400)] + [("c", 10.0, 1.0), ("c", 20.0, 1.0), ("c", 30.000001, 1.0), ("c", None, 1.0)]
    df = timed(spark, data)
    for gap in (1, 10, 100):
        got = W.session_counts_by_block(df, "ts", gap, ["k"], block_s=block_s, value="v")
        want = W.session_agg(df, "ts", gap, ["k"], aggs=[F.count(F.lit(1)).alias("cnt"), F.sum("v").alias("total")])
        key = lambda r: tuple((x is not None, x) for x in r)
        cols = ["k", "session_start", "session_end", "cnt", "total"]
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == sorted((tuple(r[c] for c in cols) for r in want.collect()), key=key)


def test_a_hot_key_is_spread_over_its_blocks(spark):
    df = timed(spark, [("a", float(i * 30), 1.0) for i in range(3000)])  # one key, one session over 25 hours
    out = W.session_counts_by_block(df, "ts", 60, ["k"], block_s=3600)
    assert [r["cnt"] for r in out.collect()] == [3000]
    assert "_block" in plan(out).split("hashpartitioning(")[-1].split(")")[0]


def test_top_lists_exchange_no_block_alone(spark):
    for name in ("m03_hot_products", "m04_hot_pages"):
        p = plan(registry.QUERIES[name].fn(spark, SF_SMALL))
        parts = [x.split(")")[0] for x in p.split("hashpartitioning(")[1:]]
        assert any(x.startswith("block") and ("k#" in x or "url" in x) for x in parts)
        assert not any(x.count("#") == 1 and x.startswith("block") for x in parts)
        assert p.index("WindowGroupLimit") >= 0


def test_selection_equals_sorting(spark):
    rng = random.Random(3)
    groups = {"even": [rng.uniform(-5, 5) for _ in range(500)], "same": [2.5] * 300, "skew": [10.0 ** rng.uniform(-12, 12) for _ in range(501)],
              "one": [7.0], "two": [1.0, 2.0], "far": [-1.7e308, 1.7e308, 0.0, 1e-300], "ties": [float(rng.randrange(3)) for _ in range(99)], None: [1.0, 3.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("one", None)], "g string, v double").repartition(5)
    got = {r["g"]: r for r in kth_values(df, ["g"], "v", {"lo": (0, 0, 1), "q1": (1, 0, 4), "mid": (1, 0, 2)}, cells=8).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        s, n = sorted(vs), len(vs)
        assert (got[g]["n"], got[g]["lo"], got[g]["q1"], got[g]["mid"]) == (n, s[0], s[n // 4], s[n // 2])
    med = {r["g"]: r["median"] for r in grouped_median(df, ["g"], "v").collect()}
    assert med["two"] == 1.5 and med["even"] == (sorted(groups["even"])[249] + sorted(groups["even"])[250]) / 2
    assert grouped_median(df.limit(0), ["g"], "v").collect() == []


def test_schema_of_a_whole_batch(spark):
    lines = ['{"a": 1}'] * 500 + ['{"b": {"c": "x"}, "a": 2.5}', "not json", None, "[1, 2]", '{"d": [1, null]}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, value string").repartition(7)
    out = FMT.read_json_lines(df, keep=["i"])
    assert out.columns == ["i", "a", "b", "d"]
    got = {r["i"]: r for r in out.collect()}
    assert len(got) == len(lines) and float(got[0]["a"]) == 1.0 and float(got[500]["a"]) == 2.5
    assert got[500]["b"]["c"] == "x" and got[501]["a"] is None and got[502]["a"] is None and got[504]["d"] == [1, None]
    assert FMT.read_json_lines(df.where("i = 501"), keep=["i"]).columns == ["i"]
    assert FMT.infer_json_schema(df.limit(0)) is None


def test_running_totals_in_one_pass(spark):
    df = timed(spark, [("a", float(i * 5000 % 300_000), float(i)) for i in range(200)] + [(None, 1.0, 2.0)]).withColumn("id", F.monotonically_increasing_id())
    out = running_totals(df, ["k"], "ts", "id", {"seq": F.lit(1).cast("long"), "total": F.col("v")})
    assert plan(out).count("LogicalRDD") + plan(out).count("Scan ExistingRDD") <= 2
    got = sorted((r["seq"], r["total"]) for r in out.where("k = 'a'").collect())
    own = sorted(((float(i * 5000 % 300_000), i) for i in range(200)))
    want, acc = [], 0.0
    for n, (_, i) in enumerate(own):
        acc += i
        want.append((n + 1, acc))
    assert got == want


def test_partition_by_magnitude(spark):
    df = spark.createDataFrame([(v,) for v in (None, -3.0, 9.0, 10.0, 99.9, 1e9)], "v double")
    out = SM.magnitude_partition(df, F.col("v"), 4)
    assert out.columns == ["v", "bucket"]
    assert rows(out.where("v is not null"), "v", "bucket") == [(-3.0, 0), (9.0, 0), (10.0, 1), (99.9, 1), (1e9, 3)]
    assert out.where("v is null").first()["bucket"] == 0
