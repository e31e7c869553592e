"""Keyed state in batch form (survey 2.11: K03 to K05, K09 to K11).

Each streaming state machine of the reference has a batch equivalent
built from window functions over an explicit order; the streaming forms
live in ``tidemill.streaming.stateful``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_seconds
from tidemill.operators.ranking import global_rank


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str = "running_total") -> DataFrame:
    """Reducing state: running sum per key, one output per row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def running_text(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 prefix: str = "content: ", sep: str = " and ", out: str = "text") -> DataFrame:
    """Aggregating state: "content: a and b" with every value so far.
    The text grows with the key's row count, so keys must have bounded
    fan-out."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.concat(F.lit(prefix),
                                       F.array_join(F.collect_list(F.col(value).cast("string")).over(w), sep)))


def daily_cap(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, cap: int = 100,
              day_s: int = 86400) -> DataFrame:
    """K10 with K09: per key and event-time day, the first ``cap`` rows pass
    (``kind = 'pass'``) and the next one raises one alert (``kind =
    'alert'``); later rows of that day are dropped.  The count and the alert
    flag reset at each day boundary.

    ``row_number() <= cap + 1`` is planned as a group limit before the
    shuffle, so a hot key sends at most ``cap + 1`` rows per task.
    (The reference's Java variant passes ``cap - 1``; pass ``cap - 1`` for
    that rule.)
    """
    sec = epoch_seconds(ts)
    day = sec - F.pmod(sec, F.lit(day_s))
    w = Window.partitionBy(*keys, "day").orderBy(ts, tiebreak)
    ranked = df.withColumn("day", day).withColumn("_rn", F.row_number().over(w))
    out = ranked.filter(F.col("_rn") <= cap + 1)
    return out.withColumn("kind", F.when(F.col("_rn") <= cap, F.lit("pass")).otherwise(F.lit("alert"))).drop("_rn")


def strict_sequence(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, cond: Column,
                    length: int = 3, within_s: float = 5.0) -> DataFrame:
    """K11 keyed: ``length`` adjacent rows of a key (in event-time order) all
    meeting ``cond``, the last less than ``within_s`` after the first.
    Overlapping matches are all reported, as strict contiguity without a
    skip strategy does.  Returns the first and last row's time and id."""
    # Time buckets of ``within_s``: a match starting in bucket b ends
    # before the end of bucket b + 1, so each row is also copied into the
    # previous bucket and matches are kept only where the first row is in
    # its own bucket.  A hot key is thereby split by time.
    bucket_s = max(int(math.ceil(within_s)), 1)
    own = F.floor(epoch_seconds(ts) / F.lit(bucket_s))
    flagged = (df.withColumn("_hit", cond).withColumn("_own", own)
                 .withColumn("_bucket", F.explode(F.array(own, own - 1))))
    w = Window.partitionBy(*keys, "_bucket").orderBy(ts, tiebreak)
    ok = F.col("_hit")
    for i in range(1, length):
        ok = ok & F.coalesce(F.lead("_hit", i).over(w), F.lit(False))
    last_ts = F.lead(ts, length - 1).over(w)
    last_id = F.lead(tiebreak, length - 1).over(w)
    within_us = int(within_s * 1_000_000)
    span = F.unix_micros(last_ts.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    out = flagged.select(*keys, F.col(ts).alias("first_ts"), F.col(tiebreak).alias("first_id"),
                         (ok & (F.col("_own") == F.col("_bucket"))).alias("_ok"),
                         last_ts.alias("last_ts"), last_id.alias("last_id"), span.alias("_span"))
    return out.filter(F.col("_ok") & (F.col("_span") < within_us)).drop("_ok", "_span")


def strict_sequence_unkeyed(df: DataFrame, ts: str, tiebreak: str, cond: Column, length: int = 3,
                            within_s: float = 5.0) -> DataFrame:
    """K11 as in the source: one global event-time order, so a row of any
    key breaks a run.  Positions come from the parallel ``global_rank``
    and the run is found by equi-joins on position + i, never a
    single-task window."""
    ranked = global_rank(df.withColumn("_hit", cond), [ts, tiebreak], rank_col="_pos")
    hits = ranked.filter(F.col("_hit")).select("_pos", ts, tiebreak, *[c for c in df.columns if c not in (ts, tiebreak)])
    first = hits.select(F.col("_pos").alias("_p0"), F.col(ts).alias("first_ts"), F.col(tiebreak).alias("first_id"),
                        *[F.col(c) for c in df.columns if c not in (ts, tiebreak)])
    cur = first
    for i in range(1, length):
        nxt = hits.select((F.col("_pos") - i).alias("_p0"), F.col(ts).alias(f"_ts{i}"), F.col(tiebreak).alias(f"_id{i}"))
        cur = cur.join(nxt, "_p0")
    span = (F.unix_micros(F.col(f"_ts{length - 1}").cast("timestamp"))
            - F.unix_micros(F.col("first_ts").cast("timestamp")))
    out = cur.filter(span < int(within_s * 1_000_000))
    return (out.withColumn("last_ts", F.col(f"_ts{length - 1}")).withColumn("last_id", F.col(f"_id{length - 1}"))
               .drop("_p0", *[f"_ts{i}" for i in range(1, length)], *[f"_id{i}" for i in range(1, length)]))


def running_total_bucketed(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, value: str | None = None,
                           bucket_s: int = 86400, out: str = "running_total") -> DataFrame:
    """J01, K04 at scale: running count (``value=None``) or sum per key in
    (ts, tiebreak) order, computed per (key, time bucket)."""
    return running_totals(df, keys, ts, tiebreak, {out: F.col(value) if value else F.lit(1).cast("long")}, bucket_s)


def running_totals(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, values: dict[str, Column],
                   bucket_s: int = 86400) -> DataFrame:
    """Running sums of several expressions at once, each as the column it is
    named for, per key in (ts, tiebreak) order.

    Totals per (key, bucket) give each bucket's starting offsets (running
    sums over one row per bucket), and the window inside a bucket adds the
    rows so far.  A hot key is split into its buckets instead of being
    sorted by one task.  The join to the offsets is null-safe: rows with a
    null key are a key of their own and rows without a time come first in
    their key, as in the plain window.
    """
    keys = list(keys)
    b = df.withColumn("_b", F.floor(epoch_seconds(ts) / F.lit(bucket_s)))
    per = b.groupBy(*keys, "_b").agg(*[F.sum(v).alias(f"_s_{o}") for o, v in values.items()])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, "_b"]], *[F.sum(f"_s_{o}").over(before).alias(f"_off_{o}") for o in values])
    inside = Window.partitionBy(*keys, "_b").orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    run = b.withColumns({f"_in_{o}": F.sum(v).over(inside) for o, v in values.items()})
    same = F.lit(True)
    for k in [*keys, "_b"]:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    joined = run.join(offsets, same).withColumns({o: F.coalesce(F.col(f"_off_{o}"), F.lit(0)) + F.col(f"_in_{o}") for o in values})
    return joined.drop("_b", *[f"_o_{k}" for k in [*keys, "_b"]], *[f"{p}_{o}" for o in values for p in ("_in", "_off")])
