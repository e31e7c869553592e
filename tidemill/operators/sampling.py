"""Sampling and partitioning (survey 2.9, I01 to I07)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import magnitude_bucket


def sample(df: DataFrame, fraction: float, with_replacement: bool = False, seed: int | None = None) -> DataFrame:
    """Bernoulli (or Poisson with replacement) sample, per partition."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: Column, fraction: float, seed: int = 0) -> DataFrame:
    """I01, checkable form: keep a row when 60 bits of the md5 of seed and
    key fall under the fraction; the same key set comes back for any
    partitioning, and from any engine.  Rows with a null key are sampled
    together, as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return df.filter(h < F.lit(min(int(fraction * 2 ** 60), 2 ** 60)))


def sample_by_key(df: DataFrame, col: str, fractions: Mapping, seed: int | None = None) -> DataFrame:
    """Stratified sample, one fraction per key (missing keys: 0)."""
    return df.sampleBy(col, dict(fractions), seed)


def take_sample(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``min(n, count)`` rows without replacement.  Each task
    keeps its ``n`` lowest random tags (TakeOrderedAndProject), so only
    ``n`` rows per task reach the merge."""
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Disjoint parts whose union is the input."""
    return df.randomSplit(list(weights), seed)


def random_split_tagged(df: DataFrame, weights: Sequence[float], seed: int = 0) -> DataFrame:
    """I04 as one frame with a ``part`` column (one pass, same assignment
    rule: a uniform draw against cumulative weights)."""
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in weights:
        acc += w / total
        edges.append(acc)
    r = F.rand(seed)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        part = F.when(r < F.lit(edges[i]), F.lit(i)).otherwise(part)
    return df.withColumn("part", part)


def hash_partition(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Equal keys share a partition."""
    return df.repartition(n, *cols)


def range_partition(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Key ranges per partition, bounds from a sample of the keys."""
    return df.repartitionByRange(n, *cols)


def bucket_of(key: Column, n: int) -> Column:
    """Custom partitioner: null to 0, integers modulo ``n`` (never
    negative, unlike the source's ``%``), text by the sum of its character
    codes modulo ``n``."""
    codes = F.transform(F.split(key.cast("string"), ""), lambda c: F.ascii(c).cast("long"))
    text = F.pmod(F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + c), F.lit(n))
    whole = key.try_cast("long") if hasattr(key, "try_cast") else F.expr("null")
    return F.coalesce(F.pmod(whole, F.lit(n)), text, F.lit(0)).cast("int")


def custom_partition(df: DataFrame, key: Column, n: int, bucket_col: str = "bucket") -> DataFrame:
    """An explicit bucket column, then hash-partition on it: all rows
    of a bucket share one partition (which partition is the hash's choice,
    as DataFrames have no user partitioner)."""
    return df.withColumn(bucket_col, bucket_of(key, n)).repartition(n, bucket_col)


def magnitude_partition(df: DataFrame, value: Column, n: int, bucket_col: str = "bucket") -> DataFrame:
    """I07 by magnitude: values below 10 to bucket 0, below 100 to 1, and so
    on, the largest to ``n - 1`` (nulls to 0).  The exchange is on the bucket
    and a spread within it, so a bucket most values fall in is no one task's."""
    bucket = F.when(value.isNull(), 0).otherwise(magnitude_bucket(value, n)).cast("int")
    spread = F.pmod(F.xxhash64(value), F.lit(n))
    return df.withColumn(bucket_col, bucket).withColumn("_spread", spread).repartition(bucket_col, "_spread").drop("_spread")
