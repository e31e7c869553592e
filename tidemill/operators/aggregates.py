"""Aggregations (survey 2.4, D01 to D24).

Everything is an ``agg`` over built-in aggregate functions, so Spark runs
a partial aggregate before each shuffle.  Operators whose result depends
on the partition layout in the RDD API (``aggregateByKey`` and ``fold``
with a zero value) take an explicit bucket column instead, so the result
is reproducible and independent of the physical partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def reduce_by_key(df: DataFrame, key, value: str, how: str = "sum", out: str | None = None) -> DataFrame:
    """Associative combine per key (sum, max, min, count)."""
    fn = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[how]
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(fn(value).alias(out or f"{how}_{value}"))


def group_values(df: DataFrame, key: Column | str, value: Column | str, order: Column | str | None = None,
                 sep: str | None = None, key_name: str = "key", out: str = "values") -> DataFrame:
    """Values per key (or per f(row)) as a list ordered by
    ``order`` (default: the values themselves), or joined to text with
    ``sep``.  Use where a key's fan-out is bounded."""
    v = _c(value)
    if order is None:
        lst = F.array_sort(F.collect_list(v))
    else:
        pairs = F.array_sort(F.collect_list(F.struct(_c(order).alias("o"), v.alias("v"))))
        lst = F.transform(pairs, lambda s: s["v"])
    if sep is not None:
        lst = F.array_join(F.transform(lst, lambda x: x.cast("string")), sep)
    return df.groupBy(_c(key).alias(key_name)).agg(lst.alias(out))


def aggregate_by_key(df: DataFrame, key: str, value: str, bucket: Column | str, zero,
                     seq: str = "max", comb: str = "sum", out: str = "result") -> DataFrame:
    """``aggregateByKey(zero)(seqOp, combOp)`` with the zero applied once
    per (key, bucket), then buckets combined.  seq is max or sum."""
    if seq == "max":
        part = F.greatest(F.lit(zero), F.max(value))
    elif seq == "sum":
        part = F.lit(zero) + F.sum(value)
    else:
        raise ValueError(seq)
    partial = df.groupBy(key, _c(bucket).alias("_bucket")).agg(part.alias("_p"))
    final = {"sum": F.sum, "max": F.max, "min": F.min}[comb]
    return partial.groupBy(key).agg(final("_p").alias(out))


def mean_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """combineByKey to (sum, count), then the mean."""
    return (df.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
              .withColumn("mean", F.col("total") / F.col("n")))


def fold_by_key_text(df: DataFrame, key: str, value: str, order: str, out: str = "folded") -> DataFrame:
    """``foldByKey("")(_ + _ + " ")``: each value followed by a space,
    in ``order``."""
    g = group_values(df, key, F.col(value).cast("string"), order=order, key_name=key, out="_l")
    return g.select(key, F.concat(F.array_join("_l", " "), F.lit(" ")).alias(out))


def signed_fold(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """D07, order-dependent reduce ``f(x, y) = y even ? x - y : x + y``.

    The step only adds a term that depends on ``y``, so the fold equals the
    first value plus the terms of all later values: three plain aggregates,
    no collection of the data.
    """
    v = F.col(value)
    term = F.when(v % 2 == 0, -v).otherwise(v)
    first = F.min_by(v, F.struct(*order))
    first_term = F.min_by(term, F.struct(*order))
    return df.agg((first + F.sum(term) - first_term).alias("folded"))


def fold_with_zero(df: DataFrame, value: str, bucket: Column | str, zero) -> DataFrame:
    """``fold(zero)(+)``: zero added once per bucket and once at the end."""
    per = df.groupBy(_c(bucket).alias("_b")).agg((F.sum(value) + F.lit(zero)).alias("_p"))
    return per.agg((F.sum("_p") + F.lit(zero)).alias("folded"))


def aggregate_all(df: DataFrame, value: str, bucket: Column | str | None = None, zero=0) -> DataFrame:
    """``aggregate`` to (sum, count) with the zero per bucket (or none)."""
    if bucket is None:
        return df.agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    per = df.groupBy(_c(bucket).alias("_b")).agg((F.lit(zero) + F.sum(value)).alias("_s"),
                                                  F.count(value).alias("_n"))
    return per.agg((F.lit(zero) + F.sum("_s")).alias("total"), F.sum("_n").alias("n"))


def product_all(df: DataFrame, value: str) -> DataFrame:
    """D09 with a product accumulator."""
    return df.agg(F.product(value).alias("product"), F.sum(value).alias("total"),
                  F.count(value).alias("n"))


def text_aggregate(df: DataFrame, value: str, bucket: Column, order: Sequence[str], zero: str = "", group: int = 4096) -> DataFrame:
    """D09 with a text accumulator: ``aggregate(zero)(_ + _, _ + _)`` over numbered buckets.

    The text is as long as the input, so it comes as rows (at, piece): each
    piece with the place where it begins, the zero once for the whole and once
    for each bucket.  ``bucket`` is an integer expression, ``order`` a total
    order inside a bucket; a null value adds nothing.  Places are running sums
    inside buckets, of buckets inside groups of ``group``, and of groups, so no
    task sums over all rows or all buckets.
    """
    rows = df.where(F.col(value).isNotNull()).select(bucket.cast("long").alias("_b"), *order, F.col(value).cast("string").alias("piece"))
    before = (Window.unboundedPreceding, -1)

    def sum_before(col: str, w) -> Column:
        return F.coalesce(F.sum(col).over(w.rowsBetween(*before)), F.lit(0))

    per = rows.groupBy("_b").agg((F.sum(F.length("piece")) + len(zero)).alias("_n")).withColumn("_g", F.floor(F.col("_b") / F.lit(group)))
    groups = per.groupBy("_g").agg(F.sum("_n").alias("_n")).select("_g", (sum_before("_n", Window.orderBy("_g")) + len(zero)).alias("_to_g"))
    starts = per.join(groups, "_g").select("_b", (F.col("_to_g") + sum_before("_n", Window.partitionBy("_g").orderBy("_b"))).alias("_to_b"))
    placed = rows.withColumn("_len", F.length("piece")).withColumn("_in", sum_before("_len", Window.partitionBy("_b").orderBy(*order)))
    out = placed.join(starts, "_b").select((F.col("_to_b") + len(zero) + F.col("_in")).alias("at"), "piece")
    if not zero:
        return out
    whole = df.sparkSession.range(1).select(F.col("id").alias("at"), F.lit(zero).alias("piece"))
    return out.unionByName(starts.select(F.col("_to_b").alias("at"), F.lit(zero).alias("piece"))).unionByName(whole)


def keep_first(saved: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert that keeps what is saved: rows of ``new`` whose key is
    there already are dropped (null keys are equal)."""
    have = saved.select(*[F.col(k).alias(f"_h_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return saved.unionByName(new.join(have, same, "left_anti"))


def tree_aggregate(df: DataFrame, value: str, salt: Column, fanouts: Sequence[int] = (64, 8),
                   how: str = "sum") -> DataFrame:
    """Multi-level combine.  Level i groups on ``salt % fanouts[i]``,
    so no single task receives all partial results; the last level is one
    row."""
    fn = {"sum": F.sum, "max": F.max, "min": F.min}[how]
    cur = df.select(salt.alias("_salt"), F.col(value).alias("_v"))
    for k in fanouts:
        cur = cur.groupBy(F.pmod(F.col("_salt"), F.lit(k)).alias("_salt")).agg(fn("_v").alias("_v"))
    return cur.agg(fn("_v").alias("result"))


def count_by(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Rows per key, or per distinct whole value."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def stats(df: DataFrame, value: str) -> DataFrame:
    """Count, sum, mean, max, min, population variance and
    deviation in one pass."""
    v = F.col(value)
    return df.agg(F.count(v).alias("cnt"), F.sum(v).alias("total"), F.avg(v).alias("mean"),
                  F.max(v).alias("max"), F.min(v).alias("min"),
                  F.var_pop(v).alias("variance"), F.stddev_pop(v).alias("stdev"))


def histogram_even(df: DataFrame, value: str, n: int) -> DataFrame:
    """``n`` even buckets from min to max, left closed, the last one
    closed on both ends; empty buckets are reported with 0.  Nulls are not
    counted.  If all values are equal there is one bucket with all of them,
    and without values there is none.

    Pass 1 is a one-row min/max aggregate, joined back as a broadcast of
    that single row; pass 2 counts per bucket with partial aggregation.
    """
    spark = df.sparkSession
    bounds = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(n)
    flat = F.col("_hi") == F.col("_lo")
    idx = F.when(flat, F.lit(0)).otherwise(F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(n - 1))).cast("int")
    counted = (df.select(value).filter(F.col(value).isNotNull()).crossJoin(F.broadcast(bounds))
                 .groupBy(idx.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt")))
    grid = (spark.range(n).select(F.col("id").cast("int").alias("bucket")).crossJoin(F.broadcast(bounds))
                 .filter(F.col("_lo").isNotNull() & (~flat | (F.col("bucket") == 0))))
    return (grid.join(counted, "bucket", "left")
                .select("bucket",
                        (F.col("_lo") + F.col("bucket") * (F.col("_hi") - F.col("_lo")) / F.lit(n)).alias("lower"),
                        F.coalesce("cnt", F.lit(0)).alias("cnt")))


def histogram_bounds(df: DataFrame, value: str, bounds: Sequence[float]) -> DataFrame:
    """Counts per caller-given sorted bounds; bucket i is
    [b_i, b_{i+1}), the last is closed.  Values outside are not counted.
    The bucket index is an expression over the literal bounds array."""
    spark = df.sparkSession
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    v = F.col(value).cast("double")
    nb = len(bounds) - 1
    idx = F.least(F.size(F.filter(arr, lambda b: b <= v)) - 1, F.lit(nb - 1))
    inside = (v >= F.lit(float(bounds[0]))) & (v <= F.lit(float(bounds[-1])))
    counted = (df.filter(inside).groupBy(idx.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt")))
    grid = spark.createDataFrame([(i, float(bounds[i]), float(bounds[i + 1])) for i in range(nb)],
                                 "bucket int, lower double, upper double")
    return (F.broadcast(grid).join(counted, "bucket", "left")
            .select("bucket", "lower", "upper", F.coalesce("cnt", F.lit(0)).alias("cnt")))


# Fixed values of the reference's bitmap distinct count: one hash with
# seed 61, bitmap of 2^27 bits.
BITMAP_SEED = 61
BITMAP_BITS = 27


def bitmap_hash(text: Column, seed: int = BITMAP_SEED, bits: int = BITMAP_BITS) -> Column:
    """``r = r * (seed + 1) + char`` over the characters, masked to
    ``bits`` bits.  Masking after every step keeps the low bits the same as
    the 64-bit wrapping original and never overflows."""
    mask = (1 << bits) - 1
    codes = F.transform(F.split(text, ""), lambda ch: F.ascii(ch).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"),
                       lambda acc, c: (acc * F.lit(seed + 1) + c).bitwiseAND(F.lit(mask)))


def bitmap_distinct_count(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct bitmap positions of the value per group; hash collisions
    undercount exactly as a one-hash bitmap does."""
    return (df.withColumn("_bit", bitmap_hash(F.col(value).cast("string")))
              .groupBy(*keys).agg(F.count_distinct("_bit").alias("uv")))


def with_counters(df: DataFrame, name: str, **conds: Column) -> tuple[DataFrame, Observation]:
    """Job counters.  ``conds`` maps a counter name to a condition; the
    counts are read from the returned ``Observation`` after an action."""
    obs = Observation(name)
    metrics = [F.count_if(c).alias(k) for k, c in conds.items()]
    return df.observe(obs, *metrics), obs


def counter_totals(df: DataFrame, **conds: Column) -> DataFrame:
    """D23 as a one-row result: the same counters as an aggregate."""
    return df.agg(*[F.count_if(c).alias(k) for k, c in conds.items()])
