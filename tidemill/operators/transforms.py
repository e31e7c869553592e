"""Row and partition transforms (survey 2.2, B01 to B20)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ranking import global_rank, zip_with_index


def map_rows(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """One output row per input row."""
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def flat_map_split(df: DataFrame, col: str, pattern: str, out: str = "token",
                   keep: Sequence[str] = (), lower: bool = False) -> DataFrame:
    """Zero or more rows per input row by splitting text on a regex;
    empty tokens are dropped."""
    src = F.lower(F.col(col)) if lower else F.col(col)
    return (df.select(*keep, F.explode(F.split(src, pattern)).alias(out))
              .filter(F.col(out) != ""))


def map_partitions(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A pandas function over each Arrow batch of every partition.

    For per-partition set-up (a connection, a model), open it before the
    loop in ``fn``'s generator form via :func:`map_partitions_iter`.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def map_partitions_iter(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                        schema: str) -> DataFrame:
    """B03, iterator form: ``fn`` sees the whole partition as a batch iterator."""
    return df.mapInPandas(fn, schema)


def with_partition_index(df: DataFrame, col: str = "partition_id") -> DataFrame:
    """Attach the physical partition number."""
    return df.withColumn(col, F.spark_partition_id())


def filter_by_range(df: DataFrame, col: str, lower, upper) -> DataFrame:
    """Lower <= key <= upper, both ends included."""
    return df.filter(F.col(col).between(lower, upper))


def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """(f(value), value)."""
    return df.withColumn(name, key)


def map_values(df: DataFrame, value: str, expr: Column) -> DataFrame:
    """New value, key and partitioning kept."""
    return df.withColumn(value, expr)


def flat_map_value_chars(df: DataFrame, key: str, value: str, out: str = "ch") -> DataFrame:
    """A text value flattened into its characters, key kept."""
    return (df.select(key, F.explode(F.split(F.col(value), "")).alias(out))
              .filter(F.col(out) != ""))


def swap(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) to (b, a)."""
    return df.select(F.col(b), F.col(a))


def glom(df: DataFrame, value: str) -> DataFrame:
    """Each physical partition to one array row.  A partition is sized
    by ``spark.sql.files.maxPartitionBytes``, which bounds the array."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
              .agg(F.collect_list(value).alias("items")))


def glom_by(df: DataFrame, bucket: str, value: str) -> DataFrame:
    """B12 over an explicit bucket column: sorted values per bucket."""
    return df.groupBy(bucket).agg(F.sort_array(F.collect_list(value)).alias("items"))


def pipe(df: DataFrame, command: str, col: str = "line") -> DataFrame:
    """Each partition's rows (as text) to a command's stdin; its
    stdout lines are the result.  RDD API: the command is per partition."""
    spark = df.sparkSession
    lines = df.rdd.map(lambda r: "\t".join("" if v is None else str(v) for v in r)).pipe(command)
    return spark.createDataFrame(lines.map(lambda s: (s,)), f"{col} string")


def zip_frames(a: DataFrame, a_order: Sequence[str], b: DataFrame, b_order: Sequence[str]) -> DataFrame:
    """Pair two datasets by position in their orders (inner: stops at
    the shorter).  Both positions come from the parallel ``zip_with_index``."""
    ia = zip_with_index(a, a_order, index_col="_pos")
    ib = zip_with_index(b, b_order, index_col="_pos")
    return ia.join(ib, "_pos").drop("_pos")


def zip_partitions(frames: Sequence[tuple[DataFrame, str, Sequence[Column]]]) -> DataFrame:
    """Zip several inputs bucket by bucket and position by position.

    Each item is (frame, bucket column, order inside the bucket).  Rows
    with the same (bucket, position) are joined; a bucket stops at its
    shortest input, as zipping iterators does.  Positions come from one
    parallel rank over (bucket, order) less the rows of lower buckets, so a
    bucket is not numbered by one task.
    """
    out = None
    for df, bucket, order in frames:
        names = [f"_o{j}" for j in range(len(order))]
        part = df.withColumnRenamed(bucket, "_bucket").withColumns(dict(zip(names, order)))
        ranked = global_rank(part, ["_bucket", *names], rank_col="_rank").drop(*names)
        below = ranked.groupBy("_bucket").agg((F.min("_rank") - 1).alias("_below"))
        part = ranked.join(below, "_bucket").withColumn("_pos", (F.col("_rank") - F.col("_below")).cast("int")).drop("_rank", "_below")
        out = part if out is None else out.join(part, ["_bucket", "_pos"])
    return out.withColumnRenamed("_bucket", "bucket").withColumnRenamed("_pos", "position")


def zip_with_unique_id(df: DataFrame, col: str = "uid") -> DataFrame:
    """Unique, not dense ids, without a job."""
    return df.withColumn(col, F.monotonically_increasing_id())


def tag_rows(df: DataFrame, rules: Mapping[str, Column], col: str = "tags") -> DataFrame:
    """Each row gets every tag whose rule holds."""
    tags = F.array(*[F.when(cond, F.lit(tag)) for tag, cond in rules.items()])
    return df.withColumn(col, F.filter(tags, lambda t: t.isNotNull()))


def select_tags(df: DataFrame, wanted: Sequence[str], col: str = "tags") -> DataFrame:
    """Rows having any of the wanted tags, each row once."""
    return df.filter(F.arrays_overlap(F.col(col), F.array(*[F.lit(t) for t in wanted])))


def co_map(left: DataFrame, left_fn: Callable[[DataFrame], DataFrame],
           right: DataFrame, right_fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two differently typed inputs, one function per side, one output
    schema (by name)."""
    return left_fn(left).unionByName(right_fn(right))


def sql_over(df: DataFrame, view: str, sql: str) -> DataFrame:
    """A temp view over a (micro-)batch and SQL text over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
