"""Text, delimited, access-log and JSON readers, and row shapes for sinks
(survey 2.1, A01 to A23)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.time import parse_time


def from_rows(spark: SparkSession, rows, schema, num_partitions: int | None = None) -> DataFrame:
    """Rows from a literal collection, with an optional partition count."""
    df = spark.createDataFrame(rows, schema)
    return df.repartition(num_partitions) if num_partitions else df


def read_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line (column ``value``)."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def split_lines(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """A02 over a text column: (keep..., line_no, line) for every line."""
    return df.select(*keep, F.posexplode(F.split(F.col(col), "\n")).alias("line_no", "line"))


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Delimited lines parsed into typed columns, surrounding spaces
    trimmed; a bad field gives null rather than failing the job."""
    return (spark.read.schema(schema)
            .option("sep", sep)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("mode", "PERMISSIVE")
            .csv(path))


# The access log's layout (space separated; fields 0, 1, 3,
# 5 and 6 are ip, user, time, method and url) and its time format.
ACCESS_LOG_FIELDS = {"ip": 0, "user": 1, "time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Space-split access-log lines to (ip, user, ts, method, url)."""
    parts = F.split(F.col(col), " ")
    return lines.select(
        parts.getItem(ACCESS_LOG_FIELDS["ip"]).alias("ip"),
        parts.getItem(ACCESS_LOG_FIELDS["user"]).alias("user"),
        parse_time(parts.getItem(ACCESS_LOG_FIELDS["time"]), ACCESS_LOG_TIME_FORMAT).alias("ts"),
        parts.getItem(ACCESS_LOG_FIELDS["method"]).alias("method"),
        parts.getItem(ACCESS_LOG_FIELDS["url"]).alias("url"))


def parse_json_lines(lines: DataFrame, schema: StructType | str, col: str = "value") -> DataFrame:
    """Each line to a typed record (nested arrays kept)."""
    return lines.select(F.from_json(F.col(col), schema).alias("r")).select("r.*")


def infer_json_schema(lines: DataFrame, col: str = "value") -> str | None:
    """The schema that fits every record of ``lines``, as DDL, or None if no line is a JSON object.

    All rows take part: each becomes a variant and one aggregate, with
    partial merging, unites their types (a field that some records lack is
    there; fields of differing types become a common or a variant one).
    Lines that are no JSON are passed over.
    """
    doc = F.try_parse_json(F.col(col))
    found = lines.select(doc.alias("v")).where(F.schema_of_variant(F.col("v")).startswith("OBJECT")).agg(
        F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("v").alias("ddl")).first()
    return found["ddl"].replace("OBJECT<", "STRUCT<") if found["n"] else None


def read_json_lines(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Records read through the schema of the whole batch: ``keep``, then one column for each field.

    A line that is no JSON object gives nulls.  Without any object only
    ``keep`` is left.
    """
    ddl = infer_json_schema(lines, col)
    if ddl is None:
        return lines.select(*keep)
    return lines.select(*keep, F.from_json(F.col(col), ddl).alias("_r")).select(*keep, "_r.*")


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines file; the schema is inferred from all lines only when none is given."""
    if schema is None:
        return read_json_lines(spark.read.text(path))
    return spark.read.schema(schema).json(path)


def kafka_payload(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """The (key, value) rows a message sink writes: key as text, value
    as JSON of the chosen columns."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in value_cols])).alias("value"))


def category_actions(lines: DataFrame) -> DataFrame:
    """M02's record: comma separated, column 7 one click id, 9 and 11 lists
    of order and pay ids joined by the two characters ``^A``; blank fields
    and blank ids are skipped.  Returns (kind, category)."""
    f = F.split("value", ",")
    ids = lambda i: F.split(F.coalesce(F.get(f, F.lit(i)), F.lit("")), r"\^A")
    every = F.array(*[F.struct(F.lit(kind).alias("kind"), ids(i).alias("ids")) for kind, i in (("click", 7), ("order", 9), ("pay", 11))])
    out = lines.select(F.explode(every).alias("a")).select("a.kind", F.explode("a.ids").alias("category"))
    return out.withColumn("category", F.trim("category")).filter(F.col("category") != "")


def friend_lists(lines: DataFrame) -> DataFrame:
    """M11's record ``id:f1,f2``: (person, friend); blank friends are skipped."""
    f = F.split("value", ":", 2)
    out = lines.select(F.trim(f[0]).alias("person"), F.explode(F.split(F.coalesce(F.get(f, F.lit(1)), F.lit("")), ",")).alias("friend"))
    return out.withColumn("friend", F.trim("friend")).filter(F.col("friend") != "")


def kafka_source_options(servers: str, topic: str, starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """A10: options for ``readStream.format("kafka")`` (subscription, start
    offsets, rate cap per trigger)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def to_text_lines(df: DataFrame, cols: Sequence[str], sep: str = "\t") -> DataFrame:
    """One text line per row (column ``value``)."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def write_text(df: DataFrame, path: str, cols: Sequence[str], sep: str = "\t", mode: str = "overwrite") -> None:
    """Write text lines; ``overwrite`` replaces earlier output."""
    to_text_lines(df, cols, sep).write.mode(mode).text(path)


def write_objects(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Serialised records (Parquet keeps the schema)."""
    df.write.mode(mode).parquet(path)


def write_sequence_file(df: DataFrame, path: str, key: str, value: str) -> None:
    """Key-value pairs as a Hadoop SequenceFile (RDD API)."""
    df.select(F.col(key).cast("string"), F.col(value).cast("string")).rdd.map(tuple).saveAsSequenceFile(path)


def read_sequence_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), "key string, value string")


def with_dt_hour(df: DataFrame, ts: str) -> DataFrame:
    """``dt=yyyyMMdd`` and ``hour=HH`` partition columns."""
    return (df.withColumn("dt", F.date_format(F.col(ts), "yyyyMMdd"))
              .withColumn("hour", F.date_format(F.col(ts), "HH")))


def write_dt_hour(df: DataFrame, ts: str, path: str, mode: str = "append") -> None:
    """Parquet under ``dt=.../hour=...``; rows are clustered by the
    partition columns first so each task writes few files."""
    out = with_dt_hour(df, ts)
    out.repartition("dt", "hour").write.mode(mode).partitionBy("dt", "hour").parquet(path)


def for_each_partition(df: DataFrame, fn) -> None:
    """A side-effect callback over each partition's row iterator."""
    df.foreachPartition(fn)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 500,
               properties: dict | None = None) -> None:
    """Rows to a database table, ``batch_size`` rows per commit, one
    connection per partition (Spark's JDBC writer)."""
    props = {"batchsize": str(batch_size)}
    props.update(properties or {})
    df.write.mode(mode).jdbc(url, table, properties=props)


def tagged_union(frames: Sequence[tuple[str, DataFrame]], tag: str = "kind") -> DataFrame:
    """Side outputs: one frame with a ``kind`` column, split again at the sink."""
    out = None
    for name, df in frames:
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def split_by_tag(df: DataFrame, tag: str, value: str) -> DataFrame:
    return df.filter(F.col(tag) == F.lit(value)).drop(tag)

