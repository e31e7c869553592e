"""Replay-safe ``foreachBatch`` sinks (survey A15, A16, A18, K07, C14).

A micro-batch can run twice (a restart after a failure replays the last
uncommitted batch), so every sink here writes by batch id with overwrite
or skips a batch id it has already committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ranking import global_rank


def read_if_there(spark, path: str, schema: str | None = None):
    """The saved table, or None before anything was saved.  Only a missing
    path counts as that; a damaged or incompatible table is an error."""
    try:
        r = spark.read
        if schema:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def drop_batch(spark, folder: str) -> None:
    """Remove the saved rows of a batch that no replay can ask for any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def jdbc_batch_writer(url: str, table: str, batch_size: int = 500, properties: dict | None = None):
    """Each micro-batch appended to a database table, ``batch_size``
    rows per commit, one connection per partition.  The rows of the same
    batch id are deleted first, so a replayed batch replaces itself (also
    after a run that stopped half-way)."""
    props = {"batchsize": str(batch_size)}
    props.update(properties or {})

    def delete(spark, batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        info = jvm.java.util.Properties()
        for k, v in props.items():
            info.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(url, info)
        try:
            if any(conn.getMetaData().getTables(None, None, t, None).next() for t in {table, table.upper(), table.lower()}):
                conn.createStatement().executeUpdate(f"DELETE FROM {table} WHERE \"batch_id\" = {int(batch_id)}")
        finally:
            conn.close()

    def run(batch: DataFrame, batch_id: int) -> None:
        delete(batch.sparkSession, batch_id)
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").jdbc(url, table, properties=props)
    return run


class IdempotentBatchWriter:
    """Results and the batch id are committed together: the batch's
    rows go to ``path/batch_id=N`` with overwrite and a ledger row records
    N; a batch already in the ledger is skipped, so a replay neither
    duplicates nor loses rows.  Only the last batch can be replayed, so the
    ledger keeps the last two."""

    def __init__(self, path: str, ledger_path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.ledger_path, self.transform = path, ledger_path, transform

    def is_committed(self, spark, batch_id: int) -> bool:
        return read_if_there(spark, f"{self.ledger_path}/b={batch_id}", "batch_id long") is not None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.is_committed(spark, batch_id):
            return
        out = self.transform(batch) if self.transform else batch
        out.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("overwrite").parquet(
            f"{self.ledger_path}/b={batch_id}")
        drop_batch(spark, f"{self.ledger_path}/b={batch_id - 2}")


class BufferedSink:
    """Rows are flushed in groups of ``threshold``; the remainder waits
    in a pending table (saved per batch id, the last two kept) and survives a
    restart.

    Flushed rows go to ``path/batch_id=N``.  Group membership follows the
    ``order`` column and then all others.  The rows are numbered in parallel
    by ranges (``global_rank``), whose saved copy both outputs read, so a
    tied row is in exactly one."""

    def __init__(self, threshold: int, order: str, path: str, pending_path: str):
        self.threshold, self.order, self.path, self.pending_path = threshold, order, path, pending_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = read_if_there(spark, f"{self.pending_path}/b={batch_id - 1}")
        both = batch if prev is None else prev.unionByName(batch.select(*prev.columns))
        numbered = global_rank(both, [self.order, *[c for c in both.columns if c != self.order]], rank_col="_i")
        full = (numbered.count() // self.threshold) * self.threshold
        numbered.filter(F.col("_i") <= full).drop("_i").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        numbered.filter(F.col("_i") > full).drop("_i").write.mode("overwrite").parquet(f"{self.pending_path}/b={batch_id}")
        drop_batch(spark, f"{self.pending_path}/b={batch_id - 2}")


def retry_round(pending: DataFrame, context: DataFrame, keys: list[str], max_retries: int = 5):
    """C14: one retry round over unmatched rows.

    Rows that now find their context are emitted (``matched``); rows still
    missing go back with ``retry_count + 1`` while the incoming count is
    below ``max_retries``, and are emitted as they are otherwise.  Unlike
    the source, rows younger than the retry delay are kept, not dropped.
    Returns (emitted, still_pending)."""
    ctx = context.select(*keys, F.lit(True).alias("_hit")).dropDuplicates(keys)
    j = pending.join(ctx, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    emitted = j.filter(hit | (F.col("retry_count") >= max_retries)).withColumn("matched", hit).drop("_hit")
    again = (j.filter(~hit & (F.col("retry_count") < max_retries)).drop("_hit")
              .withColumn("retry_count", F.col("retry_count") + 1))
    return emitted, again
