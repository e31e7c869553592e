"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every session of this library wants.  On a cluster the
# deployment supplies memory, executors and the checkpoint folder; these
# only steer the planner.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemill", extra: dict | None = None) -> SparkSession:
    """Create or fetch a session with the library's planner settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once a session.

    Functions and processors are pickled by module name, so a worker must be
    able to import the package also where it isn't installed and the job was
    started from another folder.
    """
    sc = spark.sparkContext
    if spark.conf.get("tidemill.shipped", None) == sc.applicationId:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemill-package-"), "tidemill.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    spark.conf.set("tidemill.shipped", sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is
    unset on a local master (tests) is a fresh scratch folder created and
    recorded; on a cluster that would be a folder of the driver's machine,
    so an unset name is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tidemill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for one job's output."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where two consumers must see the very same rows (a nondeterministic
    step such as sampled range bounds feeding both a count and an index);
    a retried or re-planned task then reads the saved rows instead of
    recomputing them differently.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
