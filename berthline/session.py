"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Set to true where the checkpoint folder is a file path on storage that all executors mount: it is not tried then.
SHARED_MOUNT = "spark.berthline.checkpoint.shared"
# Compressed files of a table that a join may broadcast, see `joinable`.
BROADCAST_FILE_BYTES = 1 << 20

# Settings the operators rely on.  Sizes are left to the cluster: AQE coalesces
# small shuffle partitions and splits skewed ones, so only the upper bound of
# partitions matters, and broadcasts happen below Spark's own size threshold.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    # Bytes of a batch that goes to a Python worker, besides its rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def apply_recommended(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_mount(spark: SparkSession) -> bool:
    return spark.conf.get(SHARED_MOUNT, "false").lower() == "true"


def _located(spark: SparkSession, path: str):
    """A path and the file system that it names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked from the file system that the path names."""
    where, files = _located(spark, path)
    return files.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    where, files = _located(spark, path)
    return [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    where, files = _located(spark, path)
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that readers see whole or not at all; False where the path is taken.

    Of two writers at once one loses where a rename refuses a taken name (HDFS does); elsewhere let one writer run.
    """
    where, files = _located(spark, path)
    part, _ = _located(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(part, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(where) or not files.rename(part, where):
        files.delete(part, False)
        return False
    return True


def write_bytes(spark: SparkSession, path: str, pieces: Iterable[bytes]) -> None:
    """Write a new binary file, piece by piece."""
    where, files = _located(spark, path)
    stream = files.create(where, False)
    try:
        for piece in pieces:
            stream.write(bytearray(piece))
    finally:
        stream.close()


def joinable(df: DataFrame, path: str) -> DataFrame:
    """`df`, which reads `path`, for joins: not broadcast where its files are over BROADCAST_FILE_BYTES.

    Spark compares their size with its threshold, but a hash table takes some twenty to fifty times that of the driver.
    """
    where, files = _located(df.sparkSession, path)
    return df.hint("merge") if files.getContentSummary(where).getLength() > BROADCAST_FILE_BYTES else df


def delete_path(spark: SparkSession, path: str) -> None:
    where, files = _located(spark, path)
    files.delete(where, True)


@cache
def _temporary(application: str) -> str:
    return tempfile.mkdtemp(prefix="berthline-")


@cache
def _reaches_all(spark: SparkSession, base: str) -> bool:
    """Whether what tasks write to a folder is there for later reads: tried once, with a row from each of as many tasks as run at once."""
    path, tasks = f"{base}/probe-{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    return spark.read.schema("id long").parquet(path).count() == tasks


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder that all executors share.

    The folder is spark.checkpoint.dir or the one given to setCheckpointDir; without either a temporary one where all runs in
    one process, else one in the warehouse.  A local path off a local master is tried first, unless it is said to be a shared mount.
    """
    # Spark refuses to set spark.checkpoint.dir in a running session, so what is chosen here is kept here.
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not base and (master == "local" or master.startswith("local[")):
        base = _temporary(spark.sparkContext.applicationId)
    base = (base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/berthline-scratch").rstrip("/")
    if not master.startswith("local") and (base.startswith("file:") or "://" not in base and base.startswith("/")):
        if not shared_mount(spark) and not _reaches_all(spark, base):
            raise ValueError(f"{base} is a local path that executors do not share; set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to shared storage and read it back.

    Later joins plan with its real size, and lost executors do not lose it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
