"""Table outputs: keyed upsert, run history, full refresh; tables are published all at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from berthline import fixed_values as fv
from berthline.operators.dedup import dedup_last
from berthline.schemas import NATURAL_KEY, RUN_HISTORY, SEAT_ROW
from berthline.session import path_exists
from berthline.sinks.versions import VersionedTable

PARTITION = "fishing_date"


def merged(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str] | None = None,
    ord: str = "ord",
    guard_late: bool = True,
    collected: str = "collected_at",
) -> DataFrame:
    """Target after an upsert: one row per key (null keys equal), the batch's last row winning.

    With ``guard_late`` a batch row replaces a stored one only if it was not
    collected earlier; without it the batch always wins.
    """
    keys = NATURAL_KEY if keys is None else keys
    rows = batch.withColumn("__new", F.lit(1)).withColumn("__ord", F.col(ord))
    if target is not None:
        stored = target.withColumn("__new", F.lit(0))
        rows = stored.unionByName(rows, allowMissingColumns=True)
    order = [collected, "__new", "__ord"] if guard_late else ["__new", collected, "__ord"]
    extra = [ord] if target is not None and ord not in target.columns else []
    return dedup_last(rows, keys, order).drop("__new", "__ord", *extra)


def seats(spark: SparkSession, path: str) -> VersionedTable:
    """The snapshot table, partitioned by trip date."""
    return VersionedTable(spark, path, SEAT_ROW, PARTITION)


def read_seats(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published rows, of the newest version or a given one; empty where there is none yet."""
    return seats(spark, path).read(version)


def _touched(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows on the batch's dates.

    Joins on the partition column, so Spark prunes the partitions that the batch's dates don't name;
    rows without a date are one partition, read if the batch has such rows.
    """
    dates = batch.select(PARTITION).distinct()
    # A comparison, not just a null test, is what Spark takes for a reason to prune.
    known = dates.filter(F.col(PARTITION) >= F.lit("0001-01-01").cast("date"))
    dated = target.join(known, PARTITION, "left_semi")
    undated = dates.filter(F.col(PARTITION).isNull()).select(F.lit(1).alias("one"))
    none = target.filter(F.col(PARTITION).isNull()).withColumn("one", F.lit(1))
    return dated.unionByName(none.join(undated, "one", "left_semi").drop("one"))


def upsert(
    path: str,
    batch: DataFrame,
    keys: list[str] | None = None,
    ord: str = "ord",
    guard_late: bool = True,
    name: str | None = None,
    cluster_by: list[str] | None = None,
    **options: object,
) -> int:
    """Upsert a batch into the table partitioned by trip date; the version that holds it.

    The date is part of the key, so only the dates of the batch are read and written.  Their new state goes to
    a folder of its own, once; the pointer that follows makes it current all at once.  A run that fails before
    that leaves the table as it was.  A batch with a ``name`` that was written whole on the same
    version, but not published, is published from what was written.  ``cluster_by`` names columns
    whose filters shall skip row groups within a date; ``options`` are the writer's.
    """
    table = seats(batch.sparkSession, path)
    base = table.pointer().version
    folder = name and f"{name}-on-{base}"
    if folder is None or not table.is_written(folder):
        batch = batch.select(*SEAT_ROW.fieldNames(), *([ord] if ord not in SEAT_ROW.fieldNames() else []))
        stored = _touched(table.read(base), batch) if base else None
        folder = table.write(merged(stored, batch, keys, ord, guard_late), folder, cluster_by=cluster_by, **options)
    return table.publish(folder, base, label=name)


def append_history(
    spark: SparkSession,
    path: str,
    collected_at: dt.datetime,
    batch_id: str,
    row_count: int,
    status: str = fv.RUN_OK,
    note: str = "",
) -> None:
    row = (collected_at, str(batch_id), row_count, status, note)
    run = spark.createDataFrame([row], RUN_HISTORY).coalesce(1)
    run.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_HISTORY)
    return spark.read.schema(RUN_HISTORY).parquet(path)


def full_refresh(df: DataFrame, path: str, order_by: list[str] | None = None) -> int:
    """Replace a table as a whole, all at once; ``df`` may read from it.  The version that holds it.

    Rows are written in the given order: file by file, and within each file.
    """
    return VersionedTable(df.sparkSession, path, df.schema).replace(df, order_by)


def read_refreshed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A table that ``full_refresh`` wrote."""
    return VersionedTable(spark, path).read(version)
