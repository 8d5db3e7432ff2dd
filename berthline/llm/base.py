"""What the training-data operators share: tables, bounded Python batches, held-out folds."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from berthline.session import apply_recommended, scratch_dir, stored

# Rows and bytes that one Arrow batch hands to a Python worker.  Texts differ in
# length by five orders of magnitude, so a bound by rows alone is not enough.
BATCH_ROWS = 1000
BATCH_BYTES = 2 << 20


def by_value(module: str) -> None:
    """Send what runs in workers by value, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_by_value(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast of an object whose class workers need not have; what is returned gets it there, the same one for all tasks of a process."""
    sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def get():
        held = sent.value
        if "value" not in held:
            held["value"] = pickle.loads(held["pickled"])
        return held["value"]

    return get


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    apply_recommended(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: a table in the shared folder, read back."""
    return stored(df, scratch_dir(df.sparkSession, label))


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds (null ids: fold null)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds
