"""Incremental ingest: new landed files only, normalised and upserted batch by batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from berthline import fixed_values as fv
from berthline.functions.dates import iso_date
from berthline.schemas import NATURAL_KEY, SEAT_COLUMNS
from berthline.sinks.tables import append_history, read_history, seats, upsert
from berthline.sources.landed import judged_records, normalize_aliases

def seat_rows(docs: DataFrame, run_ts: Column) -> DataFrame:
    """Landed documents (file, landed_at, value) to snapshot rows with an order, and rejects with ``reason`` and ``raw``."""
    rows = normalize_aliases(judged_records(docs), run_ts)
    typed = rows.withColumn("fishing_date", iso_date("fishing_date"))
    return typed.select(*SEAT_COLUMNS, F.struct("file", "pos").alias("ord"), "reason", "raw")


def _pending(history: DataFrame, batch_id: str) -> set[str]:
    return {r.status for r in history.filter(F.col("batch_id") == batch_id).select("status").collect()}


def ingest_batch(
    docs: DataFrame,
    batch_id: int | str,
    target: str,
    history: str,
    staging_root: str,
    rejects: str | None = None,
) -> None:
    """Upsert one batch and note it in the history; a batch that is noted as done is skipped.

    A batch that was published but not noted is noted; one that was written but not published is published from what was
    written, unless the table has moved on since.  With ``rejects`` what could not be read is
    written there by batch, and the history's note counts it.
    """
    spark, batch_id = docs.sparkSession, str(batch_id)
    done = _pending(read_history(spark, history), batch_id)
    if fv.RUN_OK in done:
        return
    staging = f"{staging_root}/batch-{batch_id}"
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    if seats(spark, target).published(batch_id):
        append_history(spark, history, now, batch_id, 0, note="published before")
        return
    try:
        rows, counts = _stage_rows(docs, f"{staging}/rows")
        good = rows.filter("reason is null").drop("reason", "raw")
        keys = good.select(*NATURAL_KEY).distinct().count()
        note = f"rows {counts['good']}, after dedup {keys}"
        if rejects:
            refused = rows.filter("reason is not null").select("ord.file", "ord.pos", "reason", "raw")
            refused.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            note += f", rejected {counts['bad']}"
        upsert(target, good, name=batch_id)
        append_history(spark, history, now, batch_id, keys, note=note)
    except Exception as error:
        append_history(spark, history, now, batch_id, 0, fv.RUN_FAILED, str(error))
        raise


def _stage_rows(docs: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Parse a batch once and write all of it, good rows and rejects; their counts."""
    counted = Observation()
    rows = seat_rows(docs, F.col("landed_at").cast("timestamp_ntz"))
    good, bad = F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())
    rows.observe(counted, good.alias("good"), bad.alias("bad")).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path), counted.get


def landing_stream(spark: SparkSession, landing: str, max_files: int = 10_000) -> DataFrame:
    """New files of a landing folder, one row per file."""
    reader = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", max_files)
    return reader.text(landing).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        "value",
    )


def without_repeats(docs: DataFrame, within: str, run: Column | None = None) -> DataFrame:
    """A stream of documents without those whose text came before, under whatever name, less than ``within`` ago.

    The stream's state holds a digest of each text, and of the run time that ``run`` tells from a document if it can,
    since two runs may land the same text.  Time is when a document is first seen, which never runs backwards: an
    old file is not late, and nothing is lost.
    """
    told = [F.coalesce("value", F.lit(""))] + ([F.coalesce(run.cast("string"), F.lit(""))] if run is not None else [])
    marked = docs.withColumns({"content": F.sha2(F.concat_ws("\n", *told), 256), "seen_at": F.current_timestamp()})
    return marked.withWatermark("seen_at", within).dropDuplicatesWithinWatermark(["content"]).drop("content", "seen_at")


def run_incremental(
    spark: SparkSession, landing: str, target: str, checkpoint: str, max_files: int = 10_000, repeats_within: str | None = None
) -> None:
    """Process all files that landed since the last run, then stop.

    With ``repeats_within`` (a duration) a text that lands again within that time changes nothing; a batch of nothing else
    makes no version of the table and no note.

    ``checkpoint`` is a folder on shared storage; it also holds the run history
    and the batches' parsed rows.
    """

    def each(docs: DataFrame, batch_id: int) -> None:
        if repeats_within and docs.isEmpty():
            return
        state = [f"{checkpoint}/{name}" for name in ("history", "staging", "rejects")]
        ingest_batch(docs, batch_id, target, *state)

    docs = landing_stream(spark, landing, max_files)
    query = (
        (without_repeats(docs, repeats_within) if repeats_within else docs)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
