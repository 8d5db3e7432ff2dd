"""JSON outputs: documents per date, manifest, dashboard payload, metrics document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from berthline.functions.text import text_price
from berthline.operators.rollups import daily_doc_counts
from berthline.schemas import NATURAL_KEY, PAYLOAD_COLUMNS
_KEEP_NULLS = {"ignoreNullFields": "false"}


def daily_docs(df: DataFrame, date: str = "sdate") -> DataFrame:
    """(date, value): one JSON text per ship, nulls kept; rows without a date are left out.

    A date's document is its lines, whatever their number; its totals are in the manifest.
    """
    ship = F.struct(*[F.col(c) for c in df.columns])
    rows = df.filter(F.col(date).isNotNull())
    return rows.select(F.col(date).alias("date"), F.to_json(ship, _KEEP_NULLS).alias("value"))


def write_daily_docs(df: DataFrame, path: str, date: str = "sdate") -> None:
    """One folder per date with one ship per line; dates without rows get none.

    The rebalance hint sizes the files: small dates share a task, a hot one is split.
    """
    out = daily_docs(df, date).hint("rebalance", "date").write.mode("overwrite")
    out.partitionBy("date").text(path)


def build_manifest(
    df: DataFrame, updated_at: str, date: str = "sdate", boat: str = "ship_no"
) -> DataFrame:
    """One JSON text listing dates with totals (one small entry per calendar date)."""
    entry = F.struct(F.col("date").cast("string").alias("date"), "total", "af_matched")
    counts = daily_doc_counts(df, date, boat)
    dates = counts.agg(F.sort_array(F.collect_list(entry)).alias("dates"))
    return dates.select(F.to_json(F.struct("dates", F.lit(updated_at).alias("updated_at"))).alias("value"))


def write_manifest(df: DataFrame, path: str, updated_at: str, **options) -> None:
    build_manifest(df, updated_at, **options).write.mode("overwrite").text(path)


# --- dashboard payload ------------------------------------------------------------


def _json(c: Column) -> Column:
    return F.coalesce(F.to_json(c.cast("variant")), F.lit("null"))


def payload_lines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as one JSON array in column order; dates as ISO text, nulls kept."""
    names = columns or [c for c in PAYLOAD_COLUMNS if c in df.columns]

    def cell(name: str) -> Column:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.DateType):
            return _json(F.date_format(name, "yyyy-MM-dd"))
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return _json(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"))
        return _json(F.col(name))

    row = F.concat(F.lit("["), F.concat_ws(",", *[cell(n) for n in names]), F.lit("]"))
    return df.select(row.alias("value"))


def ships_to_payload(ships: DataFrame, collected_at: str) -> DataFrame:
    """Unified ship rows under the 20 payload columns; the feeds have no seat totals."""
    zero = F.lit(0).cast("bigint")
    return ships.select(
        F.lit(collected_at).alias("collected_at"),
        "ship_name",
        F.col("area_main").alias("area_name"),
        F.col("area_sub").alias("port_name"),
        F.col("sdate").alias("fishing_date"),
        F.col("stime").alias("depart_time"),
        F.col("etime").alias("return_time"),
        F.col("fish_type").alias("fish_types"),
        F.col("method").alias("fishing_methods"),
        text_price("price").alias("price"),
        zero.alias("total_seats"),
        zero.alias("reserved_seats"),
        F.col("remain").alias("remain_seats"),
        F.col("status").alias("status_code"),
        "status_name",
        "schedule_no",
        F.col("ship_no").alias("boat_id"),
        "source",
        "lat",
        "lng",
    )


def write_payload(
    df: DataFrame,
    path: str,
    updated_at: str,
    columns: list[str] | None = None,
    order: list[str] | None = None,
) -> int:
    """Write the payload and return its row count.

    ``path/rows`` holds one positional row per line, sorted over all files (by the
    natural key within equal ``order`` values, so that a hot value is split), and
    ``path/header`` the time and count.  The layout is the same for any size;
    ``payload_document`` makes a single text of it for a reader that needs one.
    """
    spark = df.sparkSession
    ties = [k for k in NATURAL_KEY if k in df.columns and k not in (order or [])]
    ordered = df.orderBy(*order, *ties) if order else df
    counted = Observation()
    lines = payload_lines(ordered, columns).observe(counted, F.count(F.lit(1)).alias("n"))
    lines.write.mode("overwrite").text(f"{path}/rows")
    count = counted.get["n"]
    header = spark.range(1).select(
        F.to_json(
            F.struct(F.lit(updated_at).alias("updated_at"), F.lit(count).alias("row_count"))
        ).alias("value")
    )
    header.write.mode("overwrite").text(f"{path}/header")
    return count


def payload_document(spark: SparkSession, path: str) -> DataFrame:
    """A written payload as one text (updated_at, row_count, rows): for payloads that fit one value."""
    lines = spark.read.text(f"{path}/rows").select(
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        ).alias("entry")
    )
    entries = lines.agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    rows = F.array_join(F.transform("entries", lambda e: e["value"]), ",")
    head = spark.read.text(f"{path}/header").select("value").scalar()
    body = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"rows":['), rows, F.lit("]}"))
    return entries.select(body.alias("value"))


# --- metrics document -------------------------------------------------------------


def write_metrics(document: DataFrame, path: str) -> None:
    """The one-row metrics document as JSON, nulls kept."""
    row = F.struct(*[F.col(c) for c in document.columns])
    document.select(F.to_json(row, _KEEP_NULLS).alias("value")).write.mode("overwrite").text(path)
