"""Tables: daily metrics, daily ads, and the ad sheet by header name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from berthline import fixed_values as fv
from berthline.functions.dates import sheet_date
from berthline.functions.numbers import tolerant_float, tolerant_int
from berthline.schemas import AD_DAILY, DAILY_METRICS
from berthline.session import path_exists
from berthline.sinks.versions import VersionedTable

_TABLES = {"daily_metrics": DAILY_METRICS, "ad_daily": AD_DAILY}
_COUNTS = ("impressions", "clicks", "conversions")


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A known table, published or plain Parquet; the schema is fixed, columns it lacks read as null."""
    if path_exists(spark, f"{path}/versions"):
        return with_schema(VersionedTable(spark, path).read(), name)
    return spark.read.schema(_TABLES[name]).parquet(path)


def with_schema(df: DataFrame, name: str) -> DataFrame:
    """Rows under a known table's columns and types; columns they lack are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in _TABLES[name]])


def read_ad_sheet_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    raw = spark.read.option("header", True).options(**options).csv(path)
    return read_ad_sheet(raw)


def read_ad_sheet(
    df: DataFrame, headers: dict[str, str] | None = None, compact_dates: bool = False
) -> DataFrame:
    """Sheet rows (all text) by header name: a missing header gives 0, rows without a date go."""
    names = fv.AD_SHEET_HEADERS if headers is None else headers
    at = {c.strip(): c for c in reversed(df.columns)}

    def cell(field: str) -> Column:
        source = at.get(names[field])
        return F.col(f"`{source}`").cast("string") if source is not None else F.lit(None).cast("string")

    measures = [f for f in AD_DAILY.fieldNames() if f != "report_date"]
    rows = df.select(
        sheet_date(cell("report_date"), compact_dates).alias("report_date"),
        *[
            (tolerant_int if f in _COUNTS else tolerant_float)(cell(f)).alias(f)
            for f in measures
        ],
    )
    return rows.filter(F.col("report_date").isNotNull())
