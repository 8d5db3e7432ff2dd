"""Marketplace records (one VARIANT ``rec`` per row) to snapshot and ship rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from berthline import fixed_values as fv
from berthline.functions.dates import iso_date
from berthline.functions.numbers import seat_status_name
from berthline.functions.text import (
    clock,
    join_names,
    or_default,
    price_label,
    strip,
    synthetic_schedule_no,
    truncate,
)
from berthline.schemas import SEAT_COLUMNS, SEAT_WIDTHS
from berthline.sources.landed import take_apart

REASON = "reject_reason"

# A record is taken apart by one cast.  Fields whose JSON null differs from a
# missing field, or whose JSON type matters, stay VARIANT.
_RECORD_V1 = """struct<
  name:variant, area_name:variant, port_name:variant, sdate:string, stime:string, etime:string,
  fish_type:variant, fishing_method:variant, price:variant,
  embarkation_num:bigint, reservation_ready_num:bigint, remain_embarkation_num:bigint,
  schedule_status_code:variant, schedule_status_name:variant, ship_schedule_no:string>"""
_NOT_NULL_IF_PRESENT = (
    "name",
    "area_name",
    "port_name",
    "schedule_status_code",
    "schedule_status_name",
)
_NAME_LISTS = ("fish_type", "fishing_method")
_RECORD_V2 = """struct<
  ship:struct<no:bigint, name:string, area_main:string, area_sub:string, lat:double, lng:double>,
  sdate:variant, stime:string, etime:string, fish_type:string, fishing_method:string,
  remain_embarkation_num:bigint, schedule_status_code:string, schedule_status_name:string,
  price:bigint, schedule_no:string>"""


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _text(c: Column) -> Column:
    return F.try_variant_get(c, "$", "string")


def _names(c: Column) -> Column:
    return F.try_variant_get(c, "$", "array<struct<name:string>>")


def _price(c: Column) -> Column:
    return F.try_variant_get(c, "$", "decimal(38,6)")


def _reject_reason() -> Column:
    """First reason why a record cannot be parsed, null if it can."""
    r = F.col("r")
    reasons = []
    for field in _NOT_NULL_IF_PRESENT:
        reasons.append(F.when(F.is_variant_null(r[field]), F.lit(f"{field} is null")))
        other = r[field].isNotNull() & (F.schema_of_variant(r[field]) != "STRING")
        reasons.append(F.when(other, F.lit(f"{field} is no text")))
    for field in _NAME_LISTS:
        listed = F.schema_of_variant(r[field]).startswith("ARRAY")
        reasons.append(F.when(F.is_variant_null(r[field]), F.lit(f"{field} is null")))
        reasons.append(F.when(r[field].isNotNull() & ~listed, F.lit(f"{field} is no list")))
        unnamed = F.exists(_names(r[field]), lambda n: n["name"].isNull())
        reasons.append(F.when(unnamed, F.lit(f"{field} without name")))
    price = F.schema_of_variant(r["price"])
    reasons.append(F.when((price == "STRING") & (_text(r["price"]) != ""), F.lit("price is text")))
    number = F.is_variant_null(r["price"]) | (_price(r["price"]).isNotNull()) | (price == "STRING")
    reasons.append(F.when(r["price"].isNotNull() & ~number, F.lit("price is no number")))
    return F.coalesce(*reasons)


def parse_listing_v1(df: DataFrame, run_ts: Column) -> DataFrame:
    """Snapshot rows with ``reject_reason``; other columns of ``df`` are kept.

    Records that the listing format does not allow keep their row, so that
    ``split_rejects`` can set them aside with the reason.  Texts stay whole;
    ``fitted`` cuts them for a table with fixed widths.
    """
    r, zero = F.col("r"), F.lit(0).cast("bigint")
    values = {
        "ship_name": _or_empty(_text(r["name"])),
        "area_name": _or_empty(_text(r["area_name"])),
        "port_name": _or_empty(_text(r["port_name"])),
        "fishing_date": iso_date(r["sdate"]),
        "depart_time": clock(r["stime"]),
        "return_time": clock(r["etime"]),
        "fish_types": join_names(_names(r["fish_type"])),
        "fishing_methods": join_names(_names(r["fishing_method"])),
        "price": price_label(_price(r["price"])),
        "total_seats": F.coalesce(r["embarkation_num"], zero),
        "reserved_seats": F.coalesce(r["reservation_ready_num"], zero),
        "remain_seats": F.coalesce(r["remain_embarkation_num"], zero),
        "status_code": _or_empty(_text(r["schedule_status_code"])),
        "status_name": _or_empty(_text(r["schedule_status_name"])),
        "schedule_no": _or_empty(r["ship_schedule_no"]),
    }
    values["collected_at"] = run_ts
    return take_apart(df, _RECORD_V1).select(
        *[c for c in df.columns if c != "rec"],
        *[values[name].alias(name) for name in SEAT_COLUMNS],
        _reject_reason().alias(REASON),
    )


def fitted(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Rows for a table with fixed text widths: for export only, as cut keys may fall together."""
    sizes = SEAT_WIDTHS if widths is None else widths
    return df.withColumns({name: truncate(name, n) for name, n in sizes.items() if name in df.columns})


def split_rejects(df: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason); ``required`` columns must not be null."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required or []]
    known = [F.col(REASON)] if REASON in df.columns else []
    judged = df.withColumn(REASON, F.coalesce(*known, *missing, F.lit(None).cast("string")))
    return judged.filter(F.col(REASON).isNull()).drop(REASON), judged.filter(
        F.col(REASON).isNotNull()
    )


def parse_listing_v2(df: DataFrame, request_date: str = "request_date") -> DataFrame:
    """Ship rows of the nested format, before area, boat and coordinates are looked up.

    ``area_main`` is the feed's value or null; ``feed_lat``/``feed_lng`` are the
    feed's coordinates.  ``request_date`` stays as the bucket of the row.
    """
    r = F.col("r")
    ship = r["ship"]
    return take_apart(df, _RECORD_V2).select(
        *[c for c in df.columns if c != "rec"],
        ship["no"].alias("feed_ship_no"),
        _or_empty(strip(ship["name"])).alias("ship_name"),
        F.nullif(ship["area_main"], F.lit("")).alias("area_main"),
        _or_empty(strip(ship["area_sub"])).alias("area_sub"),
        ship["lat"].alias("feed_lat"),
        ship["lng"].alias("feed_lng"),
        F.when(r["sdate"].isNotNull(), _text(r["sdate"]))
        .otherwise(F.col(request_date).cast("string"))
        .alias("sdate"),
        clock(r["stime"]).alias("stime"),
        clock(r["etime"]).alias("etime"),
        _or_empty(r["fish_type"]).alias("fish_type"),
        _or_empty(r["fishing_method"]).alias("method"),
        F.coalesce(r["remain_embarkation_num"], F.lit(0).cast("bigint")).alias("remain"),
        or_default(r["schedule_status_code"], fv.STATUS_OPEN).alias("status"),
        _or_empty(r["schedule_status_name"]).alias("status_name"),
        F.nullif(r["price"], F.lit(0)).alias("price"),
        r["schedule_no"].alias("schedule_no"),
        F.lit(fv.LISTING_SOURCE).alias("source"),
    )


def calendar_ships(seats: DataFrame, directory: DataFrame, as_of: dt.date) -> DataFrame:
    """Ship rows of calendar seats joined to their directory entry; past and invalid dates dropped.

    What is known of the boat (ship_no, area_main, lat, lng) comes along if the directory has it.
    """
    rows = seats.join(directory, "directory_id", "inner").filter(iso_date("sdate") >= F.lit(as_of))
    empty = F.lit("")
    return rows.select(
        "directory_id",
        "ship_name",
        *[c for c in ("ship_no", "area_main", "lat", "lng") if c in directory.columns],
        "area_sub",
        "sdate",
        empty.alias("stime"),
        empty.alias("etime"),
        F.col("fish_str").alias("fish_type"),
        empty.alias("method"),
        "remain",
        "status",
        seat_status_name("remain").alias("status_name"),
        F.lit(None).cast("bigint").alias("price"),
        synthetic_schedule_no("directory_id", "sdate").alias("schedule_no"),
        F.lit(fv.CALENDAR_SOURCE).alias("source"),
        *[c for c in ("year", "month", "pos") if c in seats.columns],
    )
