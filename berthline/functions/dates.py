"""Date columns.  Nothing here reads a clock: callers pass the run time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from berthline import fixed_values as fv
from berthline.functions.text import _col

_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_ISO_OR_SLASH = r"^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}$"
_COMPACT = r"^[0-9]{8}$"


def iso_date(text: Column | str) -> Column:
    """Date of an ISO text, null for anything else."""
    c = _col(text)
    return F.when(c.rlike(_ISO), c.try_cast("date"))


def sheet_date(text: Column | str, compact: bool = False) -> Column:
    """Date of a sheet cell with dashes or slashes; ``compact`` also takes yyyymmdd."""
    c = F.trim(_col(text))
    date = F.when(
        c.rlike(_ISO_OR_SLASH), F.replace(c, F.lit("/"), F.lit("-")).try_cast("date")
    )
    return date.when(c.rlike(_COMPACT), F.try_to_date(c, "yyyyMMdd")) if compact else date


def year_month(date: Column | str) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


def date_with_weekday(text: Column | str) -> Column:
    """'2026-04-01 (weekday)'; text that is no date stays as it is, null becomes ''."""
    c = _col(text).cast("string")
    names = F.array(*[F.lit(n) for n in fv.WEEKDAYS])
    day = iso_date(c)
    return F.when(
        day.isNotNull(), F.concat(c, F.lit(" ("), F.element_at(names, F.dayofweek(day)), F.lit(")"))
    ).otherwise(F.coalesce(c, F.lit("")))


def business_date(run_ts: dt.datetime, hours_ahead: int = 9) -> dt.date:
    """Calendar date in the business time zone (no daylight saving) of a UTC run time."""
    return (run_ts + dt.timedelta(hours=hours_ahead)).date()


def business_date_column(ts: Column | str, zone: str = "Asia/Seoul") -> Column:
    return F.to_date(F.from_utc_timestamp(_col(ts), zone))
