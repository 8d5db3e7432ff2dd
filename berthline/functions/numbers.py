"""Number columns: tolerant parsing, safe ratios, report rounding, seat classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from berthline import fixed_values as fv
from berthline.functions.text import _col

_INT_PREFIX = r"(?U)^\s*([+-]?[0-9]+)"
_FLOAT_PREFIX = r"(?U)^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"


def _prefix(text: Column | str, pattern: str) -> Column:
    return F.regexp_extract(F.replace(_col(text), F.lit(","), F.lit("")), pattern, 1)


def tolerant_int(text: Column | str) -> Column:
    """Leading integer of a text with thousands separators, else 0."""
    return F.coalesce(_prefix(text, _INT_PREFIX).try_cast("bigint"), F.lit(0).cast("bigint"))


def tolerant_float(text: Column | str) -> Column:
    """Leading number of a text with thousands separators, else 0.0."""
    return F.coalesce(_prefix(text, _FLOAT_PREFIX).try_cast("double"), F.lit(0.0))


def strict_int(value: Column | str, default: int | None = 0) -> Column:
    """Whole number of a text or a truncated number; the default where it is neither."""
    return F.coalesce(_col(value).try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """num * scale / den as double; null for a zero or missing denominator."""
    top = _col(num).cast("double")
    top = top if scale == 1.0 else top * F.lit(float(scale))
    return F.try_divide(top, _col(den).cast("double"))


def percent(num: Column | str, den: Column | str) -> Column:
    """num / den * 100 as double, in that order of operations."""
    return safe_ratio(num, den) * F.lit(100.0)


def report_float(value: Column | str, digits: int = 1) -> Column:
    """Rounded double for a report; null and NaN become 0.0."""
    v = _col(value).cast("double")
    return F.round(F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0)), digits)


def report_int(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("bigint"), F.lit(0).cast("bigint"))


def open_seats(remain: Column | str) -> Column:
    return F.coalesce(_col(remain), F.lit(0))


def seat_ratio(remain: Column | str, total: Column | str, strict: bool = False) -> Column:
    """remain / total, a missing or zero total counting as 1 (as unknown if strict)."""
    known = F.nullif(_col(total).cast("double"), F.lit(0.0))
    return open_seats(remain).cast("double") / (known if strict else F.coalesce(known, F.lit(1.0)))


def seat_class(remain: Column | str, total: Column | str, strict: bool = False) -> Column:
    ratio = seat_ratio(remain, total, strict)
    return (
        F.when(open_seats(remain) == 0, F.lit("seat-zero"))
        .when(ratio > 0.5, F.lit("seat-high"))
        .when(ratio > 0.2, F.lit("seat-mid"))
        .when(ratio.isNotNull(), F.lit("seat-low"))
    )


def fill_percent(remain: Column | str, total: Column | str, strict: bool = False) -> Column:
    """Half-up rounded percentage of free seats."""
    return F.floor(seat_ratio(remain, total, strict) * 100 + 0.5)


def seat_status(remain: Column | str) -> Column:
    return F.when(_col(remain) > 0, F.lit(fv.STATUS_OPEN)).otherwise(F.lit(fv.STATUS_FULL))


def seat_status_name(remain: Column | str) -> Column:
    return F.when(_col(remain) > 0, F.lit(fv.STATUS_OPEN_NAME)).otherwise(
        F.lit(fv.STATUS_FULL_NAME)
    )
