"""The metrics report: KPI struct, trends, channel shares and the whole document."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from berthline import fixed_values as fv
from berthline.functions.numbers import report_float, report_int
from berthline.functions.text import month_label
from berthline.operators.metrics import (
    kpi_fallback,
    kpi_latest,
    mastered,
    monthly,
    monthly_fallback,
    report_ad_months,
    report_kpi,
    report_monthly,
)
from berthline.session import stored

_CHANNELS = (
    (fv.CHANNEL_META, "meta_spend"),
    (fv.CHANNEL_GOOGLE, "google_spend"),
    (fv.CHANNEL_NAVER, "naver_spend"),
)


def kpi_values() -> list[Column]:
    return [
        F.col("report_date"),
        report_float("gmv_man", 1).alias("gmv_man"),
        report_float("gmv_wow_pct", 1).alias("gmv_wow_pct"),
        report_int("bookings").alias("bookings"),
        report_float("bookings_wow_pct", 1).alias("bookings_wow_pct"),
        report_float("cvr_pct", 2).alias("cvr_pct"),
        report_int("ships").alias("ships"),
        report_int("members").alias("members"),
        report_float("total_ad_spend", 0).alias("total_ad_spend"),
    ]


def kpi_struct(
    kpi: DataFrame, updated: dt.date, defaults: dict[str, float] | None = None
) -> DataFrame:
    """One row with the KPI struct and ``is_default``.

    Without a KPI row the figures are null; ``defaults`` gives others instead.
    """
    found = kpi.limit(1).select(F.struct(*kpi_values()).alias("kpi"))
    one = kpi.sparkSession.range(1).select(found.scalar().alias("kpi"))
    given = defaults or {}

    def default(name: str) -> Column:
        kind = "bigint" if name in ("bookings", "ships", "members") else "double"
        return F.lit(given.get(name)).cast(kind).alias(name)

    empty = F.struct(
        F.lit(updated.isoformat()).alias("report_date"), *[default(n) for n in fv.DEFAULT_KPI]
    )
    return one.select(
        F.coalesce("kpi", empty).alias("kpi"), F.col("kpi").isNull().alias("is_default")
    )


def trend_rows(months: DataFrame) -> DataFrame:
    """Report months with labels and rounded figures, one row each."""
    return months.select(
        month_label("year_month").alias("label"),
        F.col("year_month").alias("ym"),
        report_float("gmv_man", 1).alias("gmv"),
        report_int("bookings").alias("bookings"),
        report_float("cvr", 2).alias("cvr"),
        report_int("ships").alias("ships"),
        report_float("cac", 0).alias("cac"),
        report_float("aov", 0).alias("aov"),
        report_float("naver_spend", 0).alias("naver_spend"),
        report_float("meta_spend", 0).alias("meta_spend"),
        report_float("google_spend", 0).alias("google_spend"),
    )


def _array_of(order: str, *fields: str | Column) -> Column:
    """Array of structs in the order of a column.  Months are limited before, so it stays small."""
    entries = F.sort_array(
        F.collect_list(F.struct(F.col(order).alias("__order"), F.struct(*fields).alias("entry")))
    )
    return F.transform(entries, lambda e: e["entry"])


def trend_arrays(months: DataFrame) -> DataFrame:
    """One row: gmv_trend, booking_trend, ship_trend, cac_trend."""
    by_month = F.col("ym").alias("label")
    return trend_rows(months).agg(
        _array_of("ym", "label", "ym", "gmv", "bookings", "cvr", "ships").alias("gmv_trend"),
        _array_of("ym", "label", "ym", "bookings", "cvr").alias("booking_trend"),
        _array_of("ym", by_month, "ships").alias("ship_trend"),
        _array_of(
            "ym", by_month, "cac", "aov", "naver_spend", "meta_spend", "google_spend"
        ).alias("cac_trend"),
    )


def ad_trend_rows(ad_months: DataFrame) -> DataFrame:
    return ad_months.select(
        month_label("year_month").alias("label"),
        F.col("year_month").alias("ym"),
        report_int("impressions").alias("impressions"),
        report_int("clicks").alias("clicks"),
        report_int("conversions").alias("conversions"),
        report_float("spend", 0).alias("spend"),
        report_float("roas", 1).alias("roas"),
    )


def ad_trend(ad_months: DataFrame) -> DataFrame:
    fields = ("label", "ym", "impressions", "clicks", "conversions", "spend", "roas")
    return ad_trend_rows(ad_months).agg(_array_of("ym", *fields).alias("naver"))


def channel_share(months: DataFrame, strict: bool = True) -> DataFrame:
    """(pos, channel, spend, pct) of the last report month; no rows if nothing was spent.

    ``strict=False`` gives the estimated shares for a month without spend.
    """
    spends = [F.struct("year_month", *[c for _, c in _CHANNELS])]
    last = months.agg(F.max(*spends).alias("m")).filter(F.col("m").isNotNull()).select("m.*")
    rounded = last.select(*[report_float(c, 0).alias(c) for _, c in _CHANNELS])
    total = sum((F.col(c) for _, c in _CHANNELS[1:]), F.col(_CHANNELS[0][1]))

    def entry(pos: int, name: str, spend: Column, pct: Column) -> Column:
        return F.struct(
            F.lit(pos).alias("pos"),
            F.lit(name).alias("channel"),
            spend.alias("spend"),
            pct.alias("pct"),
        )

    def share(spend: Column) -> Column:
        ratio = spend.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)")
        return F.round(ratio, 1).cast("double")

    spent = F.array(
        *[entry(i, name, F.col(c), share(F.col(c))) for i, (name, c) in enumerate(_CHANNELS)]
    )
    estimate = F.array(
        *[
            entry(i, name, F.lit(spend), F.lit(pct))
            for i, (name, spend, pct) in enumerate(fv.DEFAULT_CHANNELS)
        ]
    )
    rows = F.when(total > 0, spent)
    rows = rows if strict else rows.otherwise(estimate)
    return rounded.select(F.inline(rows))


def shares_array(shares: DataFrame, name: str) -> DataFrame:
    """Top-k shares as one array, largest first and "other" last."""
    order = F.struct("is_other", -F.col("rows"), "name")
    return shares.select(order.alias("__rank"), F.col("name").alias(name), "pct").agg(
        _array_of("__rank", name, "pct").alias("shares")
    )


def metrics_document(
    kpi: DataFrame,
    months: DataFrame,
    ad_months: DataFrame,
    channels: DataFrame,
    updated: dt.date,
    source: str,
    species: DataFrame | None = None,
    regions: DataFrame | None = None,
    defaults: dict[str, float] | None = None,
) -> DataFrame:
    """The whole document as one row; its parts are scalar subqueries of small results."""
    spark = kpi.sparkSession
    head = kpi_struct(kpi, updated, defaults)
    trends = trend_arrays(months).select(F.struct("*").alias("t"))
    channel_list = channels.agg(_array_of("pos", "channel", "spend", "pct").alias("channels"))

    def shares(df: DataFrame | None, name: str) -> Column:
        if df is not None:
            return shares_array(df, name).scalar()
        return F.array().cast(f"array<struct<{name}:string,pct:double>>")

    parts = spark.range(1).select(
        head.select(F.struct("*").alias("h")).scalar().alias("h"),
        trends.scalar().alias("t"),
        ad_trend(ad_months).scalar().alias("naver"),
        channel_list.scalar().alias("channels"),
        shares(species, "name").alias("species"),
        shares(regions, "region").alias("regions"),
    )
    return parts.select(
        F.lit(updated.isoformat()).alias("updated"),
        F.lit(source).alias("source"),
        F.col("h.kpi").alias("kpi"),
        F.col("h.is_default").alias("is_default"),
        "t.*",
        "naver",
        "channels",
        "species",
        "regions",
    )


def choose_plan(
    daily: DataFrame,
    as_of: dt.date,
    ads: DataFrame | None = None,
    keep: str = "newest",
    n: int = fv.TREND_MONTHS,
    n_ads: int = fv.AD_TREND_MONTHS,
    scratch: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(KPI, months, ad months): with the ad table if there is one, else from the daily table alone.

    With a scratch folder the mastered days and the months are stored there, so that the parts of
    a report don't start from the source tables again.
    """
    if ads is None:
        months = monthly_fallback(daily, n, keep)
        schema = (
            "year_month string, impressions bigint, clicks bigint, conversions bigint, "
            "spend double, roas double"
        )
        return kpi_fallback(daily), months, daily.sparkSession.createDataFrame([], schema)
    days = mastered(daily, ads)
    if scratch:
        days = stored(days, f"{scratch}/days")
    all_months = monthly(days)
    if scratch:
        all_months = stored(all_months, f"{scratch}/months")
    return (
        report_kpi(kpi_latest(days, as_of)),
        report_monthly(all_months, n, keep),
        report_ad_months(all_months, n_ads, keep),
    )
