"""Daily, monthly and latest-day business metrics.

Money stays decimal until the last projection: decimal sums do not depend on
the order in which tasks finish.  Means are taken as decimal sum / count for the
same reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from berthline import fixed_values as fv
from berthline.functions.dates import year_month
from berthline.functions.numbers import percent, safe_ratio
from berthline.schemas import MONEY

AD_COLUMNS = {
    "naver_impressions": "impressions",
    "naver_clicks": "clicks",
    "naver_conversions": "conversions",
    "naver_spend": "ad_spend",
    "naver_revenue": "revenue",
    "naver_roas": "roas",
    "naver_ctr": "ctr",
    "naver_cvr": "cvr_ad",
}
AD_MONEY = {"naver_spend", "naver_revenue"}
AD_COUNTS = {"naver_impressions", "naver_clicks", "naver_conversions"}


def _zero(c: Column | str, dtype: T.DataType | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast(dtype), F.lit(0).cast(dtype))


def _exact_mean(c: Column, digits: int) -> Column:
    total = F.sum(c.cast("decimal(20,8)")).cast("decimal(28,8)")
    n = F.nullif(F.count(c), F.lit(0)).cast("decimal(18,0)")
    return F.round(total / n, digits).cast("double")


def _ten_thousands(money: Column) -> Column:
    exact = money.cast("decimal(28,2)") * F.lit("0.0001").cast("decimal(5,4)")
    return F.round(exact, 1).cast("double")


def to_edge(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for output."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def enrich_daily(daily: DataFrame, take_rate: str = fv.TAKE_RATE) -> DataFrame:
    """Calendar parts, zero-filled measures, revenue and conversion rate per day."""
    rate = F.lit(take_rate).cast("decimal(5,4)")
    has = set(daily.columns)
    gmv = _zero("gmv", MONEY)
    derived = F.try_divide(
        F.col("bookings").cast("double") * F.lit(100.0), F.col("sessions").cast("double")
    )

    def optional(name: str) -> Column:
        return _zero(name, "double") if name in has else F.lit(0.0)

    return daily.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        year_month("date").alias("year_month"),
        gmv.alias("gmv_won"),
        (gmv * rate).cast("decimal(22,6)").alias("revenue_won"),
        _zero("bookings", "bigint").alias("bookings"),
        _zero("sessions", "bigint").alias("sessions"),
        F.coalesce(F.col("cvr").cast("double"), derived).alias("cvr_pct"),
        _zero("ships", "bigint").alias("ships"),
        _zero("members", "bigint").alias("members"),
        _zero("ad_spend_meta", MONEY).alias("ad_spend_meta"),
        _zero("ad_spend_google", MONEY).alias("ad_spend_google"),
        optional("ad_roas").alias("ad_roas"),
        optional("ad_cpa").alias("ad_cpa"),
    )


def _ad_type(name: str) -> T.DataType | str:
    return MONEY if name in AD_MONEY else "bigint" if name in AD_COUNTS else "double"


def project_ads(ads: DataFrame) -> DataFrame:
    """Ad measures under their report names, zero-filled."""
    has = set(ads.columns)
    return ads.select(
        F.col("report_date").alias("date"),
        *[
            (_zero(src, _ad_type(name)) if src in has else F.lit(0).cast(_ad_type(name))).alias(name)
            for name, src in AD_COLUMNS.items()
        ],
    )


def mastered(daily: DataFrame, ads: DataFrame, take_rate: str = fv.TAKE_RATE) -> DataFrame:
    """Daily metrics with the day's ad measures, total spend and the ad channel's booking share."""
    joined = enrich_daily(daily, take_rate).join(project_ads(ads), "date", "left")
    share = percent(F.col("naver_conversions"), F.nullif(F.col("bookings"), F.lit(0)))
    spend = F.col("ad_spend_meta") + F.col("ad_spend_google") + _zero("naver_spend", MONEY)
    filled = {name: _zero(name, _ad_type(name)) for name in AD_COLUMNS}
    return joined.withColumns(
        {
            "total_ad_spend": spend.cast("decimal(20,2)"),
            "naver_booking_share_pct": share,
        }
    ).withColumns(filled)


def as_of_filter(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.filter(F.col("date") <= F.lit(as_of))


def monthly(m: DataFrame) -> DataFrame:
    """Month totals, means and ratios of the mastered days."""
    gmv, bookings, spend = F.sum("gmv_won"), F.sum("bookings"), F.sum("total_ad_spend")
    return m.groupBy("year_month", "year", "month").agg(
        gmv.alias("gmv_monthly_won"),
        _ten_thousands(gmv).alias("gmv_monthly_man"),
        F.sum("revenue_won").alias("revenue_monthly_won"),
        bookings.alias("bookings_monthly"),
        F.sum("sessions").alias("sessions_monthly"),
        _exact_mean(F.col("cvr_pct"), 2).alias("cvr_avg_pct"),
        F.max("ships").alias("ships_eom"),
        F.max("members").alias("members_eom"),
        F.max_by("ships", "date").alias("ships_last_day"),
        F.max_by("members", "date").alias("members_last_day"),
        F.sum("ad_spend_meta").alias("meta_spend_monthly"),
        F.sum("ad_spend_google").alias("google_spend_monthly"),
        F.sum("naver_spend").alias("naver_spend_monthly"),
        spend.alias("total_ad_spend_monthly"),
        F.sum("naver_impressions").alias("naver_impressions_monthly"),
        F.sum("naver_clicks").alias("naver_clicks_monthly"),
        F.sum("naver_conversions").alias("naver_conversions_monthly"),
        _exact_mean(F.nullif(F.col("naver_roas"), F.lit(0.0)), 1).alias("naver_roas_avg"),
        safe_ratio(gmv, bookings).alias("avg_order_value"),
        safe_ratio(spend, bookings).alias("cac_blended"),
    )


def kpi_latest(m: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """The last day up to ``as_of`` and its change against the day exactly ``days`` earlier."""
    latest = as_of_filter(m, as_of).orderBy(F.col("date").desc()).limit(1)
    base = m.select(
        F.date_add("date", days).alias("date"),
        F.col("gmv_won").alias("base_gmv"),
        F.col("bookings").alias("base_bookings"),
    )

    def change(now: str, before: str) -> Column:
        return percent(F.col(now) - F.col(before), F.nullif(F.col(before), F.lit(0)))

    return latest.join(base, "date", "left").select(
        F.col("date").alias("report_date"),
        "gmv_won",
        _ten_thousands(F.col("gmv_won")).alias("gmv_man"),
        "revenue_won",
        "bookings",
        "sessions",
        "cvr_pct",
        "ships",
        "members",
        "total_ad_spend",
        "naver_spend",
        "ad_spend_meta",
        "ad_spend_google",
        change("gmv_won", "base_gmv").alias("gmv_wow_pct"),
        change("bookings", "base_bookings").alias("bookings_wow_pct"),
    )


def report_kpi(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
        "gmv_man",
        "gmv_wow_pct",
        "bookings",
        "bookings_wow_pct",
        "cvr_pct",
        "ships",
        "members",
        F.col("total_ad_spend").cast("double").alias("total_ad_spend"),
    ).limit(1)


def keep_months(df: DataFrame, n: int, keep: str = "newest") -> DataFrame:
    """The newest or the oldest n months."""
    if keep not in ("newest", "oldest"):
        raise ValueError("keep is 'newest' or 'oldest'")
    ym = F.col("year_month")
    return df.orderBy(ym.desc() if keep == "newest" else ym.asc()).limit(n)


def report_monthly(months: DataFrame, n: int = fv.TREND_MONTHS, keep: str = "newest") -> DataFrame:
    report = months.select(
        "year_month",
        F.round("gmv_monthly_man", 1).alias("gmv_man"),
        F.col("bookings_monthly").alias("bookings"),
        F.col("cvr_avg_pct").alias("cvr"),
        F.col("ships_eom").alias("ships"),
        F.col("members_eom").alias("members"),
        F.col("naver_spend_monthly").cast("double").alias("naver_spend"),
        F.col("meta_spend_monthly").cast("double").alias("meta_spend"),
        F.col("google_spend_monthly").cast("double").alias("google_spend"),
        F.col("total_ad_spend_monthly").cast("double").alias("total_ad_spend"),
        F.col("naver_conversions_monthly").alias("naver_conversions"),
        F.round("avg_order_value", 0).alias("aov"),
        F.round("cac_blended", 0).alias("cac"),
    )
    return keep_months(report, n, keep)


def report_ad_months(
    months: DataFrame, n: int = fv.AD_TREND_MONTHS, keep: str = "newest"
) -> DataFrame:
    report = months.filter(F.col("naver_spend_monthly") > 0).select(
        "year_month",
        F.col("naver_impressions_monthly").alias("impressions"),
        F.col("naver_clicks_monthly").alias("clicks"),
        F.col("naver_conversions_monthly").alias("conversions"),
        F.col("naver_spend_monthly").cast("double").alias("spend"),
        F.col("naver_roas_avg").alias("roas"),
    )
    return keep_months(report, n, keep)


def kpi_fallback(daily: DataFrame) -> DataFrame:
    """The KPI row from the daily table alone: the last date's maxima, no weekly change."""
    last = daily.filter(F.col("date") == daily.agg(F.max("date")).scalar())
    spend = _zero(F.max("ad_spend_meta"), MONEY) + _zero(F.max("ad_spend_google"), MONEY)
    return last.agg(
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("report_date"),
        _ten_thousands(_zero(F.max("gmv"), MONEY)).alias("gmv_man"),
        F.lit(0.0).alias("gmv_wow_pct"),
        _zero(F.max("bookings"), "bigint").alias("bookings"),
        F.lit(0.0).alias("bookings_wow_pct"),
        _zero(F.max("cvr"), "double").alias("cvr_pct"),
        _zero(F.max("ships"), "bigint").alias("ships"),
        _zero(F.max("members"), "bigint").alias("members"),
        spend.cast("double").alias("total_ad_spend"),
    ).filter(F.col("report_date").isNotNull())


def monthly_fallback(
    daily: DataFrame, n: int = fv.TREND_MONTHS, keep: str = "newest"
) -> DataFrame:
    """The monthly report from the daily table alone; ad columns are 0, ratios unrounded."""
    gmv, bookings = F.sum(_zero("gmv", MONEY)), F.sum(_zero("bookings", "bigint"))
    meta, google = F.sum(_zero("ad_spend_meta", MONEY)), F.sum(_zero("ad_spend_google", MONEY))
    report = daily.groupBy(year_month("date").alias("year_month")).agg(
        _ten_thousands(gmv).alias("gmv_man"),
        bookings.alias("bookings"),
        _exact_mean(_zero("cvr", "double"), 2).alias("cvr"),
        F.max(_zero("ships", "bigint")).alias("ships"),
        F.max(_zero("members", "bigint")).alias("members"),
        F.lit(0.0).alias("naver_spend"),
        meta.cast("double").alias("meta_spend"),
        google.cast("double").alias("google_spend"),
        (meta + google).cast("double").alias("total_ad_spend"),
        F.lit(0).cast("bigint").alias("naver_conversions"),
        safe_ratio(gmv, bookings).alias("aov"),
        safe_ratio(meta + google, bookings).alias("cac"),
    )
    return keep_months(report, n, keep)
