"""Registered queries of the metrics pipeline."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from berthline import fixed_values as fv
from berthline.functions import dates as X
from berthline.functions import text as S
from berthline.operators import metrics as M
from berthline.operators.dedup import duplicate_keys
from berthline.operators.rollups import share_top_k, species_counts, value_counts
from berthline.plans import report as R
from berthline.schemas import DAILY_METRICS
from berthline.session import scratch_dir
from berthline.sinks.documents import write_metrics
from berthline.sinks.tables import full_refresh, read_refreshed
from berthline.sources.tables import read_ad_sheet, read_table
from berthline.workloads.fixtures import Tables
from berthline.workloads.registry import query

AS_OF = dt.date(2000, 6, 30)

ENRICHED = """
enriched as (
  select date, cast(extract(year from date) as int) as year, cast(extract(month from date) as int) as month,
    strftime(date, '%Y-%m') as year_month,
    coalesce(gmv, 0) as gmv, coalesce(gmv, 0) * cast('0.03' as decimal(5,4)) as revenue,
    cast(bookings as bigint) as bookings, cast(sessions as bigint) as sessions,
    coalesce(cvr, cast(bookings as double) * 100 / nullif(cast(sessions as double), 0)) as cvr_pct,
    cast(ships as bigint) as ships, cast(members as bigint) as members,
    coalesce(ad_spend_meta, 0) as meta, coalesce(ad_spend_google, 0) as google
  from {daily_metrics}
),
days as (
  select e.*, cast(coalesce(a.impressions, 0) as bigint) as naver_impressions,
    cast(coalesce(a.clicks, 0) as bigint) as naver_clicks,
    cast(coalesce(a.conversions, 0) as bigint) as naver_conversions,
    coalesce(a.ad_spend, 0) as spend, coalesce(a.revenue, 0) as ad_revenue,
    cast(coalesce(a.roas, 0) as double) as naver_roas,
    meta + google + coalesce(a.ad_spend, 0) as total,
    cast(a.conversions as double) / nullif(cast(e.bookings as double), 0) * 100 as share
  from enriched e left join {ad_daily} a on e.date = a.report_date
),
months as (
  select year_month, year, month, sum(gmv) as gmv, sum(revenue) as revenue,
    cast(sum(bookings) as bigint) as bookings, cast(sum(sessions) as bigint) as sessions,
    cast(sum(cast(round(cvr_pct, 8) as decimal(20,8))) * 100000000 as hugeint) as cvr_units, count(cvr_pct) as cvr_n,
    max(ships) as ships, max(members) as members, max_by(ships, date) as ships_last, max_by(members, date) as members_last,
    sum(meta) as meta, sum(google) as google, sum(spend) as spend, sum(total) as total,
    cast(sum(naver_impressions) as bigint) as impressions, cast(sum(naver_clicks) as bigint) as clicks,
    cast(sum(naver_conversions) as bigint) as conversions,
    cast(sum(naver_roas) as hugeint) as roas_sum, count(nullif(naver_roas, 0)) as roas_n
  from days group by year_month, year, month
),
report as (
  select year_month, year, month, cast(gmv as double) as gmv_monthly_won,
    cast((cast(gmv * 100 as hugeint) + 50000) // 100000 as double) / 10 as gmv_monthly_man,
    cast(revenue as double) as revenue_monthly_won, bookings as bookings_monthly, sessions as sessions_monthly,
    case when cvr_n > 0 then cast((2 * cvr_units + cvr_n * 1000000) // (2 * cvr_n * 1000000) as double) / 100 end as cvr_avg_pct,
    ships as ships_eom, members as members_eom, ships_last as ships_last_day, members_last as members_last_day,
    cast(meta as double) as meta_spend_monthly, cast(google as double) as google_spend_monthly,
    cast(spend as double) as naver_spend_monthly, cast(total as double) as total_ad_spend_monthly,
    impressions as naver_impressions_monthly, clicks as naver_clicks_monthly, conversions as naver_conversions_monthly,
    case when roas_n > 0 then cast((20 * roas_sum + roas_n) // (2 * roas_n) as double) / 10 end as naver_roas_avg,
    cast(gmv as double) / cast(bookings as double) as avg_order_value,
    cast(total as double) / cast(bookings as double) as cac_blended
  from months
),
monthly_report as (
  select year_month, gmv_monthly_man as gmv_man, bookings_monthly as bookings, cvr_avg_pct as cvr, ships_eom as ships,
    members_eom as members, naver_spend_monthly as naver_spend, meta_spend_monthly as meta_spend,
    google_spend_monthly as google_spend, total_ad_spend_monthly as total_ad_spend,
    naver_conversions_monthly as naver_conversions, round(avg_order_value, 0) as aov, round(cac_blended, 0) as cac
  from report
),
kpi as (
  select r.date as report_date, cast(r.gmv as double) as gmv_won,
    cast((cast(r.gmv * 100 as hugeint) + 50000) // 100000 as double) / 10 as gmv_man, cast(r.revenue as double) as revenue_won,
    r.bookings, r.sessions, r.cvr_pct, r.ships, r.members, cast(r.total as double) as total_ad_spend,
    cast(r.spend as double) as naver_spend, cast(r.meta as double) as ad_spend_meta, cast(r.google as double) as ad_spend_google,
    cast(r.gmv - p.gmv as double) / nullif(cast(p.gmv as double), 0) * 100 as gmv_wow_pct,
    cast(r.bookings - p.bookings as double) / nullif(cast(p.bookings as double), 0) * 100 as bookings_wow_pct
  from (select *, row_number() over (order by date desc) as rn from days where date <= date '2000-06-30') r
  left join days p on p.date = r.date - 7 where rn = 1
)
"""


def sql(select: str) -> str:
    return "with " + ENRICHED.strip() + "\n" + select


def _days(t: Tables) -> DataFrame:
    return M.mastered(t.daily_metrics, t.ad_daily)


def _months(t: Tables) -> DataFrame:
    return M.monthly(_days(t))


_ENRICHED_COLS = """date, year, month, year_month, cast(gmv as double) as gmv_won, cast(revenue as double) as revenue_won,
  bookings, sessions, cvr_pct, ships, members, cast(meta as double) as ad_spend_meta,
  cast(google as double) as ad_spend_google, cast(0 as double) as ad_roas, cast(0 as double) as ad_cpa"""
_AD_COLS = """naver_impressions, naver_clicks, naver_conversions, cast(spend as double) as naver_spend,
  cast(ad_revenue as double) as naver_revenue, naver_roas, cast(0 as double) as naver_ctr, cast(0 as double) as naver_cvr"""


@query("daily_enriched", sql(f"select {_ENRICHED_COLS} from enriched"))
def daily_enriched(t: Tables) -> DataFrame:
    return M.to_edge(M.enrich_daily(t.daily_metrics))


@query(
    "ad_projected",
    """select report_date as date, cast(impressions as bigint) as naver_impressions, cast(clicks as bigint) as naver_clicks,
      cast(conversions as bigint) as naver_conversions, cast(ad_spend as double) as naver_spend,
      cast(revenue as double) as naver_revenue, cast(roas as double) as naver_roas,
      cast(0 as double) as naver_ctr, cast(0 as double) as naver_cvr from {ad_daily}""",
)
def ad_projected(t: Tables) -> DataFrame:
    return M.to_edge(M.project_ads(t.ad_daily))


@query(
    "mastered",
    sql(f"""select {_ENRICHED_COLS}, {_AD_COLS}, cast(total as double) as total_ad_spend,
      share as naver_booking_share_pct from days"""),
)
def mastered(t: Tables) -> DataFrame:
    return M.to_edge(_days(t))


@query(
    "mastered_as_of",
    sql("select date, bookings from days where date <= date '2000-06-30'"),
)
def mastered_as_of(t: Tables) -> DataFrame:
    return M.as_of_filter(_days(t), AS_OF).select("date", "bookings")


@query("monthly", sql("select * from report"))
def monthly(t: Tables) -> DataFrame:
    return M.to_edge(_months(t))


@query("kpi_latest", sql("select * from kpi"))
def kpi_latest(t: Tables) -> DataFrame:
    return M.to_edge(M.kpi_latest(_days(t), AS_OF))


@query(
    "report_kpi",
    sql("""select strftime(report_date, '%Y-%m-%d') as report_date, gmv_man, gmv_wow_pct, bookings, bookings_wow_pct,
      cvr_pct, ships, members, total_ad_spend from kpi"""),
)
def report_kpi(t: Tables) -> DataFrame:
    return M.report_kpi(M.kpi_latest(_days(t), AS_OF))


@query("report_monthly", sql("select * from monthly_report order by year_month limit 24"))
def report_monthly(t: Tables) -> DataFrame:
    return M.report_monthly(_months(t), keep="oldest")


@query(
    "report_monthly_newest", sql("select * from monthly_report order by year_month desc limit 24")
)
def report_monthly_newest(t: Tables) -> DataFrame:
    return M.report_monthly(_months(t))


@query(
    "report_ad_months",
    sql("""select year_month, naver_impressions_monthly as impressions, naver_clicks_monthly as clicks,
      naver_conversions_monthly as conversions, naver_spend_monthly as spend, naver_roas_avg as roas
      from report where naver_spend_monthly > 0 order by year_month limit 12"""),
)
def report_ad_months(t: Tables) -> DataFrame:
    return M.report_ad_months(_months(t), keep="oldest")


@query(
    "kpi_fallback",
    """select strftime(max(date), '%Y-%m-%d') as report_date,
      cast((cast(max(gmv) * 100 as hugeint) + 50000) // 100000 as double) / 10 as gmv_man,
      cast(0 as double) as gmv_wow_pct, cast(coalesce(max(bookings), 0) as bigint) as bookings,
      cast(0 as double) as bookings_wow_pct, coalesce(max(cvr), 0) as cvr_pct,
      cast(coalesce(max(ships), 0) as bigint) as ships, cast(coalesce(max(members), 0) as bigint) as members,
      cast(coalesce(max(ad_spend_meta), 0) + coalesce(max(ad_spend_google), 0) as double) as total_ad_spend
    from {daily_metrics} where date = (select max(date) from {daily_metrics})""",
)
def kpi_fallback(t: Tables) -> DataFrame:
    return M.kpi_fallback(t.daily_metrics)


@query(
    "monthly_fallback",
    """with m as (select strftime(date, '%Y-%m') as year_month, sum(gmv) as gmv, cast(sum(bookings) as bigint) as bookings,
        cast(sum(coalesce(cvr, 0)) as hugeint) as cvr_sum, count(*) as n, max(ships) as ships, max(members) as members,
        sum(coalesce(ad_spend_meta, 0)) as meta, sum(coalesce(ad_spend_google, 0)) as google
      from {daily_metrics} group by 1)
    select year_month, cast((cast(gmv * 100 as hugeint) + 50000) // 100000 as double) / 10 as gmv_man, bookings,
      cast((200 * cvr_sum + n) // (2 * n) as double) / 100 as cvr, cast(ships as bigint) as ships,
      cast(members as bigint) as members, cast(0 as double) as naver_spend, cast(meta as double) as meta_spend,
      cast(google as double) as google_spend, cast(meta + google as double) as total_ad_spend,
      cast(0 as bigint) as naver_conversions, cast(gmv as double) / cast(bookings as double) as aov,
      cast(meta + google as double) / cast(bookings as double) as cac
    from m order by year_month limit 24""",
)
def monthly_fallback(t: Tables) -> DataFrame:
    return M.monthly_fallback(t.daily_metrics, keep="oldest")


@query(
    "channel_share",
    sql("""select pos, channel, spend, cast((2000 * cast(spend as hugeint) + cast(total as hugeint)) // (2 * cast(total as hugeint)) as double) / 10 as pct
    from (
      select u.*, round(meta_spend, 0) + round(google_spend, 0) + round(naver_spend, 0) as total
      from (select * from monthly_report order by year_month desc limit 1) l,
        lateral (values (0, 'Meta Ads', round(l.meta_spend, 0)), (1, 'Google Ads', round(l.google_spend, 0)),
          (2, '네이버 쇼핑', round(l.naver_spend, 0))) u(pos, channel, spend)) s
    where total > 0"""),
)
def channel_share(t: Tables) -> DataFrame:
    return R.channel_share(M.report_monthly(_months(t)))


@query(
    "trend_rows",
    sql("""select concat(substr(year_month, 6, 2), '월') as label, year_month as ym, gmv_man as gmv, bookings, cvr, ships,
      cac, aov, round(naver_spend, 0) as naver_spend, round(meta_spend, 0) as meta_spend,
      round(google_spend, 0) as google_spend from monthly_report order by year_month desc limit 24"""),
)
def trend_rows(t: Tables) -> DataFrame:
    return R.trend_rows(M.report_monthly(_months(t)))


@query(
    "ad_trend_rows",
    sql("""select concat(substr(year_month, 6, 2), '월') as label, year_month as ym, naver_impressions_monthly as impressions,
      naver_clicks_monthly as clicks, naver_conversions_monthly as conversions, round(naver_spend_monthly, 0) as spend,
      coalesce(naver_roas_avg, 0) as roas from report where naver_spend_monthly > 0 order by year_month desc limit 12"""),
)
def ad_trend_rows(t: Tables) -> DataFrame:
    return R.ad_trend_rows(M.report_ad_months(_months(t)))


@query(
    "kpi_struct",
    sql("""select strftime(report_date, '%Y-%m-%d') as report_date, gmv_man, round(coalesce(gmv_wow_pct, 0), 1) as gmv_wow_pct,
      bookings, round(coalesce(bookings_wow_pct, 0), 1) as bookings_wow_pct, round(cvr_pct, 2) as cvr_pct, ships, members,
      round(total_ad_spend, 0) as total_ad_spend, false as is_default from kpi"""),
)
def kpi_struct(t: Tables) -> DataFrame:
    kpi = M.report_kpi(M.kpi_latest(_days(t), AS_OF))
    return R.kpi_struct(kpi, AS_OF).select("kpi.*", "is_default")


_SHARE_SQL = """, ranked as (select name, n, row_number() over (order by n desc, name) as rn from counts),
  parts as (select name, n, false as is_other from ranked where rn <= {k}
    union all select 'other', sum(n), true from ranked where rn > {k} having count(*) > 0)
  select name, cast(n as bigint) as rows, is_other,
    cast((2000 * n + (select sum(n) from counts)) // (2 * (select sum(n) from counts)) as double) / 10 as pct from parts"""


@query(
    "species_share",
    """with counts as (select trim(s) as name, cast(count(*) as hugeint) as n from
      (select unnest(string_split(fish_types, ',')) as s from {seat_listing}) x where trim(s) <> '' group by 1)
    """
    + _SHARE_SQL.replace("{k}", "3"),
)
def species_share(t: Tables) -> DataFrame:
    return share_top_k(species_counts(t.seat_listing), 3)


@query(
    "share_top_k",
    """with counts as (select area_sub as name, cast(count(*) as hugeint) as n from {seat_listing} group by 1)
    """
    + _SHARE_SQL.replace("{k}", "5"),
)
def region_share(t: Tables) -> DataFrame:
    return share_top_k(value_counts(t.seat_listing, "area_sub"), 5)


@query(
    "duplicate_days",
    """select report_month, count(*) as rows from (select strftime(report_date, '%Y-%m') as report_month from {ad_daily}) x
    group by 1 having count(*) > 1""",
)
def duplicate_days(t: Tables) -> DataFrame:
    by_month = t.ad_daily.select(F.date_format("report_date", "yyyy-MM").alias("report_month"))
    return duplicate_keys(by_month, ["report_month"])


_SHEET = {
    "report_date": "Day ",
    "impressions": "Views",
    "clicks": "Clicks",
    "conversions": "Orders",
    "ad_spend": "Cost",
    "revenue": "Sales",
    "roas": "ROAS",
    "ctr": "CTR",
}


@query(
    "ad_sheet",
    """select report_date, cast(impressions as bigint) as impressions, cast(clicks as bigint) as clicks,
      case when extract(day from report_date) % 7 = 0 then 0 else cast(conversions as bigint) end as conversions,
      cast(ad_spend as double) as ad_spend, cast(revenue as double) as revenue, cast(roas as double) as roas,
      cast(roas as double) + 0.5 as ctr, cast(0 as double) as cvr_ad
    from {ad_daily} where extract(day from report_date) % 3 <> 2""",
)
def ad_sheet(t: Tables) -> DataFrame:
    """Sheet cells as text: thousands separators, unit signs, words, three date notations."""
    day = F.dayofmonth("report_date") % 3
    written = (
        F.when(day == 0, F.date_format("report_date", "yyyy-MM-dd"))
        .when(day == 1, F.date_format("report_date", "yyyy/MM/dd"))
        .otherwise(F.date_format("report_date", "yyyyMMdd"))
    )
    unit = F.lit(" won")
    cells = {
        "report_date": written,
        "impressions": F.format_number("impressions", 0),
        "clicks": F.col("clicks").cast("string"),
        "conversions": F.when(F.dayofmonth("report_date") % 7 == 0, F.lit("n/a")).otherwise(
            F.col("conversions").cast("string")
        ),
        "ad_spend": F.concat(F.format_number("ad_spend", 2), unit),
        "revenue": F.col("revenue").cast("string"),
        "roas": F.col("roas").cast("string"),
        "ctr": F.concat(F.col("roas").cast("string"), F.lit(".5%")),
    }
    sheet = t.ad_daily.select(*[value.alias(_SHEET[name]) for name, value in cells.items()])
    headers = {name: header.strip() for name, header in _SHEET.items()} | {"cvr_ad": "missing"}
    return read_ad_sheet(sheet, headers)


_KPI_FIELDS = "gmv_man gmv_wow_pct bookings bookings_wow_pct cvr_pct ships members total_ad_spend".split()
_PARTS = {
    "gmv_trend": ("label", ["gmv", "bookings", "cvr", "ships"]),
    "booking_trend": ("label", ["bookings", "cvr"]),
    "ship_trend": ("label", ["ships"]),
    "cac_trend": ("label", ["cac", "aov", "naver_spend", "meta_spend", "google_spend"]),
    "naver": ("label", ["impressions", "clicks", "conversions", "spend", "roas"]),
    "channels": ("channel", ["spend", "pct"]),
    "species": ("name", ["pct"]),
    "regions": ("region", ["pct"]),
}


def _shares(name: str, counts: str) -> str:
    return f"""{name}_counts as ({counts}),
  {name}_ranked as (select name, n, row_number() over (order by n desc, name) as rn from {name}_counts),
  {name}_parts as (select name, n, rn - 1 as pos from {name}_ranked where rn <= 5
    union all select 'other', sum(n), 5 from {name}_ranked where rn > 5 having count(*) > 0),
  {name} as (select pos, name as label,
    cast((2000 * n + (select sum(n) from {name}_counts)) // (2 * (select sum(n) from {name}_counts)) as double) / 10 as pct from {name}_parts)"""


def _long(section: str, table: str, label: str, fields: list[str]) -> str:
    """Each field of a section's entries as a row."""
    return "\nunion all ".join(
        f"select '{section}' as section, cast(pos as bigint) as pos, {label} as label, '{f}' as field, cast({f} as double) as value from {table}"
        for f in fields
    )


_DOCUMENT_SQL = sql(
    """select 1""").removesuffix("select 1").rstrip() + ",\n" + ",\n  ".join(
    [
        """months24 as (select *, row_number() over (order by year_month) - 1 as pos from (select * from monthly_report order by year_month desc limit 24) x)""",
        """trend as (select pos, year_month as ym, concat(substr(year_month, 6, 2), '월') as month_label, gmv_man as gmv, bookings, cvr, ships, cac, aov,
      round(naver_spend, 0) as naver_spend, round(meta_spend, 0) as meta_spend, round(google_spend, 0) as google_spend from months24)""",
        """ads as (select row_number() over (order by year_month) - 1 as pos, concat(substr(year_month, 6, 2), '월') as label, naver_impressions_monthly as impressions,
      naver_clicks_monthly as clicks, naver_conversions_monthly as conversions, round(naver_spend_monthly, 0) as spend, coalesce(naver_roas_avg, 0) as roas
      from (select * from report where naver_spend_monthly > 0 order by year_month desc limit 12) x)""",
        """spent as (select unnest([0, 1, 2]) as pos, unnest(['Meta Ads', 'Google Ads', '네이버 쇼핑']) as label,
      unnest([meta_spend, google_spend, naver_spend]) as spend, meta_spend + google_spend + naver_spend as total
      from (select * from trend order by pos desc limit 1) l)""",
        """channel_rows as (select pos, label, spend, cast((2000 * cast(spend as hugeint) + cast(total as hugeint)) // (2 * cast(total as hugeint)) as double) / 10 as pct
      from spent where total > 0)""",
        _shares(
            "species",
            "select trim(s) as name, cast(count(*) as hugeint) as n from (select unnest(string_split(fish_types, ',')) as s from {seat_listing}) x where trim(s) <> '' group by 1",
        ),
        _shares("regions", "select area_main as name, cast(count(*) as hugeint) as n from {seat_listing} group by 1"),
        """head as (select 0 as pos, strftime(report_date, '%Y-%m-%d') as label, gmv_man, round(coalesce(gmv_wow_pct, 0), 1) as gmv_wow_pct, bookings,
      round(coalesce(bookings_wow_pct, 0), 1) as bookings_wow_pct, round(cvr_pct, 2) as cvr_pct, ships, members, round(total_ad_spend, 0) as total_ad_spend from kpi)""",
    ]
) + "\n" + "\nunion all ".join(
    [
        _long("kpi", "head", "label", _KPI_FIELDS),
        _long("gmv_trend", "trend", "month_label", _PARTS["gmv_trend"][1]),
        _long("booking_trend", "trend", "month_label", _PARTS["booking_trend"][1]),
        _long("ship_trend", "trend", "ym", _PARTS["ship_trend"][1]),
        _long("cac_trend", "trend", "ym", _PARTS["cac_trend"][1]),
        _long("naver", "ads", "label", _PARTS["naver"][1]),
        _long("channels", "channel_rows", "label", _PARTS["channels"][1]),
        _long("species", "species", "label", ["pct"]),
        _long("regions", "regions", "label", ["pct"]),
    ]
)


@query("metrics_document", _DOCUMENT_SQL)
def metrics_document(t: Tables) -> DataFrame:
    """The document written as JSON and read back, one row for each figure in it."""
    root = scratch_dir(t.spark, "metrics")
    kpi, months, ad_months = R.choose_plan(t.daily_metrics, AS_OF, t.ad_daily, scratch=root)
    document = R.metrics_document(
        kpi,
        months,
        ad_months,
        R.channel_share(months),
        AS_OF,
        "daily metrics and daily ads",
        share_top_k(species_counts(t.seat_listing), 5),
        share_top_k(value_counts(t.seat_listing, "area_main"), 5),
    )
    write_metrics(document, f"{root}/document")
    text = t.spark.read.text(f"{root}/document")
    doc = text.select(F.from_json("value", document.schema).alias("d")).select("d.*")
    kpi_rows = doc.select(F.lit("kpi").alias("section"), F.lit(0).cast("bigint").alias("pos"), F.col("kpi").alias("e"))
    rows = [_figures(kpi_rows, "report_date", _KPI_FIELDS)]
    for section, (label, fields) in _PARTS.items():
        entries = doc.select(F.lit(section).alias("section"), F.posexplode(section).alias("pos", "e"))
        rows.append(_figures(entries, label, fields))
    return reduce(DataFrame.unionByName, rows)


def _figures(entries: DataFrame, label: str, fields: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(f).alias("field"), F.col("e")[f].cast("double").alias("value")) for f in fields]
    return entries.select("section", F.col("pos").cast("bigint").alias("pos"), F.col("e")[label].alias("label"), F.inline(F.array(*pairs)))


@query(
    "kpi_defaults",
    """select n as days, case when n = 0 then cast(390 as double) end as gmv_man, case when n = 0 then 765 end as ships, true as is_default
      from (select count(*) as n from {daily_metrics} where date < date '1900-01-01') x""",
)
def kpi_defaults(t: Tables) -> DataFrame:
    """The report of a time before all data: the given figures, marked as such."""
    old = dt.date(1900, 1, 1)
    kpi = M.report_kpi(M.kpi_latest(_days(t), old))
    days = M.as_of_filter(_days(t), old).agg(F.count("*").alias("days"))
    head = R.kpi_struct(kpi, old, fv.DEFAULT_KPI)
    return head.crossJoin(days).select("days", "kpi.gmv_man", F.col("kpi.ships").cast("int").alias("ships"), "is_default")


@query(
    "plan_without_ads",
    """select strftime(max(date), '%Y-%m-%d') as report_date, count(distinct strftime(date, '%Y-%m')) as months, 0 as ad_months from {daily_metrics}""",
)
def plan_without_ads(t: Tables) -> DataFrame:
    """The report's plan where there is no ad table."""
    kpi, months, ad_months = R.choose_plan(t.daily_metrics, AS_OF, None, n=1000)
    counts = months.agg(F.count("*").alias("months")), ad_months.agg(F.count("*").cast("int").alias("ad_months"))
    return kpi.select("report_date").crossJoin(counts[0]).crossJoin(counts[1])


@query(
    "refreshed_table",
    """select date, cast(gmv as double) as gmv, bookings, sessions, ships, members, cast(coalesce(ad_spend_meta, 0) as double) as ad_spend_meta,
      null as ad_roas from {daily_metrics} where date > date '1995-01-01'""",
)
def refreshed_table(t: Tables) -> DataFrame:
    """A table replaced as a whole from itself, in date order, and read under its fixed schema."""
    path = scratch_dir(t.spark, "daily")
    kinds = {f.name: f.dataType for f in DAILY_METRICS if f.name in t.daily_metrics.columns}
    typed = t.daily_metrics.select(*[F.col(c).cast(kind) for c, kind in kinds.items()])
    full_refresh(typed, path, ["date"])
    full_refresh(read_refreshed(t.spark, path).filter("date > date '1995-01-01'"), path, ["date"])
    table = read_table(t.spark, "daily_metrics", path)
    spend = F.coalesce("ad_spend_meta", F.lit(0)).cast("double").alias("ad_spend_meta")
    return table.select("date", F.col("gmv").cast("double"), "bookings", "sessions", "ships", "members", spend, "ad_roas")


@query(
    "display_columns",
    """select ord, coalesce(strftime(fishing_date, '%Y-%m-%d') || ' (' || ['일', '월', '화', '수', '목', '금', '토'][1 + dayofweek(fishing_date)] || ')', '') as day,
      case when ord % 3 = 0 then 'ING' else status_code end as status, case when ord % 3 = 0 then '예약가능' else 'x' end as status_name,
      cast(timestamp '2026-01-20 00:00:00' + to_hours(cast(ord % 48 + 9 as int)) as date) as business_date from {seat_listing}""",
)
def display_columns(t: Tables) -> DataFrame:
    empty = F.when(F.col("ord") % 3 == 0, F.lit(""))
    at = F.timestamp_seconds(F.lit(1768867200) + (F.col("ord") % 48) * 3600)
    return t.seat_listing.select(
        "ord",
        X.date_with_weekday("fishing_date").alias("day"),
        S.display_status_code(empty.otherwise(F.col("status_code"))).alias("status"),
        S.display_status_name(empty.otherwise(F.lit("x"))).alias("status_name"),
        X.business_date_column(at).alias("business_date"),
    )
