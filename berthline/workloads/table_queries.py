"""Registered queries on published tables: versions, rollback, change rows, kept counts, order at the sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from berthline.schemas import NATURAL_KEY, SEAT_ROW
from berthline.session import scratch_dir
from berthline.sinks import counts as C
from berthline.sinks.tables import full_refresh, read_refreshed, read_seats, seats, upsert
from berthline.sources.listing import fitted
from berthline.workloads.fixtures import Tables
from berthline.workloads.registry import query

_SHOWN = "ship_name, area_name, port_name, fishing_date, depart_time, fish_types, price, total_seats, remain_seats, status_code, schedule_no"
_KEY = "ship_name, fishing_date, depart_time, schedule_no"

# The table after a first batch (even rows) and after a second one (odd rows, some of them collected earlier).
_VERSIONS = f"""snapshot as (
  select cast(ord % 5 as int) as day, cast(ord % 2 as int) as batch, ord, ship_name, area_main as area_name, area_sub as port_name, fishing_date, depart_time, fish_types,
    cast(price as varchar) as price, cast(total_seats as bigint) as total_seats, cast(remain_seats as bigint) as remain_seats, status_code, schedule_no
  from {{seat_listing}}),
first as (select * from (select *, row_number() over (partition by {_KEY} order by day desc, ord desc) as rn from snapshot where batch = 0) x where rn = 1),
second as (select * from (select *, row_number() over (partition by {_KEY} order by day desc, batch desc, ord desc) as rn from snapshot) x where rn = 1),
versions as (select 1 as version, * from first union all select 2, * from second union all select 3, * from first)"""


def snapshot(t: Tables) -> DataFrame:
    """The listing as snapshot rows with their order."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("ord") % 5).cast("int"))
    have = t.seat_listing.withColumnsRenamed({"area_main": "area_name", "area_sub": "port_name"}).withColumn("collected_at", day)
    names = set(have.columns)
    return have.select("ord", *[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in SEAT_ROW])


def two_batches(t: Tables) -> str:
    """A table that two batches made."""
    path, rows = scratch_dir(t.spark, "published"), snapshot(t)
    for batch in (0, 1):
        upsert(path, rows.filter(F.col("ord") % 2 == batch), name=f"batch-{batch}")
    return path


@query("table_versions", f"with {_VERSIONS} select version, {_SHOWN} from versions")
def table_versions(t: Tables) -> DataFrame:
    """The table's three versions: after a batch, after a second one, and rolled back."""
    path = two_batches(t)
    seats(t.spark, path).rollback(1)
    each = [read_seats(t.spark, path, v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return reduce(DataFrame.unionByName, each).select("version", *_SHOWN.split(", "))


@query(
    "change_rows",
    f"""with {_VERSIONS}
    select {", ".join(f"coalesce(n.{k}, o.{k}) as {k}" for k in _KEY.split(", "))}, o.ord is not null as had, n.ord is not null as has,
      o.day as old_day, n.day as new_day, o.remain_seats as old_seats, n.remain_seats as new_seats
    from first o full join second n on o.ship_name = n.ship_name and o.fishing_date is not distinct from n.fishing_date
      and o.depart_time = n.depart_time and o.schedule_no = n.schedule_no
    where o.ord is null or n.ord is null or (o.day, o.area_name, o.port_name, o.fish_types, o.price, o.total_seats, o.remain_seats, o.status_code)
      is distinct from (n.day, n.area_name, n.port_name, n.fish_types, n.price, n.total_seats, n.remain_seats, n.status_code)""",
)
def change_rows(t: Tables) -> DataFrame:
    """What the second batch changed: old and new image of each changed row."""
    changed = seats(t.spark, two_batches(t)).changes(NATURAL_KEY, 1, 2)
    day = lambda side: F.dayofmonth(f"{side}.collected_at") - 1
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    # Not coalesce: a key column may itself be null.
    return changed.select(
        *[F.when(has, F.col(f"new.{k}")).otherwise(F.col(f"old.{k}")).alias(k) for k in NATURAL_KEY],
        had.alias("had"), has.alias("has"), day("old").alias("old_day"), day("new").alias("new_day"),
        F.col("old.remain_seats").alias("old_seats"), F.col("new.remain_seats").alias("new_seats"),
    )


def _counted(t: Tables) -> list[tuple[int, DataFrame]]:
    """The kept counts after each of the three versions."""
    path, rows, out = scratch_dir(t.spark, "published"), snapshot(t), []
    counts = f"{path}-counts"
    steps = [lambda b=b: upsert(path, rows.filter(F.col("ord") % 2 == b)) for b in (0, 1)]
    for step in [*steps, lambda: seats(t.spark, path).rollback(1)]:
        step()
        version = C.refresh_counts(t.spark, path, counts)
        out.append((version, C.counts_table(t.spark, counts).read(version)))
    return out


@query(
    "cards_kept",
    f"""with {_VERSIONS} select version, count(*) as ships, count(*) filter (status_code = 'ING') as avail, count(*) filter (status_code = 'END') as full,
      cast(sum(remain_seats) as bigint) as seats, count(*) filter (remain_seats > 0) as with_seats,
      count(distinct fishing_date) + max(case when fishing_date is null then 1 else 0 end) as dates from versions group by version""",
)
def cards_kept(t: Tables) -> DataFrame:
    """The cards after two batches with late rows and a rollback, kept from change rows."""
    return reduce(DataFrame.unionByName, [C.kept_cards(counts).withColumn("version", F.lit(v)) for v, counts in _counted(t)])


@query(
    "facets_kept",
    f"""with {_VERSIONS} select version, 'species' as kind, value, count(*) as n from (
        select distinct version, ord, trim(s) as value from (select version, ord, unnest(string_split(fish_types, ',')) as s from versions) y where trim(s) <> '') x group by version, value
      union all select version, 'area', area_name, count(*) from versions group by version, area_name
      union all select version, 'date', cast(fishing_date as varchar), count(*) from versions where fishing_date is not null group by version, fishing_date""",
)
def facets_kept(t: Tables) -> DataFrame:
    """The facets' values and rows, kept from change rows."""
    parts = []
    for v, counts in _counted(t):
        dates = C.kept_dates(counts).select(F.lit("date").alias("kind"), F.col("fishing_date").cast("string").alias("value"), "n")
        facets = [C.kept_facet(counts, kind).select(F.lit(kind).alias("kind"), "value", "n") for kind in ("species", "area")]
        parts += [f.withColumn("version", F.lit(v)) for f in (*facets, dates)]
    return reduce(DataFrame.unionByName, parts)


@query(
    "clustered_filters",
    f"""with {_VERSIONS} select 'area' as asked, {_SHOWN} from second where area_name = 'ASIA'
      union all select 'seats', {_SHOWN} from second where remain_seats between 20 and 22
      union all select 'both', {_SHOWN} from second where area_name = 'EUROPE' and port_name = 'NATION_7' and remain_seats > 45""",
)
def clustered_filters(t: Tables) -> DataFrame:
    """Filters on secondary columns of a table whose dates are written in interleaved order."""
    path, rows = scratch_dir(t.spark, "clustered"), snapshot(t)
    for batch in (0, 1):
        upsert(path, rows.filter(F.col("ord") % 2 == batch), cluster_by=["area_name", "port_name", "remain_seats"])
    asked = {
        "area": F.col("area_name") == "ASIA",
        "seats": F.col("remain_seats").between(20, 22),
        "both": (F.col("area_name") == "EUROPE") & (F.col("port_name") == "NATION_7") & (F.col("remain_seats") > 45),
    }
    found = [read_seats(t.spark, path).filter(where).select(F.lit(name).alias("asked"), *_SHOWN.split(", ")) for name, where in asked.items()]
    return reduce(DataFrame.unionByName, found)


@query("refreshed_order", "select date, bookings, cast(row_number() over (order by date) as bigint) as place from {daily_metrics}")
def refreshed_order(t: Tables) -> DataFrame:
    """Where a full refresh in date order put each row: counted over its files, in the order of their names."""
    path = scratch_dir(t.spark, "ordered")
    full_refresh(t.spread(t.daily_metrics.select("date", "bookings")), path, ["date"])
    rows = read_refreshed(t.spark, path).select("date", "bookings", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = rows.groupBy("file").agg(F.count("*").alias("rows"))
    before = sizes.select("file", (F.sum("rows").over(Window.orderBy("file")) - F.col("rows")).alias("before"))
    return rows.join(before, "file").select("date", "bookings", (F.col("before") + F.col("row") + 1).alias("place"))


@query("fitted_rows", "select ord, left(ship_name, 8) as ship_name, left(area_sub, 5) as port_name, price, schedule_no from {seat_listing}")
def fitted_rows(t: Tables) -> DataFrame:
    """Rows cut to an export's text widths."""
    rows = t.seat_listing.withColumnRenamed("area_sub", "port_name")
    return fitted(rows, {"ship_name": 8, "port_name": 5}).select("ord", "ship_name", "port_name", "price", "schedule_no")
