"""Registered queries on landed JSON and HTML, rendered from the seat listing."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from berthline.operators.rollups import days_ahead
from berthline.plans.availability import (
    Dims,
    calendar_listing,
    listing_ships,
    unified_ships,
)
from berthline.session import list_names, scratch_dir, stored
from berthline.functions.text import page_title
from berthline.schemas import PAYLOAD_COLUMNS
from berthline.sinks.documents import (
    build_manifest,
    daily_docs,
    ships_to_payload,
    write_daily_docs,
    write_manifest,
    write_payload,
)
from berthline.sinks.tables import read_history, read_seats, seats
from berthline.sources.html_pages import (
    directory_ids,
    extract_calendar,
    extract_directory,
    distinct_links,
)
from berthline.sources.landed import (
    assemble_pages,
    explode_landed,
    load_daily_docs,
    load_manifest,
    manifest_dates,
    normalize_aliases,
    parse_pages,
    payload_rows,
)
from berthline.sources.landed import payload_lines as payload_rows_of_lines
from berthline.sources.listing import parse_listing_v1, parse_listing_v2, split_rejects
from berthline.streaming.incremental import run_incremental
from berthline.workloads.fixtures import Tables
from berthline.workloads.listing_queries import RESOLVED
from berthline.workloads.registry import query

RUN_TS = dt.datetime(2026, 1, 20, 1, 0)
AS_OF = RUN_TS.date()
_DATE = "date_format(fishing_date, 'yyyy-MM-dd')"

# --- records with aliases -------------------------------------------------------------

ALIASED = f"""
select ord, case ord % 3
  when 0 then to_json(named_struct('name', ship_name, 'area_name', area_main, 'port_name', area_sub, 'sdate', {_DATE},
      'stime', depart_time, 'fish_type', transform(split(fish_types, ', '), x -> named_struct('name', x)), 'price', price,
      'embarkation_num', total_seats, 'remain_embarkation_num', remain_seats, 'schedule_status_code', status_code,
      'ship_schedule_no', schedule_no))
  when 1 then to_json(named_struct('ship_name', ship_name, 'area_name', area_main, 'port_name', area_sub, 'fishing_date', {_DATE},
      'depart_time', depart_time, 'fish_types', split(fish_types, ', '), 'price', cast(price as string),
      'total_seats', cast(total_seats as string), 'available', cast(remain_seats as string), 'status_code', status_code,
      'schedule_no', schedule_no))
  else to_json(named_struct('name', cast(null as string), 'ship_name', ship_name, 'area_main', area_main, 'area_sub', area_sub,
      'date', {_DATE}, 'start_time', depart_time, 'fishing_type', fish_types, 'price', price, 'capacity', concat(total_seats, '.5'),
      'remain', remain_seats + 0.5D, 'status', status_code, 'schedule_id', schedule_no), map('ignoreNullFields', 'false'))
  end as value
from {{seat_listing}}
"""

NORMALIZED_SQL = """select ord, ship_name, area_main as area_name, area_sub as port_name,
  coalesce(strftime(fishing_date, '%Y-%m-%d'), '') as fishing_date, depart_time,
  case when ord % 3 = 2 then fish_types else replace(fish_types, ', ', ',') end as fish_types, cast(price as varchar) as price,
  cast(case when ord % 3 = 2 then 0 else total_seats end as bigint) as total_seats, cast(remain_seats as bigint) as remain_seats,
  status_code, schedule_no from {seat_listing}"""
_NORMALIZED = [
    "ord",
    "ship_name",
    "area_name",
    "port_name",
    "fishing_date",
    "depart_time",
    "fish_types",
    "price",
    "total_seats",
    "remain_seats",
    "status_code",
    "schedule_no",
]


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


@query("alias_normalize", NORMALIZED_SQL)
def alias_normalize(t: Tables) -> DataFrame:
    records = t.spread(t.sql(ALIASED)).select("ord", F.parse_json("value").alias("rec"))
    return normalize_aliases(records, _run_ts()).select(*_NORMALIZED)


def _landed(t: Tables) -> DataFrame:
    """Documents of up to 64 records in four outer shapes."""
    return t.sql(
        """select bucket, case bucket % 4
            when 0 then concat('[7,"x",', body, ']')
            when 1 then concat('{"n":3,"data":[],"records":[', body, ',null]}')
            when 2 then concat('{"total":3,"ships":[', body, '],"items":[{"name":"no"}]}')
            else concat('{"n":1,"z":["t"],"2026-04-01":[', body, '],"a":[{"name":"no"}]}') end as value
          from (select bucket, array_join(transform(array_sort(collect_list(struct(ord, value))), e -> e.value), ',') as body
                from (select cast(ord div 64 as bigint) as bucket, ord, value from {aliased}) r group by bucket) d""",
        aliased=t.sql(
            ALIASED.replace("to_json(named_struct(", "to_json(named_struct('ord', ord, ")
        ),
    )


@query("landed_shapes", NORMALIZED_SQL.replace("select ord,", "select cast(ord // 64 as bigint) as bucket, ord,"))
def landed_shapes(t: Tables) -> DataFrame:
    records = explode_landed(t.spread(_landed(t)))
    with_ord = records.withColumn("ord", F.variant_get("rec", "$.ord", "bigint")).drop("pos")
    return normalize_aliases(with_ord, _run_ts()).select("bucket", *_NORMALIZED)


# --- marketplace formats ----------------------------------------------------------------

LISTING_V1 = f"""
select ord, to_json(named_struct('name', case when ord % 59 = 0 then cast(null as string) else repeat(ship_name, 12) end,
    'area_name', area_main, 'port_name', area_sub, 'sdate', case when ord % 37 = 0 then '2026-13-01' else {_DATE} end,
    'stime', concat(depart_time, ':00'), 'etime', cast(null as string),
    'fish_type', parse_json(case when ord % 67 = 0 then 'null' when ord % 73 = 0 then '"x"' else
       to_json(transform(split(fish_types, ', '), x -> named_struct('name', if(ord % 61 = 0, cast(null as string), x))), map('ignoreNullFields', 'false')) end),
    'price', parse_json(case when ord % 53 = 0 then concat('"', price, '"') when ord % 47 = 0 then '[5]' when ord % 43 = 0 then concat(price, '.5')
       else cast(price as string) end),
    'embarkation_num', total_seats, 'reservation_ready_num', total_seats - 1, 'remain_embarkation_num', remain_seats,
    'schedule_status_code', status_code, 'schedule_status_name', 'x', 'ship_schedule_no', ord), map('ignoreNullFields', 'false')) as value
from {{seat_listing}}
"""
_V1_REASON = """case when ord % 59 = 0 then 'name is null' when ord % 67 = 0 then 'fish_type is null' when ord % 73 = 0 then 'fish_type is no list'
  when ord % 61 = 0 then 'fish_type without name' when ord % 53 = 0 then 'price is text' when ord % 47 = 0 then 'price is no number' end"""


def _listing_v1(t: Tables) -> tuple[DataFrame, DataFrame]:
    records = t.spread(t.sql(LISTING_V1)).select("ord", F.parse_json("value").alias("rec"))
    return split_rejects(parse_listing_v1(records, _run_ts()))


@query(
    "listing_v1",
    f"""select ord, repeat(ship_name, 12) as ship_name, area_main as area_name, area_sub as port_name,
      case when ord % 37 = 0 then null else fishing_date end as fishing_date, depart_time, '' as return_time, fish_types,
      case when ord % 43 = 0 then concat(format('{{:,}}', price), '.5원') when price = 0 then '전화문의' else concat(format('{{:,}}', price), '원') end as price,
      cast(total_seats as bigint) as total_seats, cast(total_seats - 1 as bigint) as reserved_seats,
      cast(remain_seats as bigint) as remain_seats, status_code, cast(ord as varchar) as schedule_no
    from {{seat_listing}} where {_V1_REASON} is null""",
)
def listing_v1(t: Tables) -> DataFrame:
    good, _ = _listing_v1(t)
    return good.drop("collected_at", "fishing_methods", "status_name")


@query(
    "listing_v1_rejects",
    f"""select {_V1_REASON} as reject_reason, count(*) as rows from {{seat_listing}} where {_V1_REASON} is not null group by 1""",
)
def listing_v1_rejects(t: Tables) -> DataFrame:
    _, bad = _listing_v1(t)
    return bad.groupBy("reject_reason").agg(F.count("*").alias("rows"))


LISTING_V2 = f"""
select ord, fishing_date as request_date, to_json(named_struct('ship', if(ord % 71 = 0, null, named_struct('no', ord,
      'name', concat('  ', ship_name, ' '), 'area_main', if(ord % 5 = 0, '', area_main), 'area_sub', area_sub,
      'lat', if(ord % 2 = 0, cast(ord % 90 as double), cast(null as double)), 'lng', cast(ord % 180 as double))),
    'sdate', {_DATE}, 'stime', concat(depart_time, ':00'), 'fish_type', fish_types,
    'remain_embarkation_num', if(ord % 3 = 0, null, remain_seats), 'schedule_status_code', if(ord % 7 = 0, null, status_code),
    'price', parse_json(case ord % 4 when 0 then cast(price as string) when 1 then concat('"', price, '"')
       when 2 then '""' else '"12.5"' end), 'schedule_no', schedule_no)) as value
from {{seat_listing}}
"""


@query(
    "listing_v2",
    """select ord, case when ord % 71 = 0 then null else ord end as feed_ship_no, case when ord % 71 = 0 then '' else ship_name end as ship_name,
      case when ord % 71 = 0 or ord % 5 = 0 then null else area_main end as area_main,
      case when ord % 71 = 0 then '' else area_sub end as area_sub,
      case when ord % 71 = 0 or ord % 2 = 1 then null else cast(ord % 90 as double) end as feed_lat,
      case when ord % 71 = 0 then null else cast(ord % 180 as double) end as feed_lng,
      strftime(fishing_date, '%Y-%m-%d') as sdate, depart_time as stime, fish_types as fish_type,
      cast(case when ord % 3 = 0 then 0 else remain_seats end as bigint) as remain,
      case when ord % 7 = 0 then 'ING' else status_code end as status,
      case when ord % 4 in (0, 1) and price <> 0 then price end as price, schedule_no,
      '' as etime, '' as method, '' as status_name, 'sunsang24' as source from {seat_listing}""",
)
def listing_v2(t: Tables) -> DataFrame:
    raw = t.spread(t.sql(LISTING_V2)).select("ord", "request_date", F.parse_json("value").alias("rec"))
    return parse_listing_v2(raw).drop("request_date")


# --- feed pages -------------------------------------------------------------------------

# Pages of one date hold about ten records whatever the scale; every 13th is empty.
PAGES = """
select fishing_date as request_date, page,
  concat('{"total":', 30 * (3 + day(fishing_date) % 5), ',"list":[',
    if((page * 31 + day(fishing_date)) % 13 = 0, '', array_join(transform(array_sort(collect_list(struct(ord, value))), e -> e.value), ',')),
    ']}') as value
from (select fishing_date, cast(1 + ord div 600 as int) as page, ord, to_json(named_struct('ord', ord)) as value
      from {seat_listing} where fishing_date is not null) r
group by fishing_date, page
"""

_PAGES_SQL = """with p as (select fishing_date as request_date, cast(1 + ord // 600 as int) as page, ord from {seat_listing} where fishing_date is not null),
  sized as (select request_date, page, case when (page * 31 + extract(day from request_date)) % 13 = 0 then 0 else count(*) end as size
    from p group by request_date, page),
  cuts as (select request_date, CUT as last_page from sized group by request_date)
select p.request_date, p.page, cast(row_number() over (partition by p.request_date, p.page order by ord) - 1 as int) as pos, ord
from p join sized s on p.request_date = s.request_date and p.page = s.page and s.size > 0
join cuts c on p.request_date = c.request_date where c.last_page is null or p.page <= c.last_page"""


def _assembled(t: Tables, rule: str) -> DataFrame:
    landed = stored(parse_pages(t.sql(PAGES)), scratch_dir(t.spark, "pages"))
    rows = assemble_pages(landed, rule)
    return rows.select("request_date", "page", "pos", F.variant_get("rec", "$.ord", "bigint").alias("ord"))


@query("page_assembly_empty", _PAGES_SQL.replace("CUT", "min(case when size = 0 then page end) - 1"))
def page_assembly_empty(t: Tables) -> DataFrame:
    return _assembled(t, "empty")


@query("page_assembly_short", _PAGES_SQL.replace("CUT", "min(case when size < 10 then page end)"))
def page_assembly_short(t: Tables) -> DataFrame:
    return _assembled(t, "short")


@query(
    "page_assembly_total",
    _PAGES_SQL.replace(
        "CUT", "coalesce(max(case when page = 1 then 3 + extract(day from request_date) % 5 end), 0)"
    ),
)
def page_assembly_total(t: Tables) -> DataFrame:
    return _assembled(t, "total")


# --- HTML -------------------------------------------------------------------------------

# Calendar pages of up to 30 cells; some cells lack the number, the day or the link.
CALENDAR = """
select cast(bucket as string) as directory_id, 2026 as year, 3 as month,
  concat('<table><tr>', array_join(transform(array_sort(collect_list(struct(ord, cell))), e -> e.cell), ''),
    if(bucket % 5 = 0, '<td><span class="day">27</span><span class="num">5', '</tr></table>')) as html
from (select cast(ord div 30 as bigint) as bucket, ord, concat('<td class="c"><div class="dayline"><span class="day">',
    if(ord % 17 = 0, 'x', cast(1 + ord % 28 as string)), '</span>', if(ord % 7 = 0, '', concat('<b><span class="num a"> ',
    if(ord % 19 = 0, '마감', cast(remain_seats as string)), ' </span></b>')), '</div><ul class="schedule2"><li>',
    replace(fish_types, ', ', '</li><li>'), if(ord % 31 = 0, repeat(' long', 40), ''), '</li><li>a &amp; b<br></ul>', if(ord % 2 = 0 and fishing_date is not null,
    concat('<a href="#" onclick="go(&#39;date=', date_format(fishing_date, 'yyyyMMdd'), '&#39;)">go</a>'), ''), '</td>') as cell
  from {seat_listing}) c
group by bucket
"""


@query(
    "calendar_extract",
    """select directory_id, pos, sdate, remain, fish_str, status from (
    select ord, cast(ord // 30 as varchar) as directory_id, cast(row_number() over (partition by ord // 30 order by ord) - 1 as int) as pos,
      case when ord % 2 = 0 and fishing_date is not null then strftime(fishing_date, '%Y-%m-%d')
        else concat('2026-03-', lpad(cast(1 + ord % 28 as varchar), 2, '0')) end as sdate,
      cast(case when ord % 19 = 0 then 0 else remain_seats end as bigint) as remain,
      concat(replace(fish_types, ', ', ' '), case when ord % 31 = 0 then repeat(' long', 40) else '' end, ' a & b') as fish_str,
      case when ord % 19 = 0 or remain_seats = 0 then 'FULL' else 'ING' end as status
    from {seat_listing} where ord % 7 <> 0) x where ord % 17 <> 0
    union all select cast(ord // 30 as varchar), cast(count(*) filter (ord % 7 <> 0) as int), '2026-03-27', 5, '', 'ING'
      from {seat_listing} where ord // 30 % 5 = 0 group by ord // 30""",
)
def calendar_extract(t: Tables) -> DataFrame:
    return extract_calendar(t.spread(t.sql(CALENDAR))).drop("year", "month")


# One boat page per customer; every fourth has no store id.
DIRECTORY = """
select cast(c_custkey as string) as directory_id, concat('<html><head><title>[', c_mktsegment, '] ', c_name, ' - x</title></head><body>[',
    case c_custkey % 3 when 0 then '여수항 만선호' when 1 then '태안 레드호' else 'none' end, '] <script>',
    case c_custkey % 4 when 0 then concat('st_uid=', c_custkey + 7, '&pa_uid=', c_custkey)
      when 1 then concat("go('", c_custkey + 8, "', pa_uid=", c_custkey, ")")
      when 2 then concat('type1_ajax(1,st_uid=', c_custkey + 9, ')') else 'nothing' end, '</script></body></html>') as html
from {customer}
"""


@query(
    "directory_extract",
    """select cast(c_custkey as varchar) as directory_id, cast(c_custkey + 7 + c_custkey % 4 as varchar) as store_id, c_name as ship_name,
      case c_custkey % 3 when 0 then '여수' when 1 then '태안' else '' end as area_sub from {customer} where c_custkey % 4 <> 3""",
)
def directory_extract(t: Tables) -> DataFrame:
    return extract_directory(t.sql(DIRECTORY))


@query(
    "directory_ids",
    """select page_id, cast(rank - 1 as int) as pos, directory_id from (
      select page_id, directory_id, row_number() over (partition by page_id order by first_ord) as rank from (
        select cast(o_orderkey // 128 as bigint) as page_id, cast(o_custkey % 100 as varchar) as directory_id, min(o_orderkey) as first_ord
        from {orders} group by 1, 2) x) y where rank <= 60""",
)
def linked_ids(t: Tables) -> DataFrame:
    pages = t.sql(
        """select page_id, array_join(transform(array_sort(collect_list(struct(o_orderkey, link))), e -> e.link), ' ') as html
        from (select cast(o_orderkey div 128 as bigint) as page_id, o_orderkey,
            concat('<a href="list.php?k=1&uid=', o_custkey % 100, '">b</a>') as link from {orders}) l group by page_id"""
    )
    return directory_ids(pages, 60)


@query(
    "link_directory",
    """select page_id, trim(regexp_extract(html, '<title>(?:\\[.+?\\])?\\s*(.+?)\\s*[-|]', 1)) as title,
      len(list_distinct(regexp_extract_all(html, 'href=["'']/([^"'']+)["'']', 1))) as links,
      regexp_extract(html, 'href=["'']/([^"'']+)["'']', 1) as first_link from {pages}""",
)
def link_directory(t: Tables) -> DataFrame:
    """Per page its title, its different links and the first one, in one projection."""
    links = distinct_links("html", r"""href=["']/([^"']+)["']""")
    found = t.table("pages").select("page_id", page_title("html").alias("title"), links.alias("found"))
    return found.select(
        "page_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("links"),
        F.coalesce(F.get("found", F.lit(0)), F.lit("")).alias("first_link"),
    )


# --- documents, manifest, payload ---------------------------------------------------------


@query(
    "daily_docs",
    """select strftime(fishing_date, '%Y-%m-%d') as date, ord, ship_name, depart_time, cast(price as bigint) as price,
      cast(remain_seats as bigint) as remain_seats, schedule_no from {seat_listing} where fishing_date is not null""",
)
def documents(t: Tables) -> DataFrame:
    ship = F.parse_json("value")
    kinds = {"ord": "bigint", "ship_name": "string", "depart_time": "string", "price": "bigint", "remain_seats": "bigint", "schedule_no": "string"}
    docs = daily_docs(t.seat_listing, "fishing_date")
    fields = [F.variant_get(ship, f"$.{name}", kind).alias(name) for name, kind in kinds.items()]
    return docs.select(F.date_format("date", "yyyy-MM-dd").alias("date"), *fields)


def _read_back(docs: DataFrame) -> DataFrame:
    with_ord = docs.drop("date").withColumn("ord", F.variant_get("rec", "$.ord", "bigint"))
    return normalize_aliases(with_ord, _run_ts()).select(
        "ord", "ship_name", "fishing_date", "remain_seats"
    )


@query(
    "daily_docs_round_trip",
    """select ord, ship_name, strftime(fishing_date, '%Y-%m-%d') as fishing_date, cast(remain_seats as bigint) as remain_seats
      from {seat_listing} where fishing_date in (date '2026-01-25', date '2026-02-03')""",
)
def documents_round_trip(t: Tables) -> DataFrame:
    """Documents written by date, two dates of them read back."""
    root = scratch_dir(t.spark, "documents")
    write_daily_docs(t.seat_listing, root, "fishing_date")
    return _read_back(load_daily_docs(t.spark, root, ["2026-01-25", "2026-02-03"]))


@query(
    "daily_docs_whole_round_trip",
    """select ord, ship_name, strftime(fishing_date, '%Y-%m-%d') as fishing_date, cast(remain_seats as bigint) as remain_seats
      from {seat_listing} where fishing_date is not null""",
)
def documents_whole_round_trip(t: Tables) -> DataFrame:
    """Documents written by date, all dates read back."""
    root = scratch_dir(t.spark, "documents")
    write_daily_docs(t.seat_listing, root, "fishing_date")
    return _read_back(load_daily_docs(t.spark, root))


@query(
    "manifest_read",
    """with rows as (select ord, ship_name, strftime(fishing_date, '%Y-%m-%d') as fishing_date, cast(remain_seats as bigint) as remain_seats
        from {seat_listing} where fishing_date is not null)
      select 'three' as asked, * from rows where fishing_date in ('2026-01-02', '2026-01-25', '2026-02-03')
      union all select 'latest', * from rows where fishing_date = (select max(fishing_date) from rows)
      union all select 'all', * from rows where extract(day from cast(fishing_date as date)) <> 7""",
)
def manifest_read(t: Tables) -> DataFrame:
    """Documents read as a manifest says: three of its dates, the latest, and all though a day of each month was lost."""
    root = scratch_dir(t.spark, "documents")
    lost = F.dayofmonth("fishing_date") == 7
    write_daily_docs(t.seat_listing.filter(~lost), f"{root}/docs", "fishing_date")
    write_manifest(t.seat_listing, f"{root}/manifest", "now", date="fishing_date", boat="price")
    asked = {"three": {"dates": ["2026-01-02", "2026-01-25", "2026-02-03", "1999-01-01"]}, "latest": {"mode": "latest"}, "all": {}}
    read = [_read_back(load_manifest(t.spark, f"{root}/docs", f"{root}/manifest", **how)).withColumn("asked", F.lit(name)) for name, how in asked.items()]
    return reduce(DataFrame.unionByName, read)


@query(
    "payload_written",
    """select ord - ord % 2 as seq, ship_name, strftime(fishing_date, '%Y-%m-%d') as fishing_date, cast(remain_seats as bigint) as remain_seats,
      cast((select count(*) from {seat_listing}) as bigint) as row_count from {seat_listing}""",
)
def payload_written(t: Tables) -> DataFrame:
    """A payload written twice to one place, the second time whole, read back with its header."""
    root = scratch_dir(t.spark, "payload")
    columns = [c if c in t.seat_listing.columns else "boat_id" for c in PAYLOAD_COLUMNS]
    rows = t.seat_listing.withColumns({"boat_id": F.col("ord") - F.col("ord") % 2})
    named = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in dict.fromkeys([*PAYLOAD_COLUMNS, "ord"])])
    for part in (named.filter("ord % 3 = 0"), named):
        write_payload(part, root, "now", PAYLOAD_COLUMNS, ["ord"])
    header = t.spark.read.text(f"{root}/header").select(F.variant_get(F.parse_json("value"), "$.row_count", "bigint")).scalar()
    back = payload_rows_of_lines(t.spark.read.text(f"{root}/rows"))
    return back.select(F.col("boat_id").alias("seq"), "ship_name", "fishing_date", "remain_seats", header.alias("row_count"))


@query("manifest_dates", "select distinct strftime(fishing_date, '%Y-%m-%d') as date from {seat_listing} where fishing_date is not null")
def manifest_round_trip(t: Tables) -> DataFrame:
    manifest = build_manifest(t.seat_listing, "now", "fishing_date", "price")
    return manifest_dates(manifest)


@query(
    "payload_read",
    """select ord % 50 as pos_in_doc, ship_name, strftime(fishing_date, '%Y-%m-%d') as fishing_date, cast(remain_seats as bigint) as remain_seats,
      status_code, schedule_no from {seat_listing} where ord >= 0""",
)
def payload_read(t: Tables) -> DataFrame:
    """Payload documents of up to 50 positional rows of 16 values."""
    docs = t.sql(
        """select concat('{"updated_at":"now","rows":[', array_join(transform(array_sort(collect_list(struct(ord, line))), e -> e.line), ','), ']}') as value
        from (select ord, concat('["now","', ship_name, '","a","p",', coalesce(concat('"', fishing_date, '"'), 'null'), ',"', depart_time,
            '","","', fish_types, '","","', price, '",', total_seats, ',0,', remain_seats, ',"', status_code, '","","', schedule_no, '"]') as line
          from {seat_listing}) l group by ord div 50"""
    )
    rows = payload_rows(docs)
    return rows.select(
        F.col("pos").cast("bigint").alias("pos_in_doc"),
        "ship_name",
        "fishing_date",
        "remain_seats",
        "status_code",
        "schedule_no",
    )


# --- pipelines ----------------------------------------------------------------------------

# Every page landed twice, the older snapshot with other seats and a total of 0; one page is of a date long past.
SHIP_PAGES = """
select run_ts, request_date, page, concat('{"total":', if(old, 0, 1000000000), ',"list":[',
    array_join(transform(array_sort(collect_list(struct(ord, value))), e -> if(old, replace(e.value, 'remain_embarkation_num":', 'remain_embarkation_num":1'), e.value)), ','), ']}') as value
from (select if(old, timestamp_ntz '2026-01-18 01:00:00', timestamp_ntz '2026-01-20 01:00:00') as run_ts, old,
        if(ord div 600 = 1 and fishing_date = date '2026-02-07', date '2020-01-01', fishing_date) as request_date, cast(1 + ord div 600 as int) as page, ord, value
      from {records} cross join (select explode(array(true, false)) as old) where fishing_date is not null) r
group by run_ts, old, request_date, page
"""

SHIP_RECORDS = f"""
select ord, fishing_date, to_json(named_struct('ship', named_struct('no', ord, 'name', ship_name, 'area_main', area_main,
    'area_sub', area_sub, 'lat', cast(ord % 90 as double), 'lng', cast(ord % 180 as double)),
    'sdate', {_DATE}, 'stime', depart_time, 'remain_embarkation_num', remain_seats, 'schedule_status_code', status_code,
    'price', price, 'schedule_no', schedule_no)) as value
from {{seat_listing}}
"""


def _dims(t: Tables) -> Dims:
    coords = t.sql(
        """select boat_id, cast(30 + boat_id % 10 as double) as lat, cast(120 + boat_id % 10 as double) as lng
        from {entity_map} where boat_id % 3 <> 0"""
    )
    return Dims(t.entity_map, coords, scratch=scratch_dir(t.spark, "unified"))


def _unified(t: Tables) -> DataFrame:
    dims = _dims(t)
    # The pages land as a table; the pipeline starts from there.
    pages = stored(t.spread(t.sql(SHIP_PAGES, records=t.sql(SHIP_RECORDS))), dims.path("landed"))
    # Every boat's page landed before, under another name.
    now, before = F.lit(RUN_TS).cast("timestamp_ntz"), F.lit(RUN_TS - dt.timedelta(days=9)).cast("timestamp_ntz")
    boats = t.sql(DIRECTORY).withColumn("run_ts", now)
    renamed = boats.withColumns({"html": F.replace("html", F.lit("<title>"), F.lit("<title>old ")), "run_ts": before})
    calendars = t.spread(t.sql(CALENDAR))
    spine = days_ahead(t.spark, AS_OF, 60)
    calendar = calendar_listing(boats.unionByName(renamed), calendars, dims, AS_OF)
    return unified_ships(listing_ships(pages, dims, spine=spine), calendar, spine)


_UNIFIED = (
    "with "
    + RESOLVED.strip()
    + """,
  listing as (select * from (
    select *, row_number() over (partition by ship_name, fishing_date, depart_time, schedule_no order by cast(1 + ord // 600 as int), ord) as rn
    from {seat_listing} where fishing_date >= date '2026-01-20' and fishing_date < date '2026-03-21'
      and not (ord // 600 = 1 and fishing_date = date '2026-02-07')) x where rn = 1),
  cells as (select cast(ord // 30 as bigint) as uid, ord, cast(case when ord % 19 = 0 then 0 else remain_seats end as bigint) as remain,
      concat(replace(fish_types, ', ', ' '), case when ord % 31 = 0 then repeat(' long', 40) else '' end, ' a & b') as fish,
      case when ord % 2 = 0 and fishing_date is not null then fishing_date else date '2026-03-01' + cast(ord % 28 as int) end as d
    from {seat_listing} where ord % 7 <> 0 and ord % 17 <> 0
    union all select distinct cast(ord // 30 as bigint), 9000000000, 5, '', date '2026-03-27' from {seat_listing} where ord // 30 % 5 = 0),
  boats as (select c_custkey as uid, c_name as ship_name, case c_custkey % 3 when 0 then '여수' when 1 then '태안' else '' end as area_sub
    from {customer} where c_custkey % 4 <> 3),
  calendar as (select * from (
    select ship_name, area_sub, d, remain, fish, b.uid, row_number() over (partition by b.uid, d order by ord) as rn
    from cells c join boats b on c.uid = b.uid where d >= date '2026-01-20' and d < date '2026-03-21') y where rn = 1),
  unified as (
select cast(boat_id as bigint) as ship_no, l.ord as feed_ship_no, null as directory_id, l.ship_name, l.area_main, l.area_sub,
    case when boat_id % 3 <> 0 then cast(30 + boat_id % 10 as double) else cast(l.ord % 90 as double) end as lat,
    case when boat_id % 3 <> 0 then cast(120 + boat_id % 10 as double) else cast(l.ord % 180 as double) end as lng,
    strftime(fishing_date, '%Y-%m-%d') as sdate, depart_time as stime, '' as etime, '' as fish_type, '' as method,
    cast(remain_seats as bigint) as remain, status_code as status, '' as status_name, nullif(cast(price as bigint), 0) as price, schedule_no,
    'sunsang24' as source
  from listing l left join resolved r on l.ship_name = r.ship_name and l.area_sub = r.area_sub
union all
select null, null, cast(uid as varchar), ship_name, case area_sub when '여수' then '전남' when '태안' then '충남' else '기타' end, area_sub, null, null,
    strftime(d, '%Y-%m-%d'), '', '', fish, '', remain, case when remain > 0 then 'ING' else 'FULL' end,
    case when remain > 0 then '예약가능' else '예약마감' end, null, concat('tf_', uid, '_', strftime(d, '%Y-%m-%d')), 'thefishing'
  from calendar)
"""
)


@query("unified_ships", _UNIFIED + "select * from unified")
def unified(t: Tables) -> DataFrame:
    return _unified(t).drop("bucket", "source_rank", "ord")


@query(
    "unified_payload",
    _UNIFIED
    + """select '2026-01-20T01:00:00Z' as collected_at, ship_name, area_main as area_name, area_sub as port_name, sdate as fishing_date,
      stime as depart_time, etime as return_time, fish_type as fish_types, method as fishing_methods, coalesce(cast(price as varchar), '') as price,
      0 as total_seats, 0 as reserved_seats, remain as remain_seats, status as status_code, status_name, schedule_no, ship_no as boat_id, source, lat, lng
    from unified""",
)
def unified_payload(t: Tables) -> DataFrame:
    """The 20 payload columns of the unified table, written as a payload and read back."""
    root = scratch_dir(t.spark, "payload")
    write_payload(ships_to_payload(_unified(t), "2026-01-20T01:00:00Z"), root, "now", PAYLOAD_COLUMNS)
    return payload_rows_of_lines(t.spark.read.text(f"{root}/rows"))


_INGEST = """landed as (
  select cast(ord % 2 as int) as half, ord, ship_name, area_main as area_name, area_sub as port_name, fishing_date, depart_time,
    case when ord % 3 = 2 then fish_types else replace(fish_types, ', ', ',') end as fish_types, cast(price as varchar) as price,
    cast(case when ord % 3 = 2 then 0 else total_seats end as bigint) as total_seats, cast(remain_seats as bigint) as remain_seats,
    status_code, schedule_no from {seat_listing})"""


@query(
    "incremental_ingest",
    f"""with {_INGEST} select ship_name, area_name, port_name, fishing_date, depart_time, fish_types, price, total_seats, remain_seats, status_code, schedule_no
      from (select *, row_number() over (partition by ship_name, fishing_date, depart_time, schedule_no order by half desc, ord desc) as rn from landed) x
      where rn = 1""",
)
def incremental_ingest(t: Tables) -> DataFrame:
    """Two landings of documents, ingested as streams, and a replay that must change nothing.

    A key's records in one landing lie in order within a document, and in documents that land one after the other, so its last one wins.
    """
    root, _ = _ingested(t)
    return read_seats(t.spark, f"{root}/seats").select(
        "ship_name", "area_name", "port_name", "fishing_date", "depart_time", "fish_types", "price", "total_seats", "remain_seats",
        "status_code", "schedule_no",
    )


@query(
    "ingest_repeats",
    f"""with {_INGEST} select ship_name, area_name, port_name, fishing_date, depart_time, fish_types, price, total_seats, remain_seats, status_code, schedule_no, 2 as versions
      from (select *, row_number() over (partition by ship_name, fishing_date, depart_time, schedule_no order by half desc, ord desc) as rn from landed) x
      where rn = 1""",
)
def ingest_repeats(t: Tables) -> DataFrame:
    """Two landings, then the first one's texts again in new files: no merge, and no older rows over newer ones."""
    root, _ = _ingested(t, (0, 1, 0), repeats_within="1 day")
    versions = F.lit(len(seats(t.spark, f"{root}/seats").versions()))
    return read_seats(t.spark, f"{root}/seats").select(
        "ship_name", "area_name", "port_name", "fishing_date", "depart_time", "fish_types", "price", "total_seats", "remain_seats",
        "status_code", "schedule_no", versions.alias("versions"),
    )


@query(
    "ingest_history",
    """select half as batch, '성공' as status, cast(count(*) as bigint) as rows_in, cast(count(distinct (ship_name, fishing_date, depart_time, schedule_no)) as bigint) as row_count,
      cast(2 as bigint) as rejected from (select ord % 2 as half, * from {seat_listing}) x group by half""",
)
def ingest_history(t: Tables) -> DataFrame:
    """The history of two landings, each with a broken document and an odd record."""
    root, state = _ingested(t)
    runs = read_history(t.spark, f"{state}/history")
    rejects = t.spark.read.parquet(f"{state}/rejects").groupBy("batch").agg(F.count("*").alias("rejected"))
    return runs.join(rejects, runs["batch_id"].cast("int") == rejects["batch"]).select(
        F.col("batch").cast("bigint").alias("batch"),
        "status",
        F.regexp_extract("note", "rows ([0-9]+)", 1).cast("bigint").alias("rows_in"),
        "row_count",
        "rejected",
    )


def _run(t: Tables, root: str, repeats_within: str | None) -> None:
    """A landing is one batch, and so one version of the table, however many files it has."""
    files = len(list_names(t.spark, f"{root}/landing"))
    run_incremental(t.spark, f"{root}/landing", f"{root}/seats", f"{root}/state", files, repeats_within)


# Records of a landed document.
DOC_RECORDS = 2000


def _ingested(t: Tables, halves: tuple[int, ...] = (0, 1), repeats_within: str | None = None) -> tuple[str, str]:
    root = scratch_dir(t.spark, "incremental")
    # A document holds two thousand records at most, however many there are of its keys; the first of two buckets have the odd ones.
    buckets = max(2, t.table("orders").count() // (2 * DOC_RECORDS))
    docs = t.sql(
        f"""select half, bucket, chunk, concat('[', array_join(transform(array_sort(collect_list(struct(ord, value))), e -> e.value), ','),
          if(half = bucket and chunk = 0, ',7]', ']')) as value
        from (select *, (row_number() over (partition by half, bucket order by ord, value) - 1) div {DOC_RECORDS} as chunk
          from (select cast(ord % 2 as int) as half, pmod(key, {buckets}) as bucket, ord, value from {{aliased}}) r) c group by half, bucket, chunk""",
        aliased=t.sql(ALIASED.replace("select ord,", f"select ord, crc32(concat_ws('|', ship_name, {_DATE}, depart_time, schedule_no)) as key,")),
    )
    for half in halves:
        # A bucket is one partition: its documents are written one after the other, so that of a key's records the last lands last.
        # Buckets come in the order of the shuffle that makes them, as without chunks: null and empty names are two buckets but one key.
        place = F.pmod(F.hash("half", "bucket"), F.lit(int(t.spark.conf.get("spark.sql.shuffle.partitions"))))
        landing = docs.filter(F.col("half") == half).sortWithinPartitions(place, "bucket", "chunk").select("value")
        broken = t.spark.range(1).select(F.lit('[{"name":').alias("value"))
        files = landing.union(broken).write.mode("append").option("maxRecordsPerFile", 1)
        files.text(f"{root}/landing")
        _run(t, root, repeats_within)
    _run(t, root, repeats_within)
    return root, f"{root}/state"
