"""Registered queries on the seat listing: dedup, upsert, entities, filters, facets, pages."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from berthline.operators import entities as E
from berthline.operators import listing as L
from berthline.operators import rollups as C
from berthline.operators.dedup import (
    dedup_audit,
    dedup_first,
    dedup_last,
    drop_seen,
    merge_sources,
)
from berthline.dims import entity_index
from berthline.operators.page_index import PageIndex
from berthline.operators.search_index import SearchIndex
from berthline.operators.synonyms import expand_terms
from berthline.plans.availability import listing_query
from berthline.schemas import NATURAL_KEY
from berthline.session import scratch_dir
from berthline.sinks.documents import build_manifest, payload_lines
from berthline.sinks.tables import merged
from berthline.workloads.fixtures import Tables
from berthline.workloads.registry import query

AS_OF = dt.date(2026, 1, 20)
START = dt.date(2026, 1, 1)
SYNONYMS = [
    ("ECONOMY", ["ECONOMY", "LARGE"]),
    ("SMALL", ["SMALL", "PROMO", "STANDARD"]),
    ("PROMO", ["PROMO", "SMALL"]),
]
TIES = ["ord"]

COLS = "ord, ship_name, area_sub, fishing_date, depart_time, schedule_no, price, remain_seats, status_code, source"
_NAMES = COLS.split(", ")
_KEY = "ship_name, fishing_date, depart_time, schedule_no"


def _typed(cols: str = COLS) -> str:
    return cols.replace("remain_seats", "cast(remain_seats as int) as remain_seats")


def seats(t: Tables) -> DataFrame:
    """The listing under the snapshot table's column names."""
    return t.seat_listing.withColumnsRenamed({"area_main": "area_name", "area_sub": "port_name"})


# --- dedup and upsert ---------------------------------------------------------------


def _ranked(order: str, where: str = "true", key: str = _KEY) -> str:
    return (
        f"select *, row_number() over (partition by {key} order by {order}) as rn "
        f"from {{seat_listing}} where {where}"
    )


@query("dedup_last", f"select {_typed()} from ({_ranked('ord desc')}) x where rn = 1")
def last(t: Tables) -> DataFrame:
    return dedup_last(t.seat_listing, NATURAL_KEY, "ord").select(*_NAMES)


@query("dedup_first", f"select {_typed()} from ({_ranked('source, ord')}) x where rn = 1")
def first(t: Tables) -> DataFrame:
    a = t.seat_listing.filter(F.col("source") == "a")
    b = t.seat_listing.filter(F.col("source") == "b")
    return merge_sources([(0, a), (1, b)], NATURAL_KEY).select(*_NAMES)


@query("dedup_first_in_source", f"select {_typed()} from ({_ranked('ord')}) x where rn = 1")
def first_in_source(t: Tables) -> DataFrame:
    return dedup_first(t.seat_listing, NATURAL_KEY, "ord").select(*_NAMES)


@query(
    "source_b_unseen",
    f"""select {_typed()} from {{seat_listing}} b where source = 'b' and not exists (select 1 from {{seat_listing}} a
      where a.source = 'a' and a.ship_name = b.ship_name and a.fishing_date is not distinct from b.fishing_date
        and a.depart_time = b.depart_time and a.schedule_no = b.schedule_no)""",
)
def unseen(t: Tables) -> DataFrame:
    a = t.seat_listing.filter(F.col("source") == "a")
    b = t.seat_listing.filter(F.col("source") == "b")
    return drop_seen(b, a, NATURAL_KEY).select(*_NAMES)


@query(
    "dedup_audit",
    f"""select cast(sum(n) as bigint) as rows_in, count(*) as rows_out, cast(sum(n) - count(*) as bigint) as removed
      from (select count(*) as n from {{seat_listing}} group by {_KEY}) x""",
)
def audit(t: Tables) -> DataFrame:
    return dedup_audit(t.seat_listing, NATURAL_KEY)


def _collected(df: DataFrame) -> DataFrame:
    return df.withColumn("collected_at", F.date_add(F.lit(START), (F.col("ord") % 5).cast("int")))


@query(
    "upsert_result",
    f"""select {_typed()} from (select *, row_number() over (partition by {_KEY}
      order by ord % 2 desc, ord % 5 desc, ord desc) as rn from {{seat_listing}}) x where rn = 1""",
)
def upsert_result(t: Tables) -> DataFrame:
    rows = _collected(t.seat_listing)
    target = dedup_last(rows.filter("ord % 2 = 0"), NATURAL_KEY, ["collected_at", "ord"])
    batch = rows.filter("ord % 2 = 1")
    return merged(target, batch, ord="ord", guard_late=False).select(*_NAMES)


@query(
    "upsert_late_guard",
    f"""select {_typed()} from (select *, row_number() over (partition by {_KEY}
      order by ord % 5 desc, ord % 2 desc, ord desc) as rn from {{seat_listing}}) x where rn = 1""",
)
def upsert_late_guard(t: Tables) -> DataFrame:
    rows = _collected(t.seat_listing)
    target = dedup_last(rows.filter("ord % 2 = 0"), NATURAL_KEY, ["collected_at", "ord"])
    batch = rows.filter("ord % 2 = 1")
    return merged(target, batch, ord="ord").select(*_NAMES)


# --- entities -------------------------------------------------------------------------

RESOLVED = """
pairs as (select distinct ship_name, area_sub from {seat_listing}),
single as (select name from {entity_map} group by name having count(*) = 1),
hits as (
  select ship_name, area_sub, boat_id, ord, case
      when name = ship_name and area = area_sub then 1
      when name = ship_name and area_sub <> '' and area <> '' and (contains(area_sub, area) or contains(area, area_sub)) then 2
      when name = ship_name and name in (select name from single) then 3
      when ship_name <> '' and (contains(ship_name, name) or contains(name, ship_name)) and name in (select name from single) then 4
    end as stage
  from pairs, {entity_map}
),
resolved as (
  select ship_name, area_sub, boat_id, stage from (
    select *, row_number() over (partition by ship_name, area_sub order by stage, ord) as rn from hits where stage is not null
  ) x where rn = 1
)
"""


def resolved_sql(select: str) -> str:
    return "with " + RESOLVED.strip() + "\n" + select


@query(
    "entity_exact",
    """select l.ord, ship_name, area_sub, cast(boat_id as bigint) as boat_id from {seat_listing} l
      join {entity_map} m on ship_name = name and area_sub = area""",
)
def entity_exact(t: Tables) -> DataFrame:
    exact = E.resolve_exact(t.seat_listing, t.entity_map)
    return exact.select("ord", "ship_name", "area_sub", F.col("boat_id").cast("bigint"))


@query(
    "entity_staged",
    resolved_sql(
        """select l.ord, l.ship_name, l.area_sub, cast(boat_id as bigint) as boat_id, stage as match_stage
      from {seat_listing} l left join resolved r on l.ship_name = r.ship_name and l.area_sub = r.area_sub"""
    ),
)
def entity_staged(t: Tables) -> DataFrame:
    return E.resolve_entities(t.seat_listing, t.entity_map, scratch=scratch_dir(t.spark, "entities")).select(
        "ord", "ship_name", "area_sub", F.col("boat_id").cast("bigint"), "match_stage"
    )


@query(
    "entity_report",
    resolved_sql(
        """select l.ship_name, l.area_sub, count(*) as rows, cast(max(boat_id) as bigint) as boat_id,
        max(boat_id) is not null as mapped
      from {seat_listing} l left join resolved r on l.ship_name = r.ship_name and l.area_sub = r.area_sub group by 1, 2"""
    ),
)
def entity_report(t: Tables) -> DataFrame:
    report = E.entity_report(E.resolve_entities(t.seat_listing, t.entity_map, scratch=scratch_dir(t.spark, "entities")))
    return report.withColumn("boat_id", F.col("boat_id").cast("bigint"))


@query(
    "entity_index",
    """select name, count(*) as entries, cast(min(ord) as bigint) as ord, cast(min_by(boat_id, ord) as bigint) as boat_id,
      string_agg(concat(area, ':', boat_id), ',' order by ord) as boats from {entity_map} group by name""",
)
def index(t: Tables) -> DataFrame:
    boats = F.transform("boats", lambda b: F.concat_ws(":", b["area"], b["boat_id"].cast("string")))
    return entity_index(t.entity_map).select(
        "name",
        "entries",
        F.col("ord").cast("bigint"),
        F.col("boat_id").cast("bigint"),
        F.array_join(boats, ",").alias("boats"),
    )


@query(
    "coordinates",
    resolved_sql(
        """select l.ord, cast(boat_id as bigint) as boat_id,
        case when boat_id % 3 <> 0 then cast(30 + boat_id % 10 as double) else cast(l.ord % 90 as double) end as lat,
        case when boat_id % 3 <> 0 then cast(120 + boat_id % 10 as double) else cast(l.ord % 180 as double) end as lng
      from {seat_listing} l left join resolved r on l.ship_name = r.ship_name and l.area_sub = r.area_sub"""
    ),
)
def coordinates(t: Tables) -> DataFrame:
    coords = t.sql(
        """select boat_id, cast(30 + boat_id % 10 as double) as lat, cast(120 + boat_id % 10 as double) as lng
        from {entity_map} where boat_id % 3 <> 0"""
    )
    feed = t.seat_listing.withColumns(
        {
            "feed_lat": (F.col("ord") % 90).cast("double"),
            "feed_lng": (F.col("ord") % 180).cast("double"),
        }
    )
    found = E.resolve_entities(feed, t.entity_map, coords=coords, scratch=scratch_dir(t.spark, "entities"))
    located = E.choose_coordinates(found, ("feed_lat", "feed_lng"))
    return located.select("ord", F.col("boat_id").cast("bigint"), "lat", "lng")


@query(
    "area_lookup",
    """with best as (select area_sub, min_by(main, ord) as main from
        (select distinct area_sub from {seat_listing}) a, {area_table} where contains(area_sub, sub) group by 1)
      select l.ord, l.area_sub, coalesce(main, 'other') as area_main from {seat_listing} l
      left join best b on l.area_sub = b.area_sub""",
)
def area_lookup(t: Tables) -> DataFrame:
    rows = t.seat_listing.drop("area_main")
    return E.lookup_area(rows, t.area_table, "other").select("ord", "area_sub", "area_main")


# --- dates ----------------------------------------------------------------------------


@query(
    "date_spine",
    """select date, count(ord) as rows from (select cast(unnest(generate_series(date '2026-01-01', date '2026-04-30', interval 1 day)) as date) as date) s
      left join {seat_listing} on fishing_date = date group by date""",
)
def date_spine(t: Tables) -> DataFrame:
    """Rows of every day of a spine, 0 for days without any."""
    counts = t.seat_listing.groupBy(F.col("fishing_date").alias("date")).agg(F.count("*").alias("rows"))
    spine = C.date_spine(t.spark, START, dt.date(2026, 4, 30))
    return spine.join(counts, "date", "left").select("date", F.coalesce("rows", F.lit(0)).alias("rows"))


@query(
    "window_semi",
    f"select {_typed()} from {{seat_listing}} where fishing_date between date '2026-01-20' and date '2026-02-02'",
)
def window_semi(t: Tables) -> DataFrame:
    spine = C.days_ahead(t.spark, AS_OF, 14)
    return C.in_window(t.seat_listing, spine).select(*_NAMES)


@query(
    "coverage_gaps",
    """select date from (select cast(unnest(generate_series(date '2026-01-01', date '2026-04-30', interval 1 day)) as date) as date) s
      where date not in (select fishing_date from {seat_listing} where fishing_date is not null and extract(day from fishing_date) <> 9)""",
)
def coverage_gaps(t: Tables) -> DataFrame:
    spine = C.date_spine(t.spark, START, dt.date(2026, 4, 30))
    return C.coverage_gaps(t.seat_listing.filter(F.dayofmonth("fishing_date") != 9), spine)


@query(
    "spine_months",
    "select distinct cast(extract(year from fishing_date) as int) as year, cast(extract(month from fishing_date) as int) as month "
    "from {seat_listing} where fishing_date is not null",
)
def spine_months(t: Tables) -> DataFrame:
    dates = L.facet_dates(t.seat_listing).withColumnRenamed("fishing_date", "date")
    return C.spine_months(dates)


@query(
    "future_only", f"select {_typed()} from {{seat_listing}} where fishing_date >= date '2026-01-20'"
)
def future_only(t: Tables) -> DataFrame:
    return L.future_only(t.seat_listing, AS_OF, "fishing_date").select(*_NAMES)


# --- counts ---------------------------------------------------------------------------


@query(
    "summary_cards",
    """select count(*) as ships, count(*) filter (status_code = 'ING') as avail, count(*) filter (status_code = 'END') as full,
      cast(sum(remain_seats) as bigint) as seats, count(*) filter (remain_seats > 0) as with_seats,
      count(distinct fishing_date) + max(case when fishing_date is null then 1 else 0 end) as dates from {seat_listing}""",
)
def summary_cards(t: Tables) -> DataFrame:
    return L.summary_cards(t.seat_listing)


@query(
    "daily_doc_counts",
    resolved_sql(
        """select fishing_date as date, count(*) as total, count(boat_id) as af_matched
      from {seat_listing} l left join resolved r on l.ship_name = r.ship_name and l.area_sub = r.area_sub
      where fishing_date is not null group by 1"""
    ),
)
def daily_doc_counts(t: Tables) -> DataFrame:
    return E.matched_per_date(t.seat_listing, t.entity_map, scratch=scratch_dir(t.spark, "entities"))


@query(
    "manifest",
    """select concat('{"dates":[', string_agg(concat('{"date":"', strftime(d, '%Y-%m-%d'), '","total":', n, ',"af_matched":', m, '}'),
        ',' order by d), '],"updated_at":"now"}') as value
      from (select fishing_date as d, count(*) as n, count(*) filter (price <> 0) as m from {seat_listing}
        where fishing_date is not null group by 1) x""",
)
def manifest(t: Tables) -> DataFrame:
    return build_manifest(t.seat_listing, "now", "fishing_date", "price")


@query(
    "payload_lines",
    """select concat('["', ship_name, '",', case when fishing_date is null then 'null' else concat('"', strftime(fishing_date, '%Y-%m-%d'), '"') end,
      ',"', depart_time, '",', price, ',', remain_seats, ']') as value from {seat_listing}""",
)
def payload(t: Tables) -> DataFrame:
    columns = ["ship_name", "fishing_date", "depart_time", "price", "remain_seats"]
    return payload_lines(t.seat_listing, columns)


@query("source_totals", "select source, count(*) as rows from {seat_listing} group by 1")
def source_totals(t: Tables) -> DataFrame:
    return C.source_totals(t.seat_listing)


@query(
    "chunk_running",
    """select chunk, n as rows, cast(sum(n) over (order by chunk) as bigint) as running from
      (select cast(date_diff('day', date '2026-01-01', fishing_date) // 30 as bigint) as chunk, count(*) as n
       from {seat_listing} where fishing_date >= date '2026-01-01' group by 1) x""",
)
def chunk_running(t: Tables) -> DataFrame:
    return C.chunk_running(t.seat_listing, START)


# --- facets, filters, search ------------------------------------------------------------


@query("facet_dates", "select distinct fishing_date from {seat_listing} where fishing_date is not null")
def facet_dates(t: Tables) -> DataFrame:
    return L.facet_dates(t.seat_listing)


@query(
    "facet_species",
    """select distinct trim(s) as species from (select unnest(string_split(fish_types, ',')) as s from {seat_listing}) x
      where trim(s) <> ''""",
)
def facet_species(t: Tables) -> DataFrame:
    return L.facet_species(t.seat_listing)


FILTERS = L.Filters(
    query="PROMO NATION_1",
    name="ED",
    species="PROMO",
    date=dt.date(2026, 1, 25),
    status="ING",
    seats_only=True,
)
_TEXT = "lower(concat_ws(' ', ship_name, fish_types, area_main, area_sub))"
_FILTER_SQL = f"""(contains({_TEXT}, 'promo') or contains({_TEXT}, 'small')) and contains({_TEXT}, 'nation_1')
  and contains(lower(ship_name), 'ed') and (contains(fish_types, 'PROMO') or contains(fish_types, 'SMALL'))
  and fishing_date = date '2026-01-25' and status_code = 'ING' and remain_seats > 0"""


@query("filter_compose", f"select {_typed()} from {{seat_listing}} where {_FILTER_SQL}")
def filter_compose(t: Tables) -> DataFrame:
    hits = L.apply_filters(seats(t), FILTERS, SYNONYMS)
    return hits.withColumnRenamed("port_name", "area_sub").select(*_NAMES)


@query(
    "filter_counts",
    f"select count(*) filter ({_FILTER_SQL}) as shown, count(*) as total from {{seat_listing}}",
)
def filter_counts(t: Tables) -> DataFrame:
    return L.filter_counts(seats(t), FILTERS, SYNONYMS)


@query(
    "species_filter",
    """select ord, fish_types from {seat_listing} where contains(fish_types, 'ECONOMY') or contains(fish_types, 'LARGE')
      or fish_types in ('L', 'E')""",
)
def species_filter(t: Tables) -> DataFrame:
    hits = L.apply_filters(seats(t), L.Filters(species="LARG"), SYNONYMS)
    return hits.select("ord", "fish_types")


@query(
    "search_words",
    f"""select ord, ship_name, fish_types from {{seat_listing}}
      where (contains({_TEXT}, 'economy') or contains({_TEXT}, 'large')) and contains({_TEXT}, 'gear')""",
)
def search_words(t: Tables) -> DataFrame:
    return L.search_words(seats(t), " ECONOMY  Gear ", SYNONYMS).select(
        "ord", "ship_name", "fish_types"
    )


@query(
    "fuzzy_search",
    f"""select ord, ship_name from {{seat_listing}} where contains({_TEXT}, 'widgt')
      or len(list_filter(regexp_split_to_array({_TEXT}, '[\\s,]+'), lambda w: w <> '' and levenshtein(w, 'widgt') <= 1)) > 0""",
)
def fuzzy_search(t: Tables) -> DataFrame:
    return L.fuzzy_search(seats(t), "widgt", SYNONYMS).select("ord", "ship_name")


def _index(t: Tables) -> SearchIndex:
    return SearchIndex.build(t.spread(seats(t)), scratch_dir(t.spark, "search"))


@query(
    "search_indexed",
    f"""select 'words' as search, ord, ship_name, fish_types from {{seat_listing}}
      where (contains({_TEXT}, 'economy') or contains({_TEXT}, 'large')) and contains({_TEXT}, 'gear')
    union all select 'short', ord, ship_name, fish_types from {{seat_listing}} where contains({_TEXT}, '9') and contains({_TEXT}, 'ro')
    union all select 'korean', ord, ship_name, fish_types from {{seat_listing}} where contains({_TEXT}, '만선호')""",
)
def search_indexed(t: Tables) -> DataFrame:
    """Searches by posting lists: two words with synonyms, two short words, a frequent word; one more finds nothing."""
    index = _index(t)
    asked = {"words": " ECONOMY  Gear ", "short": "9 Ro", "korean": "만선호", "nothing": "gear qqqq"}
    found = [index.search_words(q, SYNONYMS).select(F.lit(name).alias("search"), "ord", "ship_name", "fish_types") for name, q in asked.items()]
    return reduce(DataFrame.unionByName, found)


def _near(term: str, edits: int) -> str:
    tokens = f"regexp_split_to_array({_TEXT}, '[\\s,]+')"
    return f"(contains({_TEXT}, '{term}') or len(list_filter({tokens}, lambda w: w <> '' and levenshtein(w, '{term}') <= {edits})) > 0)"


@query(
    "fuzzy_indexed",
    f"""select 'one' as search, ord, ship_name from {{seat_listing}} where {_near("widgt", 1)}
    union all select 'two', ord, ship_name from {{seat_listing}} where {_near("geer", 1)} and {_near("ntion_77", 2)}
    union all select 'long', ord, ship_name from {{seat_listing}} where {_near("natiion_119", 3)}""",
)
def fuzzy_indexed(t: Tables) -> DataFrame:
    """Misspelled words by deletion neighbourhoods, a longer one against the different tokens."""
    index = _index(t)
    asked = {"one": "widgt", "two": "geer Ntion_77", "long": "natiion_119"}
    found = [index.fuzzy_search(q, SYNONYMS).select(F.lit(name).alias("search"), "ord", "ship_name") for name, q in asked.items()]
    return reduce(DataFrame.unionByName, found)


@query(
    "expand_terms",
    """with syn as (select n_nationkey as ord, n_name as term, concat(r_name, ',', n_name) as words from {nation} join {region} on n_regionkey = r_regionkey),
      terms as (select distinct case when o_orderkey % 3 = 0 then concat('x', n_name) when o_orderkey % 3 = 1 then n_name else p_type end as term
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey join {part} on p_partkey = o_orderkey % (select count(*) from {part})),
      hits as (select t.term, words, ord, case when t.term = s.term then 1 when contains(t.term, split_part(words, ',', 1)) or contains(t.term, split_part(words, ',', 2))
        or contains(split_part(words, ',', 1), t.term) or contains(split_part(words, ',', 2), t.term) then 2 end as stage from terms t, syn s)
    select t.term, coalesce(b.words, t.term) as expansion from terms t left join
      (select term, words from (select *, row_number() over (partition by term order by stage, ord) as rn from hits where stage is not null) x where rn = 1) b
      on t.term = b.term""",
)
def expanded(t: Tables) -> DataFrame:
    terms = t.sql(
        """select distinct case when o_orderkey % 3 = 0 then concat('x', n_name) when o_orderkey % 3 = 1 then n_name else p_type end as term
        from (select *, o_orderkey % (select count(*) from {part}) as o_partkey from {orders}) o
          join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey join {part} on p_partkey = o_partkey"""
    )
    synonyms = t.sql(
        """select n_nationkey as ord, n_name as term, array(r_name, n_name) as synonyms
        from {nation} join {region} on n_regionkey = r_regionkey"""
    )
    return expand_terms(terms, synonyms).select(
        "term", F.array_join("expansion", ",").alias("expansion")
    )


# --- pages ------------------------------------------------------------------------------


@query(
    "sorted_page",
    f"select {_typed()} from {{seat_listing}} order by ship_name collate ko desc, ord limit 50 offset 100",
)
def sorted_page(t: Tables) -> DataFrame:
    page = L.sort_page(seats(t), "ship_name", False, 3, ties=TIES)
    return page.withColumnRenamed("port_name", "area_sub").select(*_NAMES)


@query(
    "default_page",
    f"select {_typed()} from {{seat_listing}} order by fishing_date nulls first, ord limit 50 offset 400",
)
def default_page(t: Tables) -> DataFrame:
    page = L.sort_page(seats(t), page=9, ties=TIES)
    return page.withColumnRenamed("port_name", "area_sub").select(*_NAMES)


@query(
    "page_after",
    f"""select {_typed()} from {{seat_listing}} where fishing_date > date '2026-01-31' or
      (fishing_date = date '2026-01-31' and ord > 700) order by fishing_date, ord limit 50""",
)
def page_after(t: Tables) -> DataFrame:
    after = {"fishing_date": dt.date(2026, 1, 31), "ord": 700}
    page = L.page_after(seats(t), after, ties=TIES)
    return page.withColumnRenamed("port_name", "area_sub").select(*_NAMES)


@query(
    "deep_pages",
    f"""with sized as (select count(*) as n from {{seat_listing}}),
      named as (select *, row_number() over (order by ship_name collate ko desc, ord) - 1 as place from {{seat_listing}}),
      dated as (select *, row_number() over (order by fishing_date nulls first, ord) - 1 as place from {{seat_listing}})
    select 'names' as sorted, cast(place // 50 + 1 as int) as page, {_typed()} from named, sized where place // 50 in ((n - 1) // 50, n // 100)
    union all select 'dates', cast(place // 50 + 1 as int), {_typed()} from dated, sized where place // 50 in ((n - 1) // 50, n // 100, 0)""",
)
def deep_pages(t: Tables) -> DataFrame:
    """The first, middle and last pages of two orders, read from their ranges."""
    out = []
    for name, col, asc in (("names", "ship_name", False), ("dates", "fishing_date", True)):
        index = PageIndex.build(seats(t), scratch_dir(t.spark, "pages"), col, asc, TIES, range_rows=1000)
        wanted = {index.rows // 100 + 1, index.page_count(), *([1] if asc else [])}
        pages = [index.page(n).withColumn("page", F.lit(n)) for n in sorted(wanted | {index.page_count() + 1})]
        out += [p.withColumnRenamed("port_name", "area_sub").select(F.lit(name).alias("sorted"), "page", *_NAMES) for p in pages]
    return reduce(DataFrame.unionByName, out)


@query("page_count", "select cast(ceil(count(*) / 50.0) as bigint) as pages from {seat_listing}")
def page_count(t: Tables) -> DataFrame:
    return L.page_count(t.seat_listing)


@query(
    "group_headers",
    """select ord, fishing_date, lag(fishing_date) over (order by remain_seats, ord) is distinct from fishing_date
      and not (fishing_date is null and lag(fishing_date) over (order by remain_seats, ord) is null) as group_header
    from (select * from {seat_listing} order by remain_seats, ord limit 50) x""",
)
def group_headers(t: Tables) -> DataFrame:
    page = listing_query(seats(t), col="remain_seats", ties=TIES)
    return page.select("ord", "fishing_date", "group_header")


@query(
    "seat_class",
    """with r as (select ord, remain_seats, remain_seats / case when total_seats = 0 then 1.0 else cast(total_seats as double) end as ratio
      from {seat_listing})
    select ord, case when remain_seats = 0 then 'seat-zero' when ratio > 0.5 then 'seat-high' when ratio > 0.2 then 'seat-mid'
      else 'seat-low' end as seat_class, cast(floor(ratio * 100 + 0.5) as bigint) as fill_pct from r""",
)
def seat_class(t: Tables) -> DataFrame:
    return L.seat_display(t.seat_listing).select("ord", "seat_class", "fill_pct")
