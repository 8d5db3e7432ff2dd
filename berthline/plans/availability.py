"""Pipelines: two marketplaces to one ship table, and listing queries over it."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from berthline.operators.dedup import merge_sources
from berthline.operators.entities import choose_coordinates, lookup_area, resolve_entities
from berthline.operators.listing import (
    Filters,
    Synonyms,
    apply_filters,
    mark_group_headers,
    seat_display,
    sort_keys,
    sort_page,
)
from berthline.operators.rollups import in_window
from berthline.schemas import SHIP_KEY, SHIP_ROW
from berthline.session import stored
from berthline.sources.html_pages import extract_calendar, extract_directory, newest_page
from berthline.sources.landed import assemble_pages, parse_pages
from berthline.sources.listing import calendar_ships, parse_listing_v2


@dataclass(frozen=True)
class Dims:
    """Reference dimensions of the ship table.

    ``scratch`` is a folder that executors share: parsed rows and resolved pairs
    are then stored there, so that landed pages are parsed once.  Without it the
    pipelines stay lazy.
    """

    entities: DataFrame
    coords: DataFrame
    areas: DataFrame | list[tuple[str, str]] | None = None
    scratch: str | None = None

    def path(self, label: str) -> str | None:
        return f"{self.scratch}/{label}-{uuid.uuid4().hex}" if self.scratch else None


def _enrich(ships: DataFrame, dims: Dims, strict: bool, feed: tuple[str, str] | None) -> DataFrame:
    located = lookup_area(ships, dims.areas)
    resolved = resolve_entities(located, dims.entities, strict, dims.coords, dims.scratch)
    return choose_coordinates(resolved.drop("match_stage"), feed).withColumnRenamed(
        "boat_id", "ship_no"
    )


def _order(run_ts: Column, request_date: Column, page: Column, pos: Column) -> Column:
    return F.struct(
        run_ts.cast("timestamp_ntz").alias("run_ts"),
        request_date.cast("string").alias("request_date"),
        page.cast("bigint").alias("page"),
        pos.cast("bigint").alias("pos"),
    )


def listing_ships(
    pages: DataFrame, dims: Dims, strict: bool = True, spine: DataFrame | None = None
) -> DataFrame:
    """Ship rows of landed feed pages (run_ts, request_date, page, value).

    Of a page that landed more than once the newest snapshot counts, and with a
    spine only its dates: both before any page is parsed.
    """
    if "run_ts" not in pages.columns:
        pages = pages.withColumn("run_ts", F.lit(None).cast("timestamp_ntz"))
    wanted = in_window(pages, spine, "request_date") if spine is not None else pages
    landed = parse_pages(newest_page(wanted, ["request_date", "page"]))
    page_path, path = dims.path("pages"), dims.path("listing")
    parsed = parse_listing_v2(
        assemble_pages(stored(landed, page_path) if page_path else landed, "total")
    )
    ships = _enrich(stored(parsed, path) if path else parsed, dims, strict, ("feed_lat", "feed_lng"))
    order = _order(*[F.col(c) for c in ("run_ts", "request_date", "page", "pos")])
    bucket = F.col("request_date").cast("string").alias("bucket")
    return ships.select("*", order.alias("ord"), bucket).drop("run_ts", "request_date", "page", "pos")


def calendar_listing(
    directory_pages: DataFrame,
    calendar_pages: DataFrame,
    dims: Dims,
    as_of: dt.date,
    strict: bool = True,
) -> DataFrame:
    """Ship rows of landed directory and calendar pages.

    Boats are matched on the directory, one row per boat, before they meet the seats.
    """
    boats = _enrich(extract_directory(directory_pages), dims, strict, None)
    newest = newest_page(calendar_pages, ["directory_id", "year", "month"])
    ships = calendar_ships(extract_calendar(newest), boats, as_of)
    none = F.lit(None).cast("timestamp_ntz")
    order = _order(none, F.col("directory_id"), F.col("year") * 12 + F.col("month"), F.col("pos"))
    return ships.select("*", order.alias("ord"), F.col("sdate").alias("bucket")).drop(
        "year", "month", "pos"
    )


def unified_ships(listing: DataFrame, calendar: DataFrame, spine: DataFrame) -> DataFrame:
    """Both sources in one table: requested dates only, first source wins per key."""
    spine_text = spine.select(F.date_format("date", "yyyy-MM-dd").alias("date"))
    wanted = in_window(calendar, spine_text, "bucket")
    merged = merge_sources([(0, listing), (1, wanted)], SHIP_KEY)
    names = [f.name for f in SHIP_ROW if f.name in merged.columns]
    return merged.select(*names, "bucket", "source_rank", "ord")


def listing_query(
    df: DataFrame,
    filters: Filters = Filters(),
    col: str = "fishing_date",
    asc: bool = True,
    page: int = 1,
    size: int = 50,
    ties: list[str] | None = None,
    synonyms: Synonyms | None = None,
    fuzzy: bool = False,
) -> DataFrame:
    """One displayed page: filter, sort, cut, then group headers and seat classes on the page."""
    ties = ["ship_name", "fishing_date", "depart_time", "schedule_no"] if ties is None else ties
    hits = apply_filters(df, filters, synonyms, fuzzy=fuzzy)
    cut = sort_page(hits, col, asc, page, size, ties)
    marked = mark_group_headers(cut, sort_keys(df, col, asc, ties))
    return seat_display(marked)
