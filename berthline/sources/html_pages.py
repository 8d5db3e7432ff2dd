"""Landed HTML: booking calendars and the boat directory."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from berthline import fixed_values as fv
from berthline.operators.dedup import dedup_last
from berthline.functions.numbers import seat_status, strict_int
from berthline.functions.text import page_area, page_store_id, page_title
from berthline.sources.calendar_html import page_cells

_CELL_SCHEMA = (
    "directory_id string, year int, month int, pos int, "
    "day string, num string, fish string, onclick string"
)


# Cells handed back at once; pages come in batches bounded by bytes.
_CELLS_AT_ONCE = 10_000

# Workers need not have this package installed: what runs there is sent by value.
for _module in (__name__, page_cells.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in _CELL_SCHEMA.split(", ")]
    for pages in batches:
        rows: list[tuple] = []
        for p in pages.itertuples(index=False):
            for pos, cell in enumerate(page_cells(p.html or "")):
                rows.append((p.directory_id, p.year, p.month, pos, *cell))
                if len(rows) == _CELLS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)


def calendar_cells(pages: DataFrame) -> DataFrame:
    """Raw cell texts of calendar pages (directory_id, year, month, html).

    Nested markup needs a parser, so this is the one Python step; what follows
    is column expressions.
    """
    narrow = pages.select("directory_id", "year", "month", "html")
    return narrow.mapInPandas(_cells, _CELL_SCHEMA)


def extract_calendar(pages: DataFrame) -> DataFrame:
    """Dated free seats of calendar pages.

    The day must be digits; a bad number counts as 0; a date in the cell's link
    overrides the cell's own date.
    """
    cells = calendar_cells(pages).filter(F.col("day").rlike("^[0-9]+$"))
    own = F.concat_ws(
        "-",
        F.col("year").cast("string"),
        F.lpad(F.col("month").cast("string"), 2, "0"),
        F.format_string("%02d", F.col("day").try_cast("int")),
    )
    digits = F.regexp_extract("onclick", r"date=([0-9]{8})", 1)
    linked = F.regexp_replace(digits, r"^(....)(..)(..)$", "$1-$2-$3")
    rows = cells.select(
        "directory_id",
        "year",
        "month",
        "pos",
        F.when(digits != "", linked).otherwise(own).alias("sdate"),
        strict_int(F.when(F.col("num").rlike(r"^[+-]?[0-9]+$"), F.col("num"))).alias("remain"),
        F.col("fish").alias("fish_str"),
    )
    return rows.withColumn("status", seat_status("remain"))


def directory_ids(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(page_id, pos, directory_id): linked ids of each page in order, without repeats; the first ``limit`` if given."""
    return page_links(pages, fv.ID_LINK_PATTERN, limit).withColumnRenamed("link", "directory_id")


def distinct_links(html: Column | str, pattern: str) -> Column:
    """Distinct matches of a link pattern in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit("(?dU)" + pattern), 1))


def page_links(pages: DataFrame, pattern: str, limit: int | None = None) -> DataFrame:
    """(page_id, pos, link): the distinct links of each page, the first ``limit`` if given."""
    found = distinct_links("html", pattern)
    links = F.slice(found, 1, limit) if limit else found
    return pages.select("page_id", F.posexplode(links).alias("pos", "link"))


def newest_page(pages: DataFrame, keys: list[str], run_ts: str = "run_ts") -> DataFrame:
    """The newest snapshot of each page; as is without run times.

    The newest run per page is found from the narrow columns and joined back, so texts are not
    sorted; a page that one run landed twice stays twice.
    """
    if run_ts not in pages.columns:
        return pages
    newest = pages.groupBy(*keys).agg(F.max(run_ts).alias(run_ts))
    same = [pages[c].eqNullSafe(newest[c]) for c in (*keys, run_ts)]
    return pages.join(newest, reduce(lambda x, y: x & y, same), "left_semi")


def extract_directory(pages: DataFrame) -> DataFrame:
    """(directory_id, store_id, ship_name, area_sub) of boat pages; pages without store id dropped.

    Of a page that landed more than once the newest counts.
    """
    facts = pages.select(
        "directory_id",
        page_store_id("html", "directory_id").alias("store_id"),
        F.coalesce(page_title("html"), F.lit("")).alias("ship_name"),
        F.coalesce(page_area("html"), F.lit("")).alias("area_sub"),
        *[c for c in ("run_ts",) if c in pages.columns],
    )
    if "run_ts" in pages.columns:
        order = ["run_ts", "store_id", "ship_name", "area_sub"]
        facts = dedup_last(facts, ["directory_id"], order).drop("run_ts")
    return facts.filter(F.col("store_id").isNotNull())


def page_titles(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", page_title("html").alias("title"))


