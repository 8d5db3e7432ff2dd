"""Filtering, searching, facets, summary, sorting and paging of the seat listing."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from berthline import fixed_values as fv
from berthline.functions.dates import iso_date
from berthline.functions.numbers import fill_percent, open_seats, seat_class
from berthline.functions.text import canonical_status, expand_synonyms, split_species

SEARCH_COLUMNS = ("ship_name", "fish_types", "area_name", "port_name")
SORT_COLUMNS = (
    "ship_name",
    "area_name",
    "fishing_date",
    "total_seats",
    "reserved_seats",
    "remain_seats",
)
Synonyms = list[tuple[str, list[str]]]


@dataclass(frozen=True)
class Filters:
    """Optional filters; those given are ANDed."""

    query: str | None = None
    name: str | None = None
    species: str | None = None
    date: dt.date | None = None
    status: str | None = None
    seats_only: bool = False


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def search_text(cols: tuple[str, ...] = SEARCH_COLUMNS) -> Column:
    """What a search looks at: the columns in lower case, joined by spaces."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in cols]))


def text_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"[\s,]+"), lambda t: t != "")


def words_text_condition(text: Column, query: str, synonyms: Synonyms | None = None) -> Column:
    """Every word occurs, itself or as one of its synonyms, somewhere in a search text."""
    return _all(
        [
            _any([text.contains(s.lower()) for s in expand_synonyms(word, synonyms)])
            for word in query.split()
        ]
    )


def words_condition(
    query: str, synonyms: Synonyms | None = None, cols: tuple[str, ...] = SEARCH_COLUMNS
) -> Column:
    """Every word occurs, itself or as one of its synonyms, somewhere in the columns."""
    return words_text_condition(search_text(cols), query, synonyms)


def search_words(
    df: DataFrame,
    query: str,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
) -> DataFrame:
    return df.filter(words_condition(query, synonyms, cols))


def fuzzy_text_condition(
    text: Column,
    query: str,
    synonyms: Synonyms | None = None,
    tolerance: float = fv.FUZZY_TOLERANCE,
) -> Column:
    """As ``words_text_condition``, a token within floor(tolerance * length) edits also counts.

    A plain row filter: query terms are few, so no shuffle of tokens is needed.
    """

    def near(term: str) -> Column:
        limit = math.floor(tolerance * len(term))
        exact = text.contains(term)
        if not limit:
            return exact
        return exact | F.exists(
            text_tokens(text), lambda t: F.levenshtein(t, F.lit(term), limit) >= F.lit(0)
        )

    return _all(
        [
            _any([near(s.lower()) for s in expand_synonyms(word, synonyms)])
            for word in query.split()
        ]
    )


def fuzzy_condition(
    query: str,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
    tolerance: float = fv.FUZZY_TOLERANCE,
) -> Column:
    """As ``words_condition``, a token within floor(tolerance * length) edits also counts."""
    return fuzzy_text_condition(search_text(cols), query, synonyms, tolerance)


def fuzzy_search(
    df: DataFrame,
    query: str,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
    tolerance: float = fv.FUZZY_TOLERANCE,
) -> DataFrame:
    return df.filter(fuzzy_condition(query, synonyms, cols, tolerance))


def species_condition(species: str, synonyms: Synonyms | None = None) -> Column:
    terms = expand_synonyms(species, synonyms)

    def either_way(t: Column) -> Column:
        return _any([t.contains(term) | F.lit(term).contains(t) for term in terms])

    return F.exists(split_species("fish_types"), either_way)


def filter_condition(
    filters: Filters,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
    fuzzy: bool = False,
) -> Column:
    """All given filters as one predicate, never null."""
    parts: list[Column] = []
    if filters.query and filters.query.strip():
        parts.append((fuzzy_condition if fuzzy else words_condition)(filters.query, synonyms, cols))
    if filters.name:
        parts.append(F.lower("ship_name").contains(filters.name.lower()))
    if filters.species:
        parts.append(species_condition(filters.species, synonyms))
    if filters.date:
        parts.append(F.col("fishing_date") == F.lit(filters.date))
    if filters.status:
        wanted = fv.STATUS_SOLD_OUT if filters.status == fv.STATUS_FULL else filters.status
        parts.append(canonical_status("status_code") == wanted)
    if filters.seats_only:
        parts.append(open_seats("remain_seats") > 0)
    return _all(parts)


def apply_filters(
    df: DataFrame,
    filters: Filters,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
    fuzzy: bool = False,
) -> DataFrame:
    return df.filter(filter_condition(filters, synonyms, cols, fuzzy))


def filter_counts(
    df: DataFrame,
    filters: Filters,
    synonyms: Synonyms | None = None,
    cols: tuple[str, ...] = SEARCH_COLUMNS,
) -> DataFrame:
    """shown and total, in one pass."""
    return df.agg(
        F.count_if(filter_condition(filters, synonyms, cols)).alias("shown"),
        F.count("*").alias("total"),
    )


def future_only(df: DataFrame, as_of: dt.date, col: str = "sdate") -> DataFrame:
    """Rows whose date is valid and not before ``as_of``."""
    date = F.col(col) if isinstance(df.schema[col].dataType, T.DateType) else iso_date(col)
    return df.filter(date >= F.lit(as_of))


def summary_cards(df: DataFrame) -> DataFrame:
    """Rows, open, sold out, seats, dates and rows with seats.

    Aggregated per date first: the number of groups is the number of distinct
    dates, the missing date being one of them.
    """
    seats, status = open_seats("remain_seats"), canonical_status("status_code")
    per_date = df.groupBy("fishing_date").agg(
        F.count("*").alias("ships"),
        F.count_if(status == fv.STATUS_OPEN).alias("avail"),
        F.count_if(status == fv.STATUS_SOLD_OUT).alias("full"),
        F.sum(seats).alias("seats"),
        F.count_if(seats > 0).alias("with_seats"),
    )
    measures = ["ships", "avail", "full", "seats", "with_seats"]
    return per_date.agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures],
        F.count("*").alias("dates"),
    )


def facet_dates(df: DataFrame) -> DataFrame:
    dates = df.select("fishing_date").filter(F.col("fishing_date").isNotNull()).distinct()
    return dates.orderBy("fishing_date")


def facet_species(df: DataFrame, collation: str = "ko") -> DataFrame:
    """Distinct species, taken apart only after the lists themselves are distinct."""
    lists = df.select("fish_types").distinct()
    species = lists.select(F.explode(split_species("fish_types")).alias("species")).distinct()
    return species.orderBy(F.collate("species", collation), "species")


def _sort_key(df: DataFrame, col: str, asc: bool, collation: str) -> Column:
    key = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        key = F.collate(F.coalesce(key, F.lit("")), collation)
    return key.asc_nulls_first() if asc else key.desc_nulls_last()


def sort_keys(
    df: DataFrame, col: str, asc: bool, ties: list[str], collation: str = "ko"
) -> list[Column]:
    return [_sort_key(df, col, asc, collation), *[F.col(t).asc_nulls_first() for t in ties]]


def sort_page(
    df: DataFrame,
    col: str = "fishing_date",
    asc: bool = True,
    page: int = 1,
    size: int = fv.LIST_PAGE_ROWS,
    ties: list[str] | None = None,
    collation: str = "ko",
) -> DataFrame:
    """One page of the sorted listing; beyond the last page it is empty.

    Plans as a top-k: no task and not the driver ever holds more than
    page * size rows.  ``page_after`` does not grow with the page number.
    """
    if col not in SORT_COLUMNS:
        raise ValueError(f"sort by one of {', '.join(SORT_COLUMNS)}")
    if page < 1:
        return df.limit(0)
    ties = ["ship_name", "fishing_date", "depart_time", "schedule_no"] if ties is None else ties
    ordered = df.orderBy(*sort_keys(df, col, asc, ties, collation))
    return ordered.offset((page - 1) * size).limit(size)


def page_after(
    df: DataFrame,
    after: dict[str, object],
    col: str = "fishing_date",
    asc: bool = True,
    size: int = fv.LIST_PAGE_ROWS,
    ties: list[str] | None = None,
    collation: str = "ko",
) -> DataFrame:
    """The page that follows the row with the given (non-null) sort and tie values."""
    ties = ["ship_name", "fishing_date", "depart_time", "schedule_no"] if ties is None else ties
    text = isinstance(df.schema[col].dataType, T.StringType)
    key, last = F.col(col), F.lit(after[col])
    if text:
        key, last = F.collate(key, collation), F.collate(last, collation)
    beyond = key > last if asc else key < last
    same = key == last
    for tie in ties:
        beyond = beyond | (same & (F.col(tie) > F.lit(after[tie])))
        same = same & (F.col(tie) == F.lit(after[tie]))
    return df.filter(beyond).orderBy(*sort_keys(df, col, asc, ties, collation)).limit(size)


def page_count(df: DataFrame, size: int = fv.LIST_PAGE_ROWS) -> DataFrame:
    return df.agg(F.ceil(F.count("*") / F.lit(size)).alias("pages"))


def mark_group_headers(
    page: DataFrame, order: list[Column], col: str = "fishing_date"
) -> DataFrame:
    """Mark rows of one page whose value differs from the row before; the first row is marked
    unless it is null."""
    previous = F.lag(F.col(col).cast("string"), 1, "").over(Window.orderBy(*order))
    value = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return page.withColumn("group_header", value != F.coalesce(previous, F.lit("")))


def seat_display(df: DataFrame, strict: bool = False) -> DataFrame:
    """Seat class and fill percentage of each row."""
    return df.withColumns(
        {
            "seat_class": seat_class("remain_seats", "total_seats", strict),
            "fill_pct": fill_percent("remain_seats", "total_seats", strict),
        }
    )
