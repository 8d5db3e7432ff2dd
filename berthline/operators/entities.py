"""Matching listings to known boats, coordinates and areas.

Containment ("one text is part of the other") is a join on the rarest piece of the contained text, see
``containment``; its keys grow with the length of the names, not with its square.  All four kinds of
it, of names and of areas either way, go through one such join.  Listings are only
read for their distinct (name, area) pairs, and once more for the rows that get the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from berthline import fixed_values as fv
from berthline.dims import area_table
from berthline.functions.text import _col
from berthline.operators.containment import contained
from berthline.session import joinable, stored

EXACT, AREA_PART, UNIQUE_NAME, NAME_PART = 1, 2, 3, 4
# Whose text is part of the other's: the map's or the listing's, of names or of areas below one name.
_NAME_IN, _NAME_OF, _AREA_IN, _AREA_OF = "n<", "n>", "a<", "a>"


def substrings(text: Column | str, lengths: Column | str | None = None) -> Column:
    """Distinct non-empty substrings of a text, of all lengths or of the listed ones."""
    c = _col(text)
    n = F.length(c)
    sizes = F.sequence(F.lit(1), n) if lengths is None else _col(lengths)

    def starting_at(i: Column) -> Column:
        fitting = F.filter(sizes, lambda size: size + i - 1 <= n)
        return F.transform(fitting, lambda size: F.substring(c, i, size))

    nested = F.transform(F.sequence(F.lit(1), n), starting_at)
    none = F.array().cast("array<string>")
    return F.when(n > 0, F.array_distinct(F.flatten(nested))).otherwise(none)


def _lengths(df: DataFrame, *columns: str) -> Column:
    """Scalar struct: the distinct lengths of columns' texts but 0 (no more than their longest text)."""
    sets = [F.collect_set(F.nullif(F.length(c), F.lit(0))).alias(c) for c in columns]
    return df.agg(F.struct(*sets).alias("lengths")).scalar()


Keep = Callable[[DataFrame, str], DataFrame]


def _hit(stage: int) -> Column:
    return F.struct(F.lit(stage).alias("stage"), "ord", "boat_id")


def _either_way(own: DataFrame, listed: DataFrame, by: Column, name: str, inner: str, outer: str) -> tuple[DataFrame, DataFrame]:
    """The two sides of containment: the map's texts in the listing's (`inner`) and the other way round (`outer`).

    `own` are the map's (by, text, hit), `listed` the listing's texts of column `name` below `by`.
    """
    none = F.lit(None).cast(own.schema["hit"].dataType)

    def side(kind: str, as_: str, of_map: bool) -> DataFrame:
        df, key, text, hit = (own, F.col("by"), "text", F.col("hit")) if of_map else (listed, by, name, none)
        return df.select(F.lit(kind).alias("kind"), key.alias("by"), F.col(text).alias(as_), hit.alias(f"{as_}_hit"))

    parts = side(inner, "part", True).unionByName(side(outer, "part", False))
    return parts, side(inner, "whole", False).unionByName(side(outer, "whole", True))


def resolve_pairs(pairs: DataFrame, entities: DataFrame, strict: bool = True, keep: Keep = lambda df, label: df) -> DataFrame:
    """Boat id and stage of distinct (ship_name, area_sub) pairs; pairs without a match are absent.

    Stages: exact name and area; same name and one area part of the other; name
    that the map lists once; such a name part of the other name.  Within a
    stage the map's order decides.  ``strict=False`` also lets an empty area or
    name count as part of everything.  ``keep`` may store what several later steps read.
    """
    named = entities.groupBy("name").agg(F.count("*").alias("entries"), F.min("ord").alias("ord"), F.min("boat_id").alias("boat_id"))
    named = keep(named, "names")
    once, ship = named.filter("entries = 1"), F.col("ship_name")
    listed = pairs.select("ship_name").distinct()
    by_name = _either_way(once.select(F.lit("").alias("by"), F.col("name").alias("text"), _hit(NAME_PART).alias("hit")), listed, F.lit(""), "ship_name", _NAME_IN, _NAME_OF)
    # Areas matter only below names that the map has.
    known = pairs.join(named.select(F.col("name").alias("ship_name")), "ship_name", "left_semi")
    by_area = _either_way(entities.select(F.col("name").alias("by"), F.col("area").alias("text"), _hit(AREA_PART).alias("hit")), known, ship, "area_sub", _AREA_IN, _AREA_OF)
    parts, wholes = (a.unionByName(b) for a, b in zip(by_name, by_area))
    found = contained(parts, keep(wholes, "wholes"), ["kind", "by"], empty=not strict)
    own = F.when(F.col("kind").isin(_NAME_IN, _AREA_IN), F.col("whole")).otherwise(F.col("part"))
    met = found.select(F.col("kind").isin(_NAME_IN, _NAME_OF).alias("of_name"), "by", own.alias("own"), F.coalesce("part_hit", "whole_hit").alias("hit"))
    least = F.min("hit").alias("hit")
    best = keep(met.groupBy("of_name", "by", "own").agg(least), "contained")
    unique = once.select(F.col("name").alias("ship_name"), _hit(UNIQUE_NAME).alias("hit"))
    names = best.filter("of_name").select(F.col("own").alias("ship_name"), "hit").unionByName(unique).groupBy("ship_name").agg(least)
    exact = entities.select(F.col("name").alias("ship_name"), F.col("area").alias("area_sub"), _hit(EXACT).alias("hit"))
    areas = best.filter("not of_name").select(F.col("by").alias("ship_name"), F.col("own").alias("area_sub"), "hit")
    areas = areas.unionByName(exact).groupBy("ship_name", "area_sub").agg(least)
    # Both are as many as the matches; Spark would judge them by compressed files, and broadcast too many.
    areas, names = areas.hint("merge"), names.hint("merge")
    # A pair's best hit by name and area, and by name alone.
    met = pairs.join(areas, ["ship_name", "area_sub"], "left").join(names.withColumnRenamed("hit", "name_hit"), "ship_name", "left")
    chosen = met.select("ship_name", "area_sub", F.least("hit", "name_hit").alias("hit")).filter("hit is not null")
    return chosen.select(
        "ship_name",
        "area_sub",
        F.col("hit.boat_id").alias("boat_id"),
        F.col("hit.stage").alias("stage"),
    )


def _resolved(pairs: DataFrame, entities: DataFrame, strict: bool, coords: DataFrame | None, scratch: str | None) -> DataFrame:
    """The pairs' boats; with ``scratch`` pairs, map and result are tables there, so that nothing before them runs twice."""

    def kept(df: DataFrame, label: str) -> DataFrame:
        return stored(df, f"{scratch}/{label}-{uuid.uuid4().hex}") if scratch else df

    resolved = resolve_pairs(kept(pairs, "pairs"), kept(entities, "map"), strict, kept).withColumnRenamed("stage", "match_stage")
    if coords is not None:
        resolved = resolved.join(_known(coords), "boat_id", "left")
    if not scratch:
        return resolved
    path = f"{scratch}/resolved-{uuid.uuid4().hex}"
    return joinable(stored(resolved, path), path)


def resolve_entities(
    df: DataFrame,
    entities: DataFrame,
    strict: bool = True,
    coords: DataFrame | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``boat_id`` and ``match_stage`` to listings; both null where nothing matches.

    Only the distinct pairs are resolved.  The rows then join one row per pair:
    a hot boat is split by AQE's skew join, since its build row can be copied.
    With ``coords`` the boat's coordinates come along as the struct ``known``;
    they are looked up per pair too, so unmatched rows never meet on a null key.
    With ``scratch``, a folder that executors share, pairs and result are stored below it: the
    listing is read twice, and the join knows the pairs' real size and leaves the rows unshuffled while they are small.
    """
    pairs = df.select("ship_name", "area_sub").distinct()
    resolved = _resolved(pairs, entities, strict, coords, scratch)
    return df.join(resolved, ["ship_name", "area_sub"], "left")


def matched_per_date(
    df: DataFrame, entities: DataFrame, date: str = "fishing_date", strict: bool = True, scratch: str | None = None
) -> DataFrame:
    """(date, total, af_matched): listings per date and those with a boat, without joining the listings.

    Listings are counted per date and pair first; the counts meet the resolved pairs.  With ``scratch`` the counts are stored
    there, so the listing is read once.
    """
    counts = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("date"), "ship_name", "area_sub")
    counts = counts.agg(F.count("*").alias("n"))
    if scratch:
        counts = stored(counts, f"{scratch}/counts-{uuid.uuid4().hex}")
    pairs = counts.select("ship_name", "area_sub").distinct()
    found = _resolved(pairs, entities, strict, None, scratch).select("ship_name", "area_sub", "boat_id")
    joined = counts.join(found, ["ship_name", "area_sub"], "left")
    matched = F.sum(F.when(F.coalesce("boat_id", F.lit(0)) != 0, F.col("n")).otherwise(0))
    return joined.groupBy("date").agg(F.sum("n").alias("total"), matched.alias("af_matched"))


def resolve_exact(df: DataFrame, entities: DataFrame) -> DataFrame:
    """Stage 1 alone: listings whose name and area are both in the map."""
    keyed = entities.groupBy(F.col("name").alias("ship_name"), F.col("area").alias("area_sub")).agg(
        F.min_by("boat_id", "ord").alias("boat_id")
    )
    return df.join(keyed, ["ship_name", "area_sub"], "inner")


def _known(coords: DataFrame) -> DataFrame:
    return coords.select("boat_id", F.struct("lat", "lng").alias("known"))


def choose_coordinates(df: DataFrame, feed: tuple[str, str] | None) -> DataFrame:
    """lat, lng: both from ``known`` if it is set, else both from the feed."""

    def pick(axis: str, feed_col: str | None) -> Column:
        fallback = F.col(feed_col) if feed_col else F.lit(None).cast("double")
        return F.when(F.col("known").isNotNull(), F.col("known")[axis]).otherwise(fallback)

    lat_col, lng_col = feed or (None, None)
    both = {"lat": pick("lat", lat_col), "lng": pick("lng", lng_col)}
    return df.withColumns(both).drop("known", *(feed or ()))


def apply_coordinates(
    df: DataFrame, coords: DataFrame, feed: tuple[str, str] | None = ("feed_lat", "feed_lng")
) -> DataFrame:
    """Add lat, lng of the row's boat, the feed's own where the boat has no entry."""
    return choose_coordinates(df.join(_known(coords), "boat_id", "left"), feed)


def lookup_area(
    df: DataFrame,
    areas: list[tuple[str, str]] | DataFrame | None = None,
    default: str = fv.OTHER_AREA,
    feed: str | None = "area_main",
) -> DataFrame:
    """Set ``area_main``: the feed's own value, else the first contained sub-area, else the default.

    Areas are a table (ord, sub, main) or a list (default: the built-in one), matched by
    equality with the substrings of the distinct areas.
    """
    own = F.nullif(F.col(feed), F.lit("")) if feed and feed in df.columns else F.lit(None)
    if not isinstance(areas, DataFrame):
        areas = area_table(df.sparkSession, areas)
    distinct = df.select("area_sub").distinct().withColumn("lengths", _lengths(areas, "sub"))
    first = areas.groupBy("sub").agg(F.min(F.struct("ord", "main")).alias("entry"))
    probes = distinct.select("area_sub", F.explode(substrings("area_sub", "lengths.sub")).alias("sub"))
    found = (
        probes.join(first, "sub")
        .groupBy("area_sub")
        .agg(F.min("entry").alias("entry"))
        .select("area_sub", F.col("entry.main").alias("found"))
    )
    joined = df.join(found, "area_sub", "left")
    return joined.withColumn("area_main", F.coalesce(own, F.col("found"), F.lit(default))).drop(
        "found"
    )


def entity_report(df: DataFrame) -> DataFrame:
    """Rows per ship and whether it has a boat."""
    return df.groupBy("ship_name", "area_sub").agg(
        F.count("*").alias("rows"),
        F.max("boat_id").alias("boat_id"),
        F.max(F.col("boat_id").isNotNull()).alias("mapped"),
    )
