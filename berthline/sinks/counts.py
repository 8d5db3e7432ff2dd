"""Cards and facets kept current from change rows instead of recounted.

Counts are rows (fishing_date, kind, value, n).  What a version of the snapshot table changed is told by
its old and new row images: an old image takes its counts back, a new one adds its own.  Counts per
date are small, so a refresh reads the changed dates of both tables only.  It also follows a rollback.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from berthline import fixed_values as fv
from berthline.functions.numbers import open_seats
from berthline.functions.text import canonical_status, split_species
from berthline.schemas import NATURAL_KEY
from berthline.sinks.tables import PARTITION, seats
from berthline.sinks.versions import VersionedTable

MEASURES = ["ships", "avail", "full", "seats", "with_seats"]
COUNTS = T.StructType([
    T.StructField(PARTITION, T.DateType()), T.StructField("kind", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("n", T.LongType()),
])


def _counted() -> Column:
    """What one row counts for, as (kind, value, n): the cards' measures, its species and its area."""
    free, status = open_seats("remain_seats"), canonical_status("status_code")
    one = lambda test: F.coalesce(test, F.lit(False)).cast("bigint")
    numbers = [F.lit(1), one(status == fv.STATUS_OPEN), one(status == fv.STATUS_SOLD_OUT), F.coalesce(free, F.lit(0)), one(free > 0)]
    none = F.lit(None).cast("string")
    entry = lambda kind, value, n: F.struct(F.lit(kind).alias("kind"), value.alias("value"), n.cast("bigint").alias("n"))
    measures = F.array(*[entry(kind, none, n) for kind, n in zip(MEASURES, numbers)], entry("area", F.col("area_name"), F.lit(1)))
    species = F.transform(F.coalesce(F.array_distinct(split_species("fish_types")), F.array().cast("array<string>")), lambda s: entry("species", s, F.lit(1)))
    return F.filter(F.concat(measures, species), lambda e: e["n"] != 0)


def count_deltas(changes: DataFrame) -> DataFrame:
    """Counts that change rows (old, new) bring and take back."""
    sides = [changes.filter(F.col(c).isNotNull()).select(f"{c}.*", F.lit(sign).alias("sign")) for c, sign in (("old", -1), ("new", 1))]
    each = reduce(DataFrame.unionByName, sides).select(PARTITION, "sign", F.explode(_counted()).alias("e"))
    sums = each.groupBy(PARTITION, "e.kind", "e.value").agg(F.sum(F.col("sign") * F.col("e.n")).alias("n"))
    return sums.select(*COUNTS.fieldNames()).filter("n <> 0")


def counts_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, COUNTS, PARTITION)


def refresh_counts(spark: SparkSession, table: str, counts: str, keys: list[str] | None = None) -> int:
    """Bring the counts at ``counts`` up to the newest version of the snapshot table; the version of the counts.

    The pointer of the counts tells which version of the table they are of, so a run that
    stopped before, several versions at once and a rollback are caught up the same way.
    """
    source, kept = seats(spark, table), counts_table(spark, counts)
    base, now = kept.pointer(), source.pointer().version
    since = base.notes.get("of", 0)
    if since == now:
        return base.version
    moved = source.moved(since, now)
    deltas = count_deltas(source.changes(NATURAL_KEY if keys is None else keys, since, now))
    state = kept.read(base.version, moved).unionByName(deltas).groupBy(PARTITION, "kind", "value").agg(F.sum("n").alias("n"))
    batch = kept.write(state.filter("n <> 0"))
    return kept.publish(batch, base.version, moved, of=now)


def kept_cards(counts: DataFrame) -> DataFrame:
    """The summary cards from counts; the missing date is one of the dates."""
    totals = [F.coalesce(F.sum(F.when(F.col("kind") == m, F.col("n"))), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    dated = F.when(F.col("kind") == "ships", F.coalesce(F.col(PARTITION).cast("string"), F.lit("")))
    return counts.agg(*totals, F.count_distinct(dated).alias("dates"))


def kept_facet(counts: DataFrame, kind: str) -> DataFrame:
    """(value, n): the values of a facet and their rows."""
    return counts.filter(F.col("kind") == kind).groupBy("value").agg(F.sum("n").alias("n"))


def kept_dates(counts: DataFrame) -> DataFrame:
    """(fishing_date, n): the dates that have rows, and how many."""
    return counts.filter((F.col("kind") == "ships") & F.col(PARTITION).isNotNull()).select(PARTITION, "n")
