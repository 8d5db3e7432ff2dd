"""One row per key: the last or the first in a given order, within one shuffle.

Spark has no row order, so every caller names the columns that define it.  Both
forms filter ``row_number() = 1``; Spark then cuts each key to one row per task
before the shuffle (WindowGroupLimit), so a hot key costs no more than one row
per map task.  Null keys form a group of their own, as in SQL ``GROUP BY``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

_RN = "__rn"


def _order(ord: str | list[str]) -> list[str]:
    return [ord] if isinstance(ord, str) else list(ord)


def _pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_last(df: DataFrame, keys: list[str], ord: str | list[str]) -> DataFrame:
    """Last row of each key."""
    return _pick(df, keys, [F.col(c).desc() for c in _order(ord)])


def dedup_first(df: DataFrame, keys: list[str], ord: str | list[str]) -> DataFrame:
    """First row of each key."""
    return _pick(df, keys, [F.col(c).asc() for c in _order(ord)])


def merge_sources(
    sources: list[tuple[int, DataFrame]], keys: list[str], ord: str | list[str] = "ord"
) -> DataFrame:
    """Union of sources with different fields; a key seen in an earlier source wins."""
    ranked = [df.withColumn("source_rank", F.lit(rank)) for rank, df in sources]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    return dedup_first(union, keys, ["source_rank", *_order(ord)])


def drop_seen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``seen``; null keys are equal to null keys."""
    known = seen.select(*keys).distinct()
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(known[k]) for k in keys])
    return df.join(known, same, "left_anti")


def dedup_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows_in, rows_out, removed.

    Counted per key first, so that the work spreads over the keys and a hot key
    combines on the map side; only per-task totals meet in one place.
    """
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.count("*").alias("rows_out"),
    )
    return totals.withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: the check to run before a join expected to be 1:1."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.filter(F.col("rows") > 1)
