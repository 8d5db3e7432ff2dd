"""Counts and shares of listings, and calendar operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from berthline.functions.text import split_species


# Groups that a share's names are dealt over before their k best meet.
SHARE_PARTS = 64


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from start to end, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def days_ahead(spark: SparkSession, start: dt.date, n: int = 14) -> DataFrame:
    return date_spine(spark, start, start + dt.timedelta(days=n - 1))


def spine_months(spine: DataFrame) -> DataFrame:
    months = spine.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct()
    return months.orderBy("year", "month")


def in_window(df: DataFrame, spine: DataFrame, col: str = "fishing_date") -> DataFrame:
    """Rows whose date is one of the requested dates."""
    return df.join(spine.withColumnRenamed("date", col), col, "left_semi")


def coverage_gaps(df: DataFrame, spine: DataFrame, col: str = "fishing_date") -> DataFrame:
    """Requested dates without any row."""
    seen = df.select(F.col(col).alias("date")).distinct()
    return spine.join(seen, "date", "left_anti")


def daily_doc_counts(
    df: DataFrame, date: str = "fishing_date", boat: str = "boat_id"
) -> DataFrame:
    """Rows per date, and those with a boat."""
    counts = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("date"))
    return counts.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce(F.col(boat), F.lit(0)) != 0).alias("af_matched"),
    )


def source_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("rows"))


def chunk_running(
    df: DataFrame, start: dt.date, days: int = 30, col: str = "fishing_date"
) -> DataFrame:
    """Rows per chunk of days since ``start`` with the running total.

    The running total is over one row per chunk, of which a calendar has few.
    """
    chunk = F.floor(F.datediff(F.col(col), F.lit(start)) / F.lit(days)).alias("chunk")
    rows = df.filter(F.col(col) >= F.lit(start)).groupBy(chunk).agg(F.count("*").alias("rows"))
    window = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("running", F.sum("rows").over(window))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    present = df.filter(F.col(col).isNotNull())
    return present.groupBy(F.col(col).alias("name")).agg(F.count("*").alias("rows"))


def species_counts(df: DataFrame, col: str = "fish_types") -> DataFrame:
    """Rows per species of a comma list; equal lists are counted before they are taken apart."""
    lists = df.groupBy(col).agg(F.count("*").alias("n"))
    each = lists.select(F.explode(split_species(col)).alias("name"), "n")
    return each.groupBy("name").agg(F.sum("n").alias("rows"))


def share_top_k(counts: DataFrame, k: int = 5, other: str = "other") -> DataFrame:
    """Share in percent of the k most frequent names (ties by name) and of all others.

    The counts are read once: names are dealt over ``SHARE_PARTS`` groups, each gives its total and
    its k best, and one row is made of those few.
    """
    by_rank = F.struct((-F.col("rows")).alias("rank"), "name")
    part = F.pmod(F.xxhash64("name"), F.lit(SHARE_PARTS)).alias("part")
    ranked = counts.select(part, "rows", by_rank.alias("entry"))
    window = Window.partitionBy("part").orderBy("entry")
    own = Window.partitionBy("part")
    parts = ranked.withColumns(
        {"place": F.row_number().over(window), "all": F.sum("rows").over(own)}
    ).filter(F.col("place") <= k)
    once = F.sum(F.when(F.col("place") == 1, F.col("all")))
    best = parts.agg(
        F.slice(F.sort_array(F.collect_list("entry")), 1, k).alias("top"),
        F.coalesce(once, F.lit(0)).alias("total"),
    )
    shown = F.transform(
        "top",
        lambda e: F.struct(
            e["name"].alias("name"), (-e["rank"]).alias("rows"), F.lit(False).alias("is_other")
        ),
    )
    rest = F.col("total") - F.aggregate("top", F.lit(0).cast("bigint"), lambda s, e: s - e["rank"])
    last = F.array(F.struct(F.lit(other).alias("name"), rest.alias("rows"), F.lit(True).alias("is_other")))
    shares = best.select("total", F.explode(F.concat(shown, F.when(rest > 0, last).otherwise(F.slice(last, 1, 0)))).alias("s"))
    pct = F.round(F.col("rows").cast("decimal(20,0)") * 100 / F.col("total").cast("decimal(20,0)"), 1)
    return shares.select("s.*", "total").withColumn("pct", pct.cast("double")).drop("total")
