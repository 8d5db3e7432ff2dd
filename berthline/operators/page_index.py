"""Deep pages of a sorted listing: a stored order and how many rows lie before each range of it.

The listing is stored once per order, cut into ranges whose boundaries Spark takes from a sample, each a folder.  How many rows
a range really has is counted exactly.  Page n then lies in one or two known ranges: only those are
read, sorted and cut, however deep the page is.  The directory has one entry per range, not per row.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from berthline import fixed_values as fv
from berthline.operators.listing import SORT_COLUMNS, sort_keys
from berthline.session import read_small, write_new

RANGE_ROWS = 100_000
RANGES = 10_000
TIES = ("ship_name", "fishing_date", "depart_time", "schedule_no")


class PageIndex:
    """One order of a listing below `path`; `build` stores it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        told = json.loads(read_small(spark, f"{self.path}/order.json"))
        self.order, self.counts = told["order"], told["counts"]
        self.schema = T.StructType.fromJson(told["schema"])
        # Rows before each range, and in all.
        self.before = [0, *accumulate(n for _, n in self.counts)]

    @classmethod
    def build(
        cls,
        df: DataFrame,
        path: str,
        col: str = "fishing_date",
        asc: bool = True,
        ties: list[str] | None = None,
        collation: str = "ko",
        range_rows: int = RANGE_ROWS,
    ) -> PageIndex:
        """Store `df` in the order that ``sort_page`` gives; a column of `df` must not be named range_no."""
        if col not in SORT_COLUMNS:
            raise ValueError(f"sort by one of {', '.join(SORT_COLUMNS)}")
        spark, ties = df.sparkSession, list(TIES if ties is None else ties)
        keys = sort_keys(df, col, asc, ties, collation)
        ranges = max(1, min(RANGES, -(-df.count() // range_rows)))
        ranged = df.repartitionByRange(ranges, *keys).withColumn("range_no", F.spark_partition_id())
        ranged.sortWithinPartitions("range_no", *keys).write.mode("overwrite").partitionBy("range_no").parquet(f"{path}/rows")
        schema = T.StructType([*df.schema.fields, T.StructField("range_no", T.IntegerType())])
        sizes = spark.read.schema(schema).parquet(f"{path}/rows").groupBy("range_no").agg(F.count("*").alias("n"))
        counts = sorted((r.range_no, r.n) for r in sizes.collect())
        told = {"order": {"col": col, "asc": asc, "ties": ties, "collation": collation}, "counts": counts, "schema": schema.jsonValue()}
        write_new(spark, f"{path}/order.json", json.dumps(told))
        return cls(spark, path)

    @property
    def rows(self) -> int:
        return self.before[-1]

    def page_count(self, size: int = fv.LIST_PAGE_ROWS) -> int:
        return -(-self.rows // size)

    def page(self, page: int = 1, size: int = fv.LIST_PAGE_ROWS) -> DataFrame:
        """As ``sort_page``: one page in order, empty beyond the last one."""
        first, columns = (page - 1) * size, [c for c in self.schema.fieldNames() if c != "range_no"]
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        if page < 1 or first >= self.rows:
            return stored.select(*columns).limit(0)
        low = bisect_right(self.before, first) - 1
        high = bisect_right(self.before, min(first + size, self.rows) - 1) - 1
        lying_in = stored.filter(F.col("range_no").isin([no for no, _ in self.counts[low : high + 1]]))
        ordered = lying_in.orderBy(*sort_keys(stored, **self.order))
        return ordered.select(*columns).offset(first - self.before[low]).limit(size)
