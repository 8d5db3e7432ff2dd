"""A write order that serves filters on several columns at once.

Each column is cut into ranges of values, and a row's place is the interleaved bits of its ranges' numbers (Morton order):
rows that are near in all the columns lie together, so the least and greatest value that Parquet keeps for each
row group and page are close, and a filter on any of the columns skips most of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 4
# Different values that the ranges of a column are taken from.
SAMPLE = 10_000


def boundaries(df: DataFrame, column: str, bits: int = BITS) -> list:
    """Values that cut a column's different values into up to 2**bits ranges, from a bounded sample: the least by hash."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    sample = sorted(r[0] for r in values.orderBy(F.xxhash64(column), column).limit(SAMPLE).collect())
    ranges = min(1 << bits, len(sample))
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)]


def interleaved(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """A row's place in Morton order of the columns; nulls lie in the first range."""
    numbers = []
    for column in columns:
        kind = df.schema[column].dataType
        cuts = [F.when(F.col(column) >= F.lit(cut).cast(kind), 1).otherwise(0) for cut in boundaries(df, column, bits)]
        numbers.append(sum(cuts, F.lit(0)))
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for i, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return place
