"""Shards of bounded size by extendible hashing.

Every row has an address: bits of its key's hash, then bits of a hash of its spread columns, so rows
of a key stay close and a hot key splits further.  The directory is indexed by address prefixes:
it starts as one bucket, and only a bucket over the byte limit is split on its next bit.

The splits are found level by level from sums: documents are reduced to (address, bytes) once,
and each round sums prefixes `STRIDE` bits longer within the buckets that are still too large
(partial sums in every task), so no bucket is ever gathered.  A bucket whose rows share
all bits can't be split by hashing; its rows are dealt to pages that fit, numbered within the tasks
that read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from berthline.llm.base import keep

KEY_BITS = 16
SPREAD_BITS = 32
BITS = KEY_BITS + SPREAD_BITS
FIRST_STRIDE = 16
STRIDE = 8
# Directory rows that may be broadcast; a larger directory is joined by a shuffle.
BROADCAST_ROWS = 500_000


def _hash_bits(columns: list[str], bits: int) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("long")


def address(key: list[str], spread: list[str]) -> Column:
    return F.shiftleft(_hash_bits(key, KEY_BITS), SPREAD_BITS).bitwiseOR(_hash_bits(spread, SPREAD_BITS))


def prefix(code: Column, depth: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", code, (F.lit(BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """For each round its cell depth and the table (cell, depth, shard_bytes, shard_rows, large) of buckets that cells lie in.

    `rows` has address and n_bytes.  Cells marked large are split by the next round.
    """
    rounds: list[tuple[int, DataFrame]] = []
    top, left = 0, rows
    while True:
        bottom = min(BITS, top + (STRIDE if rounds else FIRST_STRIDE))
        cells = left.groupBy(prefix(F.col("address"), bottom).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        cells = keep(cells, "cells")
        depth = F.explode(F.sequence(F.lit(top + bool(rounds)), F.lit(bottom)))
        every = cells.select("cell", "bytes", "rows", depth.alias("depth"))
        node = F.call_function("shiftrightunsigned", F.col("cell"), (F.lit(bottom) - F.col("depth")).cast("int"))
        every = every.withColumn("node", node)
        sums = every.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        fits = sums.filter((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS))
        found = every.join(fits, ["depth", "node"]).groupBy("cell").agg(F.min(F.struct("depth", "shard_bytes", "shard_rows")).alias("leaf"))
        known = cells.select("cell").join(found, "cell", "left").select("cell", "leaf.*", F.col("leaf").isNull().alias("large"))
        known = keep(known, "directory")
        rounds.append((bottom, known))
        large = known.filter("large").select("cell")
        if bottom == BITS or large.isEmpty():
            return rounds
        left = left.withColumn("cell", prefix(F.col("address"), bottom)).join(_small(large), "cell", "left_semi").drop("cell")
        top = bottom


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shard(docs: DataFrame, limit: int, key: list[str], spread: list[str], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The `carry` columns of every row (default: the spread columns) with n_bytes, shard, depth and shard_bytes.

    shard: 'b' and the bucket's address bits, then '.page' for a row of a bucket that no bit can split.
    A shard has at most `limit` bytes of `text` unless it is one larger row.  A null text has no bytes; null keys
    hash like the text '\\N'; repeated rows share an address and stay; an empty table gives no rows.
    """
    carry = carry or spread
    told = docs.select(
        F.struct(*carry).alias("carried"),
        address(key, spread).alias("address"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    rows = keep(told, "addresses").withColumn("row", F.monotonically_increasing_id())
    rounds = directory(rows.select("address", "n_bytes"), limit)
    out = rows
    for i, (bottom, known) in enumerate(rounds):
        leaf = known.select(F.col("cell").alias(f"cell{i}"), F.struct("depth", "shard_bytes", "shard_rows").alias(f"leaf{i}"), (~F.col("large")).alias(f"is{i}"))
        out = out.withColumn(f"cell{i}", prefix(F.col("address"), bottom)).join(_small(leaf), f"cell{i}", "left")
    leaf = F.coalesce(*[F.when(F.col(f"is{i}"), F.col(f"leaf{i}")) for i in range(len(rounds))])
    out = out.withColumn("leaf", leaf).select("carried", "address", "n_bytes", "row", "leaf.*")
    bits = F.lpad(F.bin(prefix(F.col("address"), F.col("depth"))), F.col("depth"), F.lit("0"))
    out = out.withColumn("shard", F.concat(F.lit("b"), F.when(F.col("depth") > 0, bits).otherwise("")))
    tied = (F.col("depth") == BITS) & (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    result = ["carried.*", "n_bytes", "shard", "depth", "shard_bytes"]
    if rounds[-1][0] < BITS:
        return out.select(*result)
    # Row numbers hold the reading task in their upper bits: pages are numbered within it.
    task = F.shiftright("row", 33)
    own = Window.partitionBy("address", "task")
    tied_rows = out.filter(tied).withColumn("task", task).withColumn("per_page", F.greatest(F.lit(1), F.floor(limit / F.greatest(F.max("n_bytes").over(own), F.lit(1)))))
    page = F.floor((F.row_number().over(own.orderBy("row")) - 1) / F.col("per_page")).cast("long")
    tied_rows = tied_rows.withColumn("shard", F.concat_ws(".", "shard", "task", page))
    tied_rows = tied_rows.withColumn("shard_bytes", F.sum("n_bytes").over(Window.partitionBy("shard")))
    return out.filter(~tied).select(*result).unionByName(tied_rows.select(*result))


def oracle(limit: int) -> str:
    """The same assignment in SQL, for tables without unsplittable buckets."""
    return f"""
with hashed as (
  select doc_id, coalesce(strlen(text), 0) as n_bytes,
    substr(md5(coalesce(source, '\\N')), 1, {KEY_BITS // 4}) || substr(md5(coalesce(cast(doc_id as varchar), '\\N')), 1, {SPREAD_BITS // 4}) as hex
  from documents),
addressed as (
  select doc_id, n_bytes, list_aggregate(list_transform(range(1, {BITS // 4 + 1}),
    lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', substr(hex, cast(i as int), 1)) - 3, 4)), 'string_agg', '') as bits
  from hashed),
nodes as (
  select doc_id, n_bytes, depth, substr(bits, 1, depth) as node
  from addressed, (select cast(unnest(range(0, {BITS + 1})) as int) as depth)),
sums as (select depth, node, sum(n_bytes) as shard_bytes, count(*) as shard_rows from nodes group by all),
leaves as (
  select doc_id, n_bytes, min(depth) as depth from nodes join sums using (depth, node)
  where shard_bytes <= {limit} or shard_rows = 1 or depth = {BITS} group by all)
select doc_id, n_bytes, 'b' || node as shard, depth, cast(shard_bytes as bigint) as shard_bytes
from leaves join nodes using (doc_id, n_bytes, depth) join sums using (depth, node)
"""
