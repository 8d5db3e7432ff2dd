"""Best-fit packing of documents into bins of bounded size, without two of a source or duplicate cluster in a bin.

Only narrow rows (id, size, source, cluster; no texts) are shuffled.  They are dealt by a salted hash
of themselves into groups of about `WINDOW_ROWS`, so a group mixes all sources and doesn't depend on the
layout of the input; each group is packed at once.  The pieces of bins that are not nearly full are
dealt anew, with another salt into fewer groups, and packed again, until one group holds them all or
a round no longer saves a bin.  A table of up to `WINDOW_ROWS` rows is one group, packed as a whole.

Within a group rows go from large to small.  Open bins are kept in the order of their free
space and carry bitmaps of the sources and clusters they hold.  The search starts at the smallest
bin that is large enough and goes on to its successors until the bitmaps don't conflict.
Bins are kept apart by which of the group's most frequent sources they hold, and copies go on where the
copy before them ended, so hot sources and clusters don't make the search long.
A text longer than a bin fills bins of its own and only its rest is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from berthline.llm import simhash
from berthline.llm.base import by_value, keep, prepared

by_value(__name__)

CAPACITY = 8192
# Rows of a group on average, at most.
WINDOW_ROWS = 1 << 16
# A bin with less than this part of its capacity free is full and not packed again.
FULL_PART = 64
# Sources whose bins are kept apart: an order for each set of them that bins hold.
HOT_SOURCES = 6
# Equal rows are numbered in runs of so many.
RUN = 1 << 16


def _bits(values: list, hot: int = 0) -> tuple[list[int], int]:
    """A bit for each value that occurs more than once (0 for others and nulls), and the bits of the `hot` most frequent ones."""
    counts: dict = {}
    for v in values:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    bit = {v: 1 << i for i, v in enumerate(v for v, n in counts.items() if n > 1)}
    hottest = sorted(bit, key=lambda v: -counts[v])[:hot]
    return [bit.get(v, 0) for v in values], sum(bit[v] for v in hottest)


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each piece; pieces are placed from large to small, ties by cluster, then position."""
    source_bit, hot = _bits(sources, HOT_SOURCES)
    cluster_bit, _ = _bits(clusters)
    held_sources: list[int] = []
    held_clusters: list[int] = []
    # Open bins as (free space, bin), by the hot sources they hold: a piece of a hot source meets no bin that has it.
    orders: dict[int, list] = {}
    bins = [0] * len(sizes)
    resume: dict[int, tuple] = {}
    last = None
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], cluster_bit[i], i)):
        need, s, c = sizes[i], source_bit[i], cluster_bit[i]
        if last != (need, c) or not c:
            resume = {}
            last = (need, c)
        best = None
        for side, order in orders.items():
            if side & s:
                continue
            at = bisect_left(order, resume.get(side, (need, -1)))
            clear = None
            while at < len(order):
                b = order[at][1]
                if not held_clusters[b] & c:
                    clear = clear or order[at]
                    if not held_sources[b] & s:
                        break
                at += 1
            # All bins before this one hold the cluster: the next copy starts here.
            resume[side] = clear or (capacity + 1, -1)
            if at < len(order) and (best is None or order[at] < best[0]):
                best = (order[at], side, at)
        if best is None:
            b, free = len(held_sources), capacity
            held_sources.append(0)
            held_clusters.append(0)
        else:
            (free, b), side, at = best
            del orders[side][at]
        held_sources[b] |= s
        held_clusters[b] |= c
        insort(orders.setdefault(held_sources[b] & hot, []), (free - need, b))
        bins[i] = b
    return bins


def _numbered(told: DataFrame) -> DataFrame:
    """Every row with a number among its equals (k), so that no two rows are alike."""
    counted = told.groupBy(*told.columns).agg(F.count("*").alias("times"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {RUN}"))))
    first = F.col("run") * RUN
    return runs.select(*told.columns, F.explode(F.sequence(first, F.least(first + RUN, F.col("times")) - 1)).alias("k"))


def _rooted(told: DataFrame, max_bits: int) -> DataFrame:
    """`told` with the SimHash component of its fingerprint (null: none) as cluster."""
    roots = simhash.components(simhash.links(keep(told.select("fp").filter("fp is not null").distinct(), "prints"), max_bits))
    found = told.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return found.select("id", "n", "source", F.coalesce("root", "fp").cast("string").alias("cluster"))


_PACKED = "id string, k long, piece int, n_bytes long, source string, cluster string, bin long, full boolean, head boolean"


def _round(rows: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """`rows` (id, k, piece, n_bytes, source, cluster, whole) dealt into groups and packed; `whole` pieces before each fill bins of their own.

    full: the piece's bin is full.  head: the piece is the first of its bin.
    """

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "id", "k", "piece", "n_bytes", "source", "cluster"])
        rows = rows.astype(object).where(rows.notna(), None)
        base = (turn << 56) + (int(key[0]) << 36)
        sizes = [int(n) for n in rows["n_bytes"]]
        bins = best_fit(sizes, rows["source"].tolist(), rows["cluster"].tolist(), capacity)
        used = max(bins, default=-1) + 1
        fill = [0] * used
        for b, n in zip(bins, sizes):
            fill[b] += n
        out, met = [], [False] * used
        for i, k, p, n, s, c, whole, b in zip(rows["id"], rows["k"], rows["piece"], sizes, rows["source"], rows["cluster"], rows["whole"], bins):
            out.append((i, k, p, n, s, c, base + b, (capacity - fill[b]) * FULL_PART < capacity, not met[b]))
            met[b] = True
            for w in range(whole):
                out.append((i, k, w, capacity, s, c, base + used, True, True))
                used += 1
        return pd.DataFrame(out, columns=["id", "k", "piece", "n_bytes", "source", "cluster", "bin", "full", "head"])

    place = F.xxhash64("id", "k", "piece", "n_bytes", "source", "cluster", F.lit(turn))
    dealt = rows.withColumn("place", place).withColumn("group", F.pmod("place", F.lit(groups)))
    return keep(dealt.groupBy("group").applyInPandas(packed, _PACKED), f"packed-{turn}")


def _open(packed: DataFrame) -> tuple[DataFrame, int, int]:
    """The pieces in bins that are not full, their number and that of their bins."""
    left = packed.filter("not full")
    n, bins = left.agg(F.count("*"), F.count_if("head")).first()
    return left, n, bins


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None, window_rows: int = WINDOW_ROWS, near_copies: bool = False) -> DataFrame:
    """(doc_id, piece, n_bytes, bin, source): one row for each piece of each row of `docs`.

    Sizes are bytes of `text` in UTF-8; piece p of a document holds its bytes from p * capacity.  `cluster` names
    the column of duplicate clusters (default: equal texts; with `near_copies` the SimHash components of
    `simhash.near_duplicates`).  Null sources and clusters conflict with nothing,
    a null or empty text is one piece of no bytes, repeated rows are packed into different bins,
    and an empty table gives no rows.  Bins depend on the rows alone, not on their files or order.
    """
    prepared(docs.sparkSession)
    own = [
        F.col("doc_id").cast("string").alias("id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n"),
        F.col("source").cast("string").alias("source"),
    ]
    if near_copies:
        prints = simhash.with_fingerprint(docs.select("doc_id", "text", "source"), 4)
        told = _rooted(keep(prints.select(*own, F.when(F.col("text").isNotNull(), F.col("fp")).alias("fp")), "sizes"), 4)
    else:
        cluster_id = F.col(cluster) if cluster else F.xxhash64("text")
        told = docs.select(*own, F.when(F.col("text").isNotNull(), F.xxhash64(cluster_id)).cast("string").alias("cluster"))
    piece = F.when(F.col("n") > 0, F.expr(f"(n - 1) div {capacity}")).otherwise(0).cast("int")
    rows = _numbered(told).withColumn("piece", piece)
    rows = keep(rows.select("id", "k", "piece", (F.col("n") - F.col("piece") * F.lit(capacity).cast("long")).alias("n_bytes"), "source", "cluster"), "pieces")

    turn, groups = 0, max(1, -(-rows.count() // window_rows))
    packed = _round(rows.withColumn("whole", F.col("piece")), groups, turn, capacity)
    left, n, bins = _open(packed)
    parts = [packed.filter("full")]
    while groups > 1 and n:
        turn, groups = turn + 1, -(-n // window_rows)
        packed = _round(left.select(*rows.columns, F.lit(0).alias("whole")), groups, turn, capacity)
        again, n, open_bins = _open(packed)
        filled = packed.filter("full")
        if open_bins + filled.agg(F.count_if("head")).first()[0] >= bins:
            break
        parts.append(filled)
        left, bins = again, open_bins
    out = left
    for part in parts:
        out = out.unionByName(part)
    return out.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "piece", "n_bytes", "bin", "source")
