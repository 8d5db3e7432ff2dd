"""Hard negatives by exact integer scores: a residue-number-system GEMM and windows of scores.

1. Components become integers, floor(scale * x).  A score is an integer inner product, so it is known
   exactly from its remainders modulo a few small primes whose product is more than twice the largest score.
2. Anchors and candidates meet in cells: a tile of anchors and a stripe of candidates.  In a cell
   the component matrices are multiplied modulo each prime in float32.  Remainders lie in
   -p/2..p/2, so all sums stay below 2**24 and float32 is exact.  Chinese remaindering
   in balanced mixed radix gives the signed score back.
3. A first pass keeps the best rows of the anchor's label, the positives.  A second keeps for each positive
   the best rows of other labels whose score lies in the window that the positive's score sets.
   Candidates stream through a cell, which holds its anchors, one batch and k rows a window;
   window functions keep the best of all cells.

Anchors are a query set against all rows, in blocks.  Every candidate is copied once per
tile, every anchor once per stripe; the multiplications outweigh the copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from berthline.llm.base import by_value, keep

by_value(__name__)

# Primes below 256, largest first.
PRIMES = [p for p in range(255, 15, -1) if all(p % q for q in range(2, 16))]
# Products of remainders of one prime that float32 sums exactly.
EXACT_TERMS = (1 << 24) // (max(PRIMES) // 2) ** 2
# Scores must stay below this, so that percentages of them fit 64 bits.
MOST_SCORE = 1 << 56
# Anchors in a tile, candidates in a stripe at least, stripes at most.
TILE = 4096
STRIPE = 4096
STRIPES = 256
# Anchors scored at once against a batch.
ANCHORS_AT_ONCE = 256
NONE = np.iinfo(np.int64).min


def moduli(bound: int) -> list[int]:
    """The fewest primes whose product tells all integers from -bound to bound apart."""
    product, chosen = 1, []
    for p in PRIMES:
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    return chosen


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Remainders in -(p-1)/2..(p-1)/2."""
    x = x % p
    return np.where(x > p // 2, x - p, x)


def residues(rows: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [_balanced(rows, p).astype(np.float32) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of two matrices given by their residues."""
    digits: list[np.ndarray] = []
    for at, (a, b, p) in enumerate(zip(left, right, primes)):
        rest = np.zeros((a.shape[0], b.shape[0]), dtype=np.int32)
        for c in range(0, a.shape[1], EXACT_TERMS):
            rest = (rest + (a[:, c : c + EXACT_TERMS] @ b[:, c : c + EXACT_TERMS].T).astype(np.int32)) % p
        for digit, q in zip(digits, primes[:at]):
            rest = (rest - digit) % p * pow(q, -1, p) % p
        digits.append(np.where(rest > p // 2, rest - p, rest))
    score = digits[-1].astype(np.int64)
    for digit, p in zip(digits[-2::-1], primes[len(digits) - 2 :: -1]):
        score = score * p + digit
    return score


class _Tile:
    """The anchors of a cell, and for each of their windows the k best candidates so far."""

    def __init__(self, anchors: pd.DataFrame, primes: list[int], k: int, same: bool):
        self.primes, self.k, self.same = primes, k, same
        self.ask = anchors["ask"].to_numpy(np.int64)
        self.own = anchors["vec_id"].to_numpy(np.int64)
        self.label = anchors["label"].to_numpy(np.int64)
        self.parts = residues(np.vstack(anchors["c"]), primes)
        windows = [(row, slot, lo, hi) for row, (los, his) in enumerate(zip(anchors["lo"], anchors["hi"])) for slot, (lo, hi) in enumerate(zip(los, his))]
        self.row, self.slot, self.lo, self.hi = np.array(windows, dtype=np.int64).reshape(-1, 4).T
        self.best = np.full((len(windows), k), NONE)
        self.ids = np.zeros((len(windows), k), dtype=np.int64)

    def meet(self, rows: pd.DataFrame) -> None:
        """Candidates in order of their ids."""
        ids, label = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        parts = residues(np.vstack(rows["c"]), self.primes)
        for at in range(0, len(self.ask), ANCHORS_AT_ONCE):
            mine = slice(at, at + ANCHORS_AT_ONCE)
            score = products([p[mine] for p in self.parts], parts, self.primes)
            fits = (self.label[mine, None] == label) == self.same
            fits &= self.own[mine, None] != ids
            score[~fits] = NONE
            first, end = np.searchsorted(self.row, [at, at + ANCHORS_AT_ONCE])
            # One window of each anchor at a time; a later candidate must beat the k-th, since its id is no smaller.
            for slot in np.unique(self.slot[first:end]):
                windows = np.arange(first, end)[self.slot[first:end] == slot]
                own = score[self.row[windows] - at]
                least = np.maximum(self.lo[windows], self.best[windows, -1] + 1)
                hit, col = np.nonzero((own >= least[:, None]) & (own <= self.hi[windows, None]))
                self._merge(windows[hit], own[hit, col], ids[col])

    def _merge(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(window):
            return
        changed = np.unique(window)
        window = np.r_[np.repeat(changed, self.k), window]
        score, ids = np.r_[self.best[changed].ravel(), score], np.r_[self.ids[changed].ravel(), ids]
        order = np.lexsort((ids, -score, window))
        order = order[score[order] != NONE]
        window, score, ids = window[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        place = np.arange(len(window)) - np.repeat(starts, np.diff(np.r_[starts, len(window)]))
        stays = place < self.k
        self.best[changed] = NONE
        self.best[window[stays], place[stays]] = score[stays]
        self.ids[window[stays], place[stays]] = ids[stays]

    def found(self) -> pd.DataFrame:
        at, place = np.nonzero(self.best != NONE)
        return pd.DataFrame({"ask": self.ask[self.row[at]], "slot": self.slot[at].astype(np.int32), "vec_id": self.ids[at, place], "score": self.best[at, place]})


def _cells(primes: list[int], k: int, same: bool):
    """Walk cells, sorted by tile, stripe, side and id: anchors first, then candidates."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, anchors, tile = None, [], None
        for batch in batches:
            for key, rows in batch.groupby(["tile", "stripe", "side"], sort=True):
                if key[:2] != cell:
                    if tile is not None:
                        yield tile.found()
                    cell, anchors, tile = key[:2], [], None
                if key[2] == 0:
                    anchors.append(rows)
                elif anchors:
                    if tile is None:
                        tile = _Tile(pd.concat(anchors), primes, k, same)
                    tile.meet(rows)
        if tile is not None:
            yield tile.found()

    return walk


def _best(asks: DataFrame, rows: DataFrame, primes: list[int], k: int, same: bool, tiles: int, stripes: int) -> DataFrame:
    """(ask, slot, vec_id, score, place): for each window of `asks` its k best rows of the same or of another label."""
    tile = F.pmod(F.xxhash64("ask"), F.lit(tiles)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<long>")
    left = asks.select(tile.alias("tile"), every(stripes).alias("stripe"), F.lit(0).alias("side"), "ask", "vec_id", "label", "c", "lo", "hi")
    right = rows.select(
        every(tiles).alias("tile"), F.pmod("nr", F.lit(stripes)).cast("int").alias("stripe"), F.lit(1).alias("side"),
        F.lit(0).cast("long").alias("ask"), "vec_id", "label", "c", none.alias("lo"), none.alias("hi"),
    )
    dealt = left.unionByName(right).repartition(2 * tiles * stripes, "tile", "stripe").sortWithinPartitions("tile", "stripe", "side", "vec_id")
    found = dealt.mapInPandas(_cells(primes, k, same), "ask long, slot int, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("ask", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among `vectors`.

    A row's score is its integer inner product with the anchor, of components floor(scale * x).  Positives: the
    first rows of the anchor's label; negatives of a positive: the first rows of other labels
    whose score is from window[0] to window[1] per cent of the positive's.  Higher scores come first, ties by smaller id.

    Rows with a null id or label, a null vector or a null or non-finite component take no part.  Vectors of different
    lengths are filled up with zeros.  Rows with the anchor's id are never its positives or negatives.
    Equal anchor rows count once; repeated rows of others are candidates each.  An anchor without positives or
    a positive without negatives gives no rows, an empty table none.  Other columns are not read.
    Scores that could reach 2**56 raise a ValueError.
    """
    read = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("v"), is_anchor.alias("anchor"))
    read = read.filter("vec_id is not null and label is not null and v is not null")
    read = read.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    # Doubles beyond the range of long saturate, so that the bound below refuses them.
    whole = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = keep(read.select("vec_id", "label", "anchor", whole.alias("c"), F.monotonically_increasing_id().alias("nr")), "components")
    # Both ends: the absolute value of the least long is no long.
    ends = rows.agg(
        F.count("*").alias("n"), F.max(F.size("c")).alias("dims"),
        F.max(F.array_max("c")).alias("most"), F.min(F.array_min("c")).alias("least"),
    ).first()
    dims = max(1, ends["dims"] or 0)
    largest = max(ends["most"] or 0, -(ends["least"] or 0))
    bound = dims * largest * largest
    if bound >= MOST_SCORE:
        raise ValueError(f"scores could reach {bound}; at most {MOST_SCORE} can be told exactly, use a smaller scale")
    primes = moduli(max(1, bound))
    filled = F.concat("c", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("c")))
    rows = rows.withColumn("c", filled)
    asks = keep(rows.filter("anchor").select("vec_id", "label", "c").distinct().withColumn("ask", F.monotonically_increasing_id()), "anchors")
    tiles = max(1, -(-asks.count() // TILE))
    stripes = min(STRIPES, max(1, -(-ends["n"] // STRIPE)))

    whole_range = asks.withColumns({"lo": F.array(F.lit(-MOST_SCORE)), "hi": F.array(F.lit(MOST_SCORE))})
    near = _best(whole_range, rows, primes, positives, True, tiles, stripes)
    near = keep(near.select("ask", (F.col("place") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low, high = window
    edges = F.array_sort(F.collect_list(F.struct("slot", "positive_score")))
    # Whole numbers n with low * score <= 100 * n <= high * score.
    lo = F.expr(f"transform(edges, e -> -((e.positive_score * ({-low}) - pmod(e.positive_score * ({-low}), 100)) div 100))")
    hi = F.expr(f"transform(edges, e -> (e.positive_score * ({high}) - pmod(e.positive_score * ({high}), 100)) div 100)")
    windows = near.groupBy("ask").agg(edges.alias("edges")).select("ask", lo.alias("lo"), hi.alias("hi"))
    far = _best(asks.join(windows, "ask"), rows, primes, negatives, False, tiles, stripes)
    named = near.join(asks.select("ask", F.col("vec_id").alias("anchor_id")), "ask")
    told = far.select("ask", "slot", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return told.join(named, ["ask", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
