"""Nearest neighbours by inner product through multi-index hashing.

1. Equal vectors are one entry that keeps its k + 1 least ids (ties go to smaller ids, so
   more can't be found); a vector that a third of all rows share costs one entry.
2. A bounded sample gives a learned code: principal axes, turned so that signs lose
   least (iterative quantisation), of which each has `BITS` signs.  Every entry gets its code.
3. A code is cut into `PARTS` substrings.  Each block of entries is indexed by each substring:
   entries are sorted by it, so a substring value names a run.  If two codes differ
   in at most r bits, some substring differs in at most r // PARTS; probing the values that
   near finds every code within r.  The found ones are checked by their whole code, then ranked
   by exact inner products in double precision.
4. Queries meet blocks of entries, block by block; each pair of blocks returns the best k + 1 of a
   query, and a window keeps the best of all.  A query with fewer than k neighbours in its
   radius is searched again without one.

The radius is calibrated on the sample: so that `RECALL` of the sample's exact neighbours lie within it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from berthline.llm.base import by_value, keep

by_value(__name__)

BITS = 64
PARTS = 4
SAMPLE = 8192
SAMPLE_QUERIES = 512
RECALL = 0.97
ROUNDS = 30
# Vectors in a block of queries and of entries.
QUERY_BLOCK = 4096
ENTRY_BLOCK = 16384
PAIR_CHUNK = 1 << 18
SEED = 11


class Coder:
    """Rotated binary codes: center, axes and the calibrated radius."""

    def __init__(self, sample: np.ndarray, k: int, recall: float = RECALL):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        dims = sample.shape[1]
        self.mean = unit.mean(axis=0)
        # Principal axes from the covariance: dims x dims, whatever the size of the sample.
        axes = np.linalg.eigh((unit - self.mean).T @ (unit - self.mean))[1][:, ::-1].T
        rng = np.random.default_rng(SEED)
        turns = []
        # As many rotations as it takes to have BITS signs from `dims` axes.
        for at in range(0, BITS, dims):
            width = min(dims, BITS - at)
            flat = (unit - self.mean) @ axes[:width].T
            turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(ROUNDS):
                u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
                turn = (u @ v).T
            turns.append(axes[:width].T @ turn)
        self.turn = np.hstack(turns)
        self.radius = BITS
        codes = self.codes(sample)
        asked = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
        score = sample[asked] @ sample.T
        score[np.arange(len(asked)), asked] = -np.inf
        near = np.argsort(-score, axis=1)[:, : min(k, len(sample) - 1)]
        if near.size:
            apart = np.bitwise_count(codes[asked][:, None] ^ codes[near])
            self.radius = int(np.quantile(apart, recall, method="higher"))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        signs = (unit - self.mean) @ self.turn > 0
        return np.packbits(signs, axis=1).view(">u8").astype(np.uint64).ravel()


class BlockIndex:
    """Multi-index over the codes of a block: for each substring the distinct values and their runs of entries."""

    def __init__(self, codes: np.ndarray, parts: int = PARTS):
        self.codes, self.parts = codes, parts
        self.width = BITS // parts
        self.mask = np.uint64((1 << self.width) - 1)
        self.tables = []
        for p in range(parts):
            own = self.part(codes, p)
            order = np.argsort(own, kind="stable")
            values, starts = np.unique(own[order], return_index=True)
            self.tables.append((values, np.r_[starts, len(codes)], order))

    def part(self, codes: np.ndarray, p: int) -> np.ndarray:
        return (codes >> np.uint64(p * self.width)) & self.mask

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Places of all codes within `radius` of `code`."""
        found = []
        for p, (values, starts, order) in enumerate(self.tables):
            near = np.flatnonzero(np.bitwise_count(values ^ self.part(code, p)) <= radius // self.parts)
            lengths = starts[near + 1] - starts[near]
            ends = np.cumsum(lengths)
            if len(near):
                runs = np.repeat(starts[near] - (ends - lengths), lengths) + np.arange(ends[-1])
                found.append(order[runs])
        mark = np.zeros(len(self.codes), dtype=bool)
        for f in found:
            mark[f] = True
        places = np.flatnonzero(mark)
        return places[np.bitwise_count(self.codes[places] ^ code) <= radius]


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of rows that take part: with an id and a non-empty vector of finite numbers, not all zero."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(finite).filter(F.exists("v", lambda x: x != 0))


def _search(pairs: DataFrame, blocks: DataFrame, coder: Coder, k: int, radius: int) -> DataFrame:
    """(entry, vec_id, score): the best k + 1 ids for each query entry, over all blocks."""

    def best(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"entry": [], "vec_id": [], "score": []})
        vectors = np.vstack(held["v"])
        queries = np.vstack(asked["v"])
        index = BlockIndex(coder.codes(vectors))
        ids = held["ids"].tolist()
        out = []
        for entry, code, query in zip(asked["entry"], coder.codes(queries), queries):
            places = index.within(code, radius)
            if not len(places):
                continue
            score = np.concatenate([vectors[places[at : at + PAIR_CHUNK]] @ query for at in range(0, len(places), PAIR_CHUNK)])
            if len(places) > k + 1:
                least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                places, score = places[score >= least], score[score >= least]
            told = [(-s, i) for s, p in zip(score.tolist(), places.tolist()) for i in ids[p]]
            out += [(entry, i, -s) for s, i in sorted(told)[: k + 1]]
        return pd.DataFrame(out, columns=["entry", "vec_id", "score"])

    met = pairs.groupBy("qb", "eb").cogroup(blocks.groupBy("qb", "eb")).applyInPandas(best, "entry long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", radius: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` (a column query_id, ids of `vectors`) its k nearest others.

    Nearest: largest inner product, ties to the smaller id.  Null ids and vectors that are null, empty, zero, not finite or not of
    the most frequent length take no part, as query or candidate.  Rows with the same id and vector count
    as one; an id with two vectors is searched with both and found by both.  Other columns are not read.
    """
    rows = keep(valid(vectors, vec_id, embedding), "vectors")
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("v") == sizes[0]["size"])
    # At most k + 1 ids of a vector get past the limit in the reading tasks.
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = rows.distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = distinct.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = keep(entries.withColumn("entry", F.col("ids")[0]), "entries")
    sample = entries.select("v", F.xxhash64("v").alias("at")).orderBy("at", "v").limit(SAMPLE).toPandas()
    coder = Coder(np.vstack(sample["v"]), k)
    asked = keep(queries.select("query_id").distinct().join(rows.distinct().withColumnRenamed("vec_id", "query_id"), "query_id"), "queries")
    ids = asked.join(entries.select("v", "entry", "ids"), "v").select("query_id", "entry")
    ids = keep(ids, "query-entries")
    wanted = asked.groupBy("v").agg(F.min("query_id").alias("any"))
    wanted = wanted.join(entries.select("v", "entry"), "v").select("entry", "v")
    n_entries, n_queries = entries.count(), wanted.count()
    eb, qb = -(-n_entries // ENTRY_BLOCK), max(1, -(-n_queries // QUERY_BLOCK))
    entry_block = F.pmod(F.xxhash64("entry", "v"), F.lit(eb)).cast("int")
    query_block = F.pmod(F.xxhash64("entry", "v"), F.lit(qb)).cast("int")
    blocks = entries.select("v", "ids", entry_block.alias("eb"), F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"))
    pairs = wanted.select("entry", "v", query_block.alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(eb - 1))).alias("eb"))
    found = keep(_search(pairs, blocks, coder, k, coder.radius if radius is None else radius), "near")
    # Short of k others: searched again among all.
    total = entries.select(F.sum(F.size("ids"))).first()[0]
    enough = found.groupBy("entry").count().filter(F.col("count") >= min(k + 1, total)).select("entry")
    short = keep(wanted.select("entry").join(enough, "entry", "left_anti"), "short")
    if not short.isEmpty():
        again = _search(pairs.join(short, "entry"), blocks, coder, k, BITS)
        found = keep(found.join(short, "entry", "left_anti").unionByName(again), "near")
    lists = found.groupBy("entry").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("near"))
    told = ids.join(lists, "entry").select("query_id", "near")
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = told.select("query_id", F.posexplode(own).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.down")).alias("score"))
