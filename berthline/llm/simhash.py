"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Every text gets a 64-bit fingerprint: a bit is set if more than half of its
   word shingles' XXH64 have it.
2. Fingerprints are stored under patterns of shared bits: 64 bits are cut into
   `max_bits + c` blocks, and two fingerprints within `max_bits` of each other
   agree on c whole blocks at least.  Each choice of c blocks is one upper level of
   the index; its masked pattern names a group.  c follows the number of fingerprints so
   that groups stay small; any c gives the same links.
3. Within a group, fingerprints are sorted by Gray rank and factored into a tree:
   a node holds the bits that all its members share.  Pairs of nodes are walked from
   the top; a pair whose shared bits already differ in more than `max_bits` places is
   pruned with all below it, one whose free bits can't exceed `max_bits` is linked whole.
   Each group gives a spanning forest, never all its pairs.
4. Links are contracted to components by taking least neighbours and jumping pointers.

Only fingerprints are shuffled; exact copies meet as one fingerprint.  A group with more
than `GROUP_ROWS` members is dealt over cells, one for each pair of its parts, so that
a hot pattern is spread over the cluster and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.base import by_value, keep

by_value(__name__)

SEED = 42
GROUP_ROWS = 2048
FANOUT = 8
# Fingerprints that a group holds on average before one more block is added to the patterns.
MEAN_GROUP = 64
HASH_CHUNK = 100_000
# Rows that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """64-bit SimHash of a whole text; no words: zero.

    Bytes are lower-cased and split as ASCII, so only A-Z and space, tab to return matter.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > words_per_shingle:
        starts, ends = starts[: 1 - words_per_shingle or None], ends[words_per_shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASH_CHUNK):
        spans = zip(starts[at : at + HASH_CHUNK].tolist(), ends[at : at + HASH_CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, words_per_shingle: int, text: str = "text", name: str = "fp") -> DataFrame:
    """`docs` with its fingerprint as a signed long in column `name`."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t, words_per_shingle) for t in texts]
        return pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, prints(F.col(text)))


def gray_rank(code: Column) -> Column:
    """Place of a code in Gray order: the prefix parity of its bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def patterns(max_bits: int, shared: int) -> list[int]:
    """Masks of the choices of `shared` whole blocks out of max_bits + shared, as signed longs."""
    blocks = max_bits + shared
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), shared):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def shared_blocks(max_bits: int, count: int) -> int:
    """Blocks in a pattern, so that a group holds about MEAN_GROUP fingerprints by chance."""
    shared = 2
    while shared < 4 and count / 2 ** (64 * shared / (max_bits + shared)) > MEAN_GROUP:
        shared += 1
    return shared


def _popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).astype(np.int64)


class _Tree:
    """Levels of nodes over Gray-sorted codes: `pattern` has the bits all members share, `mask` says which."""

    def __init__(self, codes: np.ndarray):
        self.levels = [(codes, np.full(len(codes), ~np.uint64(0)))]
        while len(self.levels[-1][0]) > 1:
            pattern, mask = self.levels[-1]
            firsts = np.arange(0, len(pattern), FANOUT)
            both = np.bitwise_and.reduceat(pattern, firsts)
            none = np.bitwise_and.reduceat(~pattern, firsts)
            known = np.bitwise_and.reduceat(mask, firsts)
            shared = (both | none) & known
            self.levels.append((both & shared, shared))

    def span(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = FANOUT**level
        return node * size, np.minimum((node + 1) * size, len(self.levels[0][0]))


def linked(codes: np.ndarray, max_bits: int) -> np.ndarray:
    """For Gray-sorted distinct codes: the least place that each is connected to by links."""
    tree = _Tree(codes)
    left = right = np.zeros(1, dtype=np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(len(tree.levels) - 1, -1, -1):
        pattern, mask = tree.levels[level]
        common = mask[left] & mask[right]
        least = _popcount((pattern[left] ^ pattern[right]) & common)
        near = least <= max_bits
        whole = near & (least + _popcount(~common) <= max_bits)
        for a, b in zip(left[whole].tolist(), right[whole].tolist()):
            (a0, a1), (b0, b1) = tree.span(level, a), tree.span(level, b)
            edges.append((np.arange(a0, a1), np.full(a1 - a0, b0)))
            edges.append((np.full(b1 - b0, a0), np.arange(b0, b1)))
        left, right = left[near & ~whole], right[near & ~whole]
        if not level or not len(left):
            break
        below = len(tree.levels[level - 1][0])
        a = (left[:, None, None] * FANOUT + np.arange(FANOUT)[None, :, None]) + np.zeros((1, 1, FANOUT), dtype=np.int64)
        b = (right[:, None, None] * FANOUT + np.arange(FANOUT)[None, None, :]) + np.zeros((1, FANOUT, 1), dtype=np.int64)
        a, b = a.ravel(), b.ravel()
        inside = (a < below) & (b < below) & (a <= b)
        left, right = a[inside], b[inside]
    place = np.arange(len(codes))
    if edges:
        x, y = (np.concatenate(side) for side in zip(*edges))
        while True:
            before = place.copy()
            least = np.minimum(place[x], place[y])
            np.minimum.at(place, place[x], least)
            np.minimum.at(place, place[y], least)
            place = place[place]
            if (place == before).all() and (place[x] == place[y]).all():
                break
    return place


def _forest(max_bits: int, keys: list[str]):
    """Spanning links of the groups in a partition sorted by group and Gray rank."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def of_groups(rows: pd.DataFrame) -> pd.DataFrame:
            codes = rows["fp"].to_numpy(np.int64).view(np.uint64)
            group = rows[keys].to_numpy(np.int64)
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(codes)])
            pair = starts[sizes == 2]
            close = pair[_popcount(codes[pair] ^ codes[pair + 1]) <= max_bits]
            a, b = [codes[close]], [codes[close + 1]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                own = codes[start : start + size]
                place = linked(own, max_bits)
                moved = np.flatnonzero(place != np.arange(size))
                a.append(own[place[moved]])
                b.append(own[moved])
            return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

        held: list[pd.DataFrame] = []
        last = None
        for rows in batches:
            if not len(rows):
                continue
            tail = rows[keys].iloc[-1].tolist()
            if last is not None and last == tail and rows[keys].iloc[0].tolist() == tail:
                held.append(rows)
                continue
            same = (rows[keys] == tail).all(axis=1).to_numpy()
            cut = int(np.argmax(same))
            held.append(rows.iloc[:cut])
            yield of_groups(pd.concat(held))
            held, last = [rows.iloc[cut:]], tail
        if held:
            yield of_groups(pd.concat(held))

    return links


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column fp."""
    masks = patterns(max_bits, shared_blocks(max_bits, prints.count()))
    arms = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for t, m in enumerate(masks)]
    members = prints.select("fp", F.explode(F.array(*arms)).alias("g")).select("fp", "g.t", "g.pattern")
    large = members.groupBy("t", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_ROWS)
    large = keep(large, "simhash-large")
    parts = F.coalesce(F.ceil(F.col("n") / GROUP_ROWS), F.lit(1)).cast("int")
    dealt = (
        members.join(large, ["t", "pattern"], "left")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("t", "pattern", "fp", F.least("part", "other").alias("u"), F.greatest("part", "other").alias("v"))
    )
    keys = ["t", "pattern", "u", "v"]
    ordered = dealt.repartition(*keys).withColumn("rank", gray_rank(F.col("fp"))).sortWithinPartitions(*keys, "rank")
    return ordered.mapInPandas(_forest(max_bits, keys), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each end of the links (a, b): the least node of its component.

    Each round gives every node its least neighbour as parent, jumps the parents to their roots
    and replaces the ends of the links by roots; links within a component vanish.
    Every round is a table in the shared folder.
    """
    edges = keep(edges, "links")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "next")
        parents = keep(both.groupBy("node").agg(F.least("node", F.min("next")).alias("root")), "parents")
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = parents.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved"))
            jumped = keep(jumped, "parents")
            parents = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        ends = edges
        for end in ("a", "b"):
            ends = ends.join(parents.select(F.col("node").alias(end), F.col("root").alias("at")), end).drop(end).withColumnRenamed("at", end)
        edges = keep(ends.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if found is None:
            found = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = keep(found.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of `docs`.

    fp: fingerprint as a signed long.  root: the fingerprint that names the component.
    component_id: the least doc_id of the component, null if all its ids are null.  Null and
    empty texts have fingerprint zero and are linked like any other; repeated rows are
    repeated in the result; an empty table gives no rows; other columns are not read.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = keep(with_fingerprint(named, words_per_shingle).select("doc_id", "fp"), "prints")
    distinct = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    member = keep(member.select("fp", "first", F.coalesce("root", "fp").alias("root")), "members")
    least = keep(member.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named_groups = keep(member.join(least, "root").select("fp", "root", "component_id"), "groups")
    return prints.join(named_groups, "fp").select("doc_id", "fp", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of `docs` (doc_id, text and others) without near copies: of each component the row with the least doc_id.

    Null and empty texts are linked like any other, an empty table gives no rows, and other columns come along whatever their names.
    Null ids come last.  Of repeated ids the row with the least text hash stays, of rows equal in id and text one.
    """
    key = [F.xxhash64("text").alias("_hash"), F.col("doc_id").alias("_id")]
    rows = keep(with_fingerprint(docs.select("doc_id", "text"), words_per_shingle).select(*key, "fp"), "prints")
    distinct = rows.select("fp").distinct()
    roots = components(links(keep(distinct, "distinct"), max_bits)).withColumnRenamed("node", "fp")
    rooted = rows.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = keep(rooted.groupBy("root", "_id", "_hash").agg(F.count("*").alias("times")), "rooted")
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash")).alias("first"))
    first = keep(first, "first")
    judged = rooted.join(first, "root").select("_id", "_hash", "times", (F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash") != F.col("first")).alias("dropped"))
    judged = keep(judged.filter("dropped or times > 1"), "judged")
    marks = judged.select(F.coalesce("_id", F.lit(0)).alias("_id"), F.col("_id").isNull().alias("_none"), "_hash", "dropped")
    # The rows' own columns travel as one, so that none can clash with those made here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    told = docs.select(row, F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.xxhash64("text").alias("_hash"))
    own = ["_id", "_none", "_hash"]
    few = marks.count() <= BROADCAST_ROWS
    found = told.join(F.broadcast(marks) if few else marks, own, "left")
    # Rows that stay and are repeated: one of each, the others never leave their task.
    once = found.filter("dropped is null").select("row.*")
    if judged.filter("not dropped").isEmpty():
        return once
    return once.unionByName(found.filter("not dropped").dropDuplicates(own).select("row.*"))
