"""Prefix trie of conversations, built by union-find over sorted neighbours.

1. A turn is 24 bytes: a 16-byte digest of role and text, and the text's UTF-8 length.  A conversation
   is its turns' bytes in order, so comparing bytes compares sequences, a prefix before what goes on from it.
   Copies meet as one sequence with a count and its least id.
2. Distinct sequences are range-partitioned and sorted; a partition is a run of neighbours.  The depth that two
   neighbours share (LCP) is an edge.  Edges are taken deepest first: each joins the two components beside it by
   union-find, and that merge makes the branching node at that depth, or lets the component whose
   top is already there take in the other.  The nodes between a component's top and the new node have
   one child each and the component's members.
3. A component without a partition's first or last sequence is a finished subtree: its nodes are final.
   Of the others, whose nodes are prefixes of those two sequences, only what hangs on each such
   node is handed on, summed up: the partition's forest contracted to its two spines.
4. Contracted forests of neighbouring partitions are merged by the same step, FAN at a time, until one group holds
   all; there nothing is open, and the root closes the trie.

Texts never move: digests, lengths and ids do.  Copies of a hot conversation are counted before the sort; hot
prefixes are split by what follows them.  The ids that end in a node are joined in pieces on ranges of ids, and one task
hashes a node's pieces, since a digest has to read them in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.base import by_value, keep

by_value(__name__)

TURN_BYTES = 24
# Sequences in a partition: at least, where tasks would be idle otherwise, and at most.
LEAST_RUN = 1024
RUN = 32768
# Contracted forests merged at once.
FAN = 32
# Characters of ids that one row holds.
PIECE_CHARS = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

# left, right: the sequence is the first or last of the forest `part` that hands it on.
_ITEM = "part int, left boolean, right boolean, seq binary, n long, first long, children long, leaves long, saved long, ended boolean, end_first long"
# Beside the result: parent_ref and ref name a parent that another group finishes, node_end the sequence that ends here.
_NODE = "conv_id long, depth long, parent_conv_id long, parent_ref binary, ref binary, n_convs long, n_children long, n_leaves long, saved_tokens long, node_end long, digest binary"


def turn_bytes(role: Column, text: Column) -> Column:
    """24 bytes of a turn as hex: digest of (role, text), then the text's length in bytes."""
    # The role's length keeps pairs apart whose texts run together the same way.
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(told, 256), 1, 32), F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 16, "0"))


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as 24 bytes in hex each.

    Ordered by turn, null first, equal turns by role and digest.  Null roles and texts are empty; rows without a conversation id
    take no part; repeated rows are repeated turns; other columns are not read.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    read = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"), turn_bytes(role_, text_).alias("code"))
    # Structs sort field by field, nulls first.
    lists = read.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "code"))).alias("told"))
    return lists.select("conv_id", F.transform("told", lambda t: t["code"]).alias("turns"))


class _Component:
    """A subtree and its top node: a prefix of `seq`, `depth` turns long."""

    __slots__ = ("seq", "depth", "n", "first", "children", "leaves", "saved", "end_first", "left", "right", "open", "spine", "tops")

    def __init__(self, seq, depth, n=0, first=None, children=0, leaves=0, saved=0, end_first=None, left=False, right=False):
        self.seq, self.depth, self.n, self.first = seq, depth, n, first
        self.children, self.leaves, self.saved, self.end_first = children, leaves, saved, end_first
        # Top of the group's first or last sequence.  Open: may go on in another group.  Spine: earlier groups finished children of its top.
        self.left, self.right = left, right
        self.open, self.spine = left or right, children > 0
        # Finished children whose parent id is known once this node is finished.
        self.tops: list[int] = []


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


class _Forest:
    """Union-find over one run of sorted items; nodes are what is finished, items what is handed on."""

    def __init__(self, group: int, rows: pd.DataFrame, fresh: bool, last_group: bool):
        self.group = group
        self.nodes: list[list] = []
        self.items: list[tuple] = []
        seqs = [np.frombuffer(s, dtype=">u8").reshape(-1, 3) if s else np.empty((0, 3), dtype=">u8") for s in rows["seq"]]
        end = len(seqs) - 1
        part = rows["part"].to_numpy()
        left, right = (rows["left"] & (part == part.min())).to_numpy(bool), (rows["right"] & (part == part.max())).to_numpy(bool)
        if fresh:
            left[0] = right[end] = True
        if last_group:
            left[:] = right[:] = False
        columns = (rows[c].tolist() for c in ("n", "first", "children", "leaves", "saved", "ended", "end_first"))
        self.tree = [
            _Component(s, len(s), n, first, children, leaves, saved, end_first if ended else None, at_left, at_right)
            for s, at_left, at_right, n, first, children, leaves, saved, ended, end_first in zip(seqs, left.tolist(), right.tolist(), *columns)
        ]
        self.up = list(range(len(seqs)))
        shared = [self._lcp(a, b) for a, b in zip(seqs, seqs[1:])]
        for edge in sorted(range(end), key=shared.__getitem__, reverse=True):
            self._merge(self._find(edge), self._find(edge + 1), shared[edge])
        top = self.tree[self._find(0)]
        if not last_group:
            self._hand_on(top)
            return
        if top.depth:
            root = _Component(top.seq, 0)
            self._attach(top, root)
            top = root
        self._finish(top, None)

    @staticmethod
    def _lcp(a: np.ndarray, b: np.ndarray) -> int:
        most = min(len(a), len(b))
        apart = (a[:most] != b[:most]).any(axis=1)
        return int(apart.argmax()) if apart.any() else most

    def _find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Join two neighbouring components, whose tops lie no higher than `depth`, in the node at `depth`."""
        left, right = self.tree[a], self.tree[b]
        self.up[b] = a
        if left.depth == depth and right.depth == depth:
            # The same node from two partitions.
            for name in ("n", "children", "leaves", "saved"):
                setattr(left, name, getattr(left, name) + getattr(right, name))
            left.first, left.end_first = _least(left.first, right.first), _least(left.end_first, right.end_first)
            left.tops += right.tops
            for name in ("left", "right", "open", "spine"):
                setattr(left, name, getattr(left, name) or getattr(right, name))
            return
        if left.depth == depth:
            node = left
        else:
            node = right if right.depth == depth else _Component(left.seq, depth)
            if node is not left:
                self._attach(left, node)
        if node is not right:
            self._attach(right, node)
        self.tree[a] = node

    def _hand_on(self, top: _Component) -> None:
        """An open node's own part: what hangs on it and is finished."""
        if not top.n:
            return
        told = top.seq[: top.depth].tobytes()
        ref = hashlib.sha256(told).digest()
        for row in top.tops:
            self.nodes[row][3] = ref
        ended = top.end_first is not None
        self.items.append((self.group, top.left, top.right, told, top.n, top.first, top.children, top.leaves, top.saved, ended, top.end_first if ended else 0))

    def _attach(self, top: _Component, node: _Component) -> None:
        """Finish the nodes from a component's top up to below `node`, and count them there."""
        if top.open:
            self._hand_on(top)
            node.open = True
            return
        row = self._finish(top, top.first)
        leaves, saved = top.leaves or 1, self.nodes[row][8]
        lengths = top.seq[:, 2]
        for depth in range(top.depth - 1, node.depth, -1):
            saved += (top.n - 1) * int(lengths[depth - 1])
            row = self._add(top, depth, top.first, 1, leaves, saved, None)
        self.nodes[row][2] = None
        node.tops.append(row)
        node.n += top.n
        node.first = _least(node.first, top.first)
        node.children += 1
        node.leaves += leaves
        node.saved += saved

    def _finish(self, top: _Component, parent: int | None) -> int:
        own = (top.n - 1) * int(top.seq[top.depth - 1, 2]) if top.depth else 0
        for row in top.tops:
            self.nodes[row][2] = top.first
        row = self._add(top, top.depth, parent, top.children, top.leaves or 1, top.saved + own, top.end_first)
        if top.spine:
            self.nodes[row][4] = hashlib.sha256(top.seq[: top.depth].tobytes()).digest()
        return row

    def _add(self, top: _Component, depth: int, parent, children: int, leaves: int, saved: int, end_first) -> int:
        digest = top.seq[depth - 1, :2].tobytes() if depth else None
        self.nodes.append([top.first, depth, parent, None, None, top.n, children, leaves, saved, end_first, digest])
        return len(self.nodes) - 1


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _merged(fresh: bool, last_group: bool):
    """Forests of the groups in a partition sorted by group and sequence; finished nodes and handed-on items in one schema."""
    items, nodes = _names(_ITEM), _names(_NODE)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def of(group: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            forest = _Forest(group, rows, fresh, last_group)
            for told, columns, others in ((forest.nodes, nodes, items), (forest.items, items, nodes)):
                for at in range(0, len(told), 10_000):
                    frame = pd.DataFrame(told[at : at + 10_000], columns=columns, dtype=object)
                    yield frame.assign(**dict.fromkeys(set(others), None))[items + nodes]

        held: list[pd.DataFrame] = []
        for batch in batches:
            for group, rows in batch.groupby("group", sort=True):
                if held and held[-1]["group"].iloc[0] != group:
                    yield from of(int(held[-1]["group"].iloc[0]), pd.concat(held))
                    held = []
                held.append(rows)
        if held:
            yield from of(int(held[-1]["group"].iloc[0]), pd.concat(held))

    return walk


def _ends_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of (end_first, conv_id), sorted, to pieces of joined ids."""
    for batch in batches:
        rows = []
        for first, ids in batch.groupby("end_first", sort=True)["conv_id"]:
            told = ids.tolist()
            step = PIECE_CHARS // 21
            rows += [(first, told[at], ",".join(map(str, told[at : at + step]))) for at in range(0, len(told), step)]
        yield pd.DataFrame(rows, columns=["end_first", "start", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces sorted by (end_first, start) to one digest for each end_first."""
    last, digest = None, None
    for batch in batches:
        rows = []
        for first, ids in zip(batch["end_first"].tolist(), batch["ids"]):
            if first != last:
                if digest is not None:
                    rows.append((last, digest.hexdigest()))
                last, digest = first, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pd.DataFrame(rows, columns=["end_first", "ends_sha256"])
    if digest is not None:
        yield pd.DataFrame([(last, digest.hexdigest())], columns=["end_first", "ends_sha256"])


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of `convs` (conv_id, turns as `sequences` gives them): one row for each distinct prefix.

    conv_id: least member; depth: turns, 0 for the root; parent_conv_id: the parent's least member, null for the root; n_convs:
    members; n_children; n_leaves: childless nodes of the subtree; saved_tokens: summed over the subtree, (n_convs - 1) times
    the bytes of each node's last text; ends_sha256: of the ids of the members that end here, in order, joined by commas; digest: of the last turn.

    Conversations without turns (null or empty) are members of the root; a null conv_id takes no part; rows with the same conv_id and turns count as one.
    No conversations give no rows.  A conversation's turns are one value: 24 bytes a turn.
    """
    spark = convs.sparkSession
    code = F.concat_ws("", F.coalesce("turns", F.array().cast("array<string>")))
    read = convs.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.unhex(code).alias("seq"))
    read = keep(read.withColumn("key", F.unhex(F.sha2("seq", 256))).dropDuplicates(["conv_id", "key"]), "sequences")
    counts = keep(read.groupBy("key").agg(F.min("conv_id").alias("end_first"), F.count("*").alias("n")), "copies")
    one = read.select(F.col("conv_id").alias("end_first"), "key", "seq")
    distinct = keep(counts.join(one, ["key", "end_first"]).select("end_first", "n", "seq"), "distinct")
    n = distinct.count()
    parts = max(1, -(-n // RUN), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_RUN)))
    zero = F.lit(0).cast("long")
    runs = distinct.repartitionByRange(parts, "seq").sortWithinPartitions("seq").select(F.spark_partition_id().alias("part"), "seq", "n", "end_first")
    # The stored runs tell how many partitions there are: a cluster may have dealt them to more.
    runs = keep(runs, "runs")
    zero, no = F.lit(0).cast("long"), F.lit(False)
    items = runs.select(
        "part", no.alias("left"), no.alias("right"), "seq", "n", F.col("end_first").alias("first"), zero.alias("children"),
        zero.alias("leaves"), zero.alias("saved"), F.lit(True).alias("ended"), "end_first", F.col("part").alias("group"),
    )
    groups = (runs.agg(F.max("part")).first()[0] or 0) + 1
    finished = []
    while True:
        dealt = items.repartition(groups, "group").sortWithinPartitions("group", "seq")
        told = keep(dealt.mapInPandas(_merged(not finished, groups == 1), f"{_ITEM}, {_NODE}"), "forest")
        finished.append(told.filter("depth is not null").select(*_names(_NODE)))
        if groups == 1:
            break
        groups = -(-groups // FAN)
        items = told.filter("seq is not null").select(*_names(_ITEM)).withColumn("group", (F.col("part") / FAN).cast("int"))
    nodes = reduce(DataFrame.unionByName, finished)
    # Children that an earlier group finished below a spine node get their parent's id now.
    spine = nodes.filter("ref is not null").select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("spine_id"))
    named = nodes.join(spine, "parent_ref", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "spine_id"))
    # The ids that end in a node: a sequence is named by its least conversation.
    members = read.join(counts, "key").select("end_first", "conv_id")
    runs = members.repartitionByRange("end_first", "conv_id").sortWithinPartitions("end_first", "conv_id")
    pieces = runs.mapInPandas(_ends_of, "end_first long, start long, ids string")
    ends = pieces.repartition("end_first").sortWithinPartitions("end_first", "start").mapInPandas(_hashed, "end_first long, ends_sha256 string")
    named = named.join(ends.withColumnRenamed("end_first", "node_end"), "node_end", "left")
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), F.lower(F.hex("digest")).alias("digest"),
    )


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of a table of turns, with each node's last role and text (null for the root).

    The cases of `sequences` and `trie` hold.
    """
    nodes = trie(sequences(turns, conv_id, turn, role, text))
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    said = turns.filter(F.col(conv_id).isNotNull()).select(role_.alias("role"), text_.alias("text"), F.substring(turn_bytes(role_, text_), 1, 32).alias("digest"))
    return nodes.join(said.groupBy("digest").agg(F.min("role").alias("role"), F.min("text").alias("text")), "digest", "left")


def with_shared_heads(convs: DataFrame, step: int = 5, most: int = 8) -> DataFrame:
    """Rebuilt conversations (conv_id, turns): the first h turns of conversation c - c % step, then c's own after its first h.

    h is the crc32 of c's decimal, modulo most + 1.  Absent conversations have no turns, so a rebuilt one can be without any.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    own = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % step).alias("head_id"), h.alias("h"))
    heads = convs.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<string>"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))
