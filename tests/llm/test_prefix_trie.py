import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from berthline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, part string, seq string"


def told(rows):
    """Conversations of rows (conv_id, turn, role, text), by brute force."""
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0, row[2] or "")):
        if c is not None:
            convs.setdefault(c, []).append((r or "", x or ""))
    return convs


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        ends = sorted(c for c in members if len(convs[c]) == len(prefix))
        inner = {p[:-1] for p in nodes if p}
        out.append((
            min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
            sum(len(p) == len(prefix) + 1 for p in below), sum(p not in inner for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "x") for r in rows], SCHEMA)


def found(nodes):
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=str)


def random_rows(seed, convs, words=3, most=6):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), "é" * rng.randrange(words)) for c in rng.sample(range(-50, 10_000), convs) for t in range(rng.randrange(1, most + 1))]


@pytest.mark.parametrize(("run", "fan"), [(10_000, 32), (40, 2), (7, 3), (1, 2)])
def test_equals_brute_force_for_any_partitions(spark, monkeypatch, run, fan):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    monkeypatch.setattr(prefix_trie, "LEAST_RUN", 1 if run == 1 else 10_000)
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    rows = random_rows(run, 120)
    convs = told(rows)
    turnless = spark.createDataFrame([(99_999, None), (99_998, [])], "conv_id long, turns array<string>")
    nodes = prefix_trie.trie(prefix_trie.sequences(table(spark, rows)).unionByName(turnless))
    assert found(nodes) == brute(convs | {99_999: [], 99_998: []})


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (2, 0, None, ""), (2, 1, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "a"), (None, 0, "user", "a"), (4, 0, "us", "era"), (5, 0, "user", "x\ny,|é")]
    nodes = prefix_trie.prefix_trie(table(spark, rows))
    assert found(nodes) == brute(told(rows))
    last = {(r.conv_id, r.depth): (r.role, r.text) for r in nodes.collect()}
    assert last[1, 0] == (None, None) and last[1, 1] == ("", "") and last[1, 2] == ("user", "a") and last[4, 1] == ("us", "era") and last[5, 1] == ("user", "x\ny,|é")


def test_empty_table(spark):
    assert found(prefix_trie.prefix_trie(table(spark, []))) == []


def test_hot_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 100)
    monkeypatch.setattr(prefix_trie, "RUN", 5)
    monkeypatch.setattr(prefix_trie, "LEAST_RUN", 100)
    rows = [(c, t, "user", "same" * (t + 1)) for c in range(500) for t in range(3)]
    rows += [(1000 + c, t, "user", f"{t % 7}") for c in range(3) for t in range(300 - c)] + [(2000, 0, "user", "long" * 100_000)]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == brute(told(rows))


def test_large_ids_stay_exact(spark):
    rows = [(2**62 + c, 0, "user", str(c % 3)) for c in range(20)]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == brute(told(rows))


def test_shared_heads(spark):
    rows = random_rows(9, 60, 2, 12)
    convs = told(rows)
    want = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        want[c] = convs.get(head, [])[:h] + turns[h:]
    rebuilt = prefix_trie.with_shared_heads(prefix_trie.sequences(table(spark, rows)))
    assert any(not turns for turns in want.values())
    assert found(prefix_trie.trie(rebuilt)) == brute(want)
