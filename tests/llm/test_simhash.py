import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from berthline.llm import simhash


def brute_print(text, k=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, max_bits):
    root = list(range(len(codes)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= max_bits:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(codes))]


def brute(rows, max_bits=4, k=4):
    prints = [brute_print(t, k) for _, t in rows]
    codes = sorted(set(prints))
    comp = dict(zip(codes, brute_components(codes, max_bits)))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    return sorted(((i, p, least.get(comp[p])) for (i, _), p in zip(rows, prints)), key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.near_duplicates(df, **more)
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"wörd{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = rng.choice(vocab, rng.integers(1, 60)).tolist()
        rows.append((i, " ".join(words)))
    long = rng.choice(vocab, 900).tolist()
    for i in range(120, 160):
        words = list(long)
        for at in rng.integers(0, 900, i % 5):
            words[at] = "changed"
        rows.append((i, "\n".join(words).upper() if i % 7 == 0 else "\t ".join(words)))
    rows += [(500, None), (501, ""), (502, " \n "), (None, "alone here"), (None, None), (3, rows[3][1]), (3, rows[3][1])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(rows) - 40


@pytest.mark.parametrize("group_rows", [2, 5])
def test_hot_groups_are_dealt_and_lose_nothing(spark, monkeypatch, group_rows):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    codes = {base}
    while len(codes) < 60:
        code = base
        for bit in rng.integers(0, 64, 6):
            code ^= 1 << int(bit)
        codes.add(code)
    codes = sorted(codes | {int(x) for x in rng.integers(0, 2**63, 30)})
    signed = [(c - 2**64 if c >> 63 else c,) for c in codes]
    roots = {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), 4)).collect()}
    found = {}
    for c in codes:
        found.setdefault(roots.get(c, c), set()).add(c)
    expected = {}
    for c, r in zip(codes, brute_components(codes, 4)):
        expected.setdefault(r, set()).add(c)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_tree_prunes_and_links_like_all_pairs():
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**63, 12)
    codes = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(60):
            x = c
            for bit in rng.integers(0, 64, rng.integers(1, 8)):
                x ^= 1 << int(bit)
            codes.add(x)

    def rank(x):
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> s
        return x

    codes = sorted(codes, key=rank)
    place = simhash.linked(np.array(codes, dtype=np.uint64), 4)
    assert place.tolist() == brute_components(codes, 4)


def test_long_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(1, 400)] + [(1000, 1001)]
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {roots[i] for i in range(1, 401)} == {1} and roots[1001] == 1000


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d e", 9, 9)], "doc_id long, text string, fp long, root long")
    assert simhash.near_duplicates(df).columns == ["doc_id", "fp", "root", "component_id"]
    shingle = F.xxhash64(F.lit("a b c d"))
    one = simhash.near_duplicates(df.withColumn("text", F.lit("A b\tc D"))).first()
    assert one.fp == df.select(shingle).first()[0]


def test_one_of_each_keeps_columns_of_any_name(spark):
    names = ["dropped", "_id", "_none", "_hash", "fp", "root", "times", "first", "row", "a.b"]
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, ""), (None, "z y x w"), (None, "z y x w"), (5, "q r s t"), (5, "q r s t"), (6, "word " * 200_000)]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 5, 6] and all(tuple(r)[2:] == tuple(range(len(names))) for r in kept)
