import random

from berthline.llm import packing, simhash


def plain_best_fit(sizes, sources, clusters, capacity):
    """Every bin looked at for every piece."""
    count = lambda values, v: values.count(v) > 1
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], packing._bits(clusters)[0][i], i))
    free, held, bins = [], [], [0] * len(sizes)
    for i in order:
        marks = {("s", sources[i])} if sources[i] is not None and count(sources, sources[i]) else set()
        marks |= {("c", clusters[i])} if clusters[i] is not None and count(clusters, clusters[i]) else set()
        fits = [(free[b], b) for b in range(len(free)) if free[b] >= sizes[i] and not held[b] & marks]
        if fits:
            b = min(fits)[1]
        else:
            b = len(free)
            free.append(capacity)
            held.append(set())
        free[b] -= sizes[i]
        held[b] |= marks
        bins[i] = b
    return bins


def test_successor_search_finds_the_tightest_compatible_bin():
    rng = random.Random(6)
    for case in range(40):
        n = rng.randint(1, 120)
        sizes = [rng.choice([0, rng.randint(1, 100), 50]) for _ in range(n)]
        sources = [rng.choice(["hot", "hot", "hot", None, *map(str, range(case % 9 + 1))]) for _ in range(n)]
        clusters = [rng.choice(["copy", None, *map(str, range(40))]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_whole_table(spark):
    rng = random.Random(7)
    rows = [(i, "é" * rng.choice([1, 30, 300, 2000]), rng.choice(["a", "a", f"s{i % 7}", None])) for i in range(300)]
    rows += [(900 + i, "copy of one text", f"s{i % 7}") for i in range(30)] + [(950, None, "a"), (951, "", None), (None, "x", "a"), (3, rows[3][1], "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = packing.pack(df, capacity=512, window_rows=100).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_bytes
    want = {}
    for i, text, _ in rows:
        want[i] = want.get(i, 0) + len((text or "").encode())
    assert total == want
    full, held = {}, {}
    texts = {i: t for i, t, _ in rows}
    for r in got:
        full[r.bin] = full.get(r.bin, 0) + r.n_bytes
        if r.source is not None:
            assert ("s", r.source) not in held.setdefault(r.bin, set())
            held[r.bin].add(("s", r.source))
        if texts[r.doc_id] == "copy of one text":
            assert "copy" not in held.setdefault(r.bin, set())
            held[r.bin].add("copy")
    assert max(full.values()) <= 512
    assert {r.piece for r in got if r.doc_id == next(i for i, t, _ in rows if len(t or "") == 2000)} == set(range(8))
    assert packing.pack(df.limit(0)).collect() == []


def by_bin(rows):
    held = {}
    for r in rows:
        held.setdefault(r.bin, []).append(r)
    return held


def test_bins_do_not_depend_on_the_layout(spark):
    rng = random.Random(8)
    rows = [(i, f"{i} " + "x" * rng.randint(80, 120), f"s{i % 4}") for i in range(200)] + [(5, "same", "s1")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # A partition for each source: none has a row of another source to fill its bins.
    layouts = [df.repartitionByRange(4, "source"), df.coalesce(1), df.repartition(40)]
    got = [sorted(map(tuple, packing.pack(d, capacity=512).collect())) for d in layouts]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
    assert len({r[3] for r in got[0]}) <= 60


def test_open_bins_of_all_groups_are_packed_again(spark):
    rng = random.Random(9)
    rows = [(i, f"{i} " + "x" * rng.randint(10, 300), f"s{i % 9}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(30)
    whole = by_bin(packing.pack(df, capacity=512).collect())
    small = by_bin(packing.pack(df, capacity=512, window_rows=25).collect())
    assert sum(map(len, small.values())) == len(rows)
    assert all(sum(r.n_bytes for r in b) <= 512 and len({r.source for r in b}) == len(b) for b in small.values())
    assert len(small) <= 1.1 * len(whole)


def test_near_copies_are_not_packed_together(spark):
    words = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(words[:399] + [f"end{i}"]), f"s{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    linked = simhash.near_duplicates(df)
    of = {r.doc_id: r.component_id for r in linked.collect()}
    assert len(set(of.values())) < 6
    for b in by_bin(packing.pack(df, capacity=1 << 20, near_copies=True).collect()).values():
        assert len({of[r.doc_id] for r in b}) == len(b)
