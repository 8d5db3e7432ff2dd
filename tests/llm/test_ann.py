import numpy as np
import pytest

from berthline.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, asked, k):
    out = {}
    for q in asked:
        own = dict((i, v) for i, v in rows)[q]
        scores = sorted((-float(np.dot(np.array(own, dtype=float), np.array(v, dtype=float))), i) for i, v in rows if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 32))
    vectors = (centres[rng.integers(0, 8, 600)] + 0.7 * rng.normal(size=(600, 32))).astype(np.float32)
    out = [(i, v.tolist()) for i, v in enumerate(vectors)]
    return out + [(1000 + i, out[40][1]) for i in range(60)]


def test_without_radius_equals_brute_force(spark, rows):
    bad = [(2000, None, "x"), (2020, [0.0] * 32, "x"), (2040, [float("nan")] * 32, "x"), (2060, [None] * 32, "x"), (2080, [1.0] * 5, "x"), (2100, [], "x"), (None, [1.0] * 32, "x"), (2120, [float("inf")] * 32, "x")]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows] + bad + [(*rows[3], "y")], SCHEMA)
    asked = [i for i, _ in rows if i % 20 == 0]
    queries = df.filter("vec_id % 20 = 0").selectExpr("vec_id as query_id")
    got = found(ann.neighbours(df, queries, k=20, radius=64))
    want = brute(rows, asked, 20)
    assert set(got) == set(want)
    for q in asked:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-9)


def test_recall_with_calibrated_radius(spark, rows, monkeypatch):
    monkeypatch.setattr(ann, "ENTRY_BLOCK", 200)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    queries = df.filter("vec_id % 20 = 0").selectExpr("vec_id as query_id")
    got = found(ann.neighbours(df, queries, k=20))
    want = brute(rows, list(got), 20)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9 and all(len(x) == 20 for x in got.values())


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**63, 2000).astype(np.uint64)
    codes[100:200] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    index = ann.BlockIndex(codes)
    for code in codes[[0, 5, 150]]:
        for radius in (0, 3, 11, 24, 64):
            assert index.within(code, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [0.5, 0.5], "x"), (20, [-1.0, 0.0], "x")], SCHEMA)
    queries = df.filter("vec_id % 20 = 0").selectExpr("vec_id as query_id")
    assert found(ann.neighbours(df, queries, radius=0)) == {0: [(1, 0.5), (20, -1.0)], 20: [(1, -0.5), (0, -1.0)]}
    assert ann.neighbours(df.limit(0), queries.limit(0)).collect() == []
    assert ann.neighbours(df, queries.limit(0)).collect() == []
