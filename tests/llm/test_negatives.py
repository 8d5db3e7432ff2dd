import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from berthline.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, ask long, c string"


def brute(rows, positives=5, many=10, window=(30, 90), scale=256):
    """rows: (id, vector, label); anchors are ids divisible by 100."""
    taking = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, own, label in {(i, tuple(v), y) for i, v, y in taking if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, y) for i, v, y in taking if i != a)
        for down, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(-s, i) for s, i, y in scored if y != label and window[0] * -down <= 100 * -s <= window[1] * -down]
            out += [(a, p, rank, i, -down, s) for rank, (s, i) in enumerate(fits[:many], 1)]
    return sorted(out)


def rows_of(seed, n, dims, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims)) / 4
    label = rng.integers(0, labels, n)
    vectors = (centres[label] + rng.normal(size=(n, dims)) / 6).astype(np.float32)
    return [(i * 10, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, label))]


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, "x", 1, "x") for i, v, y in rows], SCHEMA)
    found = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 7)
    monkeypatch.setattr(negatives, "STRIPE", 50)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 3)
    rows = rows_of(1, 400, 12)
    want = brute(rows)
    assert len(want) > 500 and mined(spark, rows) == want


def test_nulls_ties_repeats_lengths(spark):
    rows = rows_of(2, 60, 6)
    rows += [(rows[20][0], rows[20][1], rows[20][2]), (1001, rows[3][1], 0), (1002, rows[3][1], 0), (1003, rows[3][1], 1), (1005, rows[3][1][:4], 1), (1007, [], 2)]
    rows += [(None, rows[3][1], 1), (2000, None, 1), (2100, rows[3][1], None), (2200, [None] * 6, 1), (2300, [math.nan] * 6, 1), (2400, [math.inf] * 6, 1), (2500, [0.0] * 6, 3)]
    assert mined(spark, rows) == brute(rows)


def test_fewer_than_asked_and_other_windows(spark):
    rows = rows_of(3, 15, 5)
    assert mined(spark, rows, positives=20, negatives=3, window=(-50, 100)) == brute(rows, 20, 3, (-50, 100))


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(7, [1.0], 1), (8, [1.0], 2)]) == []


def test_residues_give_exact_products():
    rng = np.random.default_rng(5)
    for dims, most in ((3, 2), (64, 256), (2500, 256), (64, 20_000_000)):
        a, b = (rng.integers(-most, most + 1, (9, dims)) for _ in range(2))
        a[0], b[0], b[1] = most, most, -most
        primes = negatives.moduli(dims * most * most)
        assert math.prod(primes) > 2 * dims * most * most
        got = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
        assert (got == a @ b.T).all()


def test_scores_beyond_the_bound_are_refused(spark):
    with pytest.raises(ValueError, match="scores could reach"):
        mined(spark, [(100, [1e30], 1), (1, [1.0], 1)])
    assert len(negatives.moduli(negatives.MOST_SCORE)) <= len(negatives.PRIMES)
    assert math.prod(negatives.PRIMES) > 2 * negatives.MOST_SCORE
