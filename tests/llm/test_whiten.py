"""Whitening against fractions and numpy on small tables."""

import random
from fractions import Fraction
from math import floor, sqrt

import numpy as np
import pytest

from riskloom.llm import whiten

CLASHING = "vec_id long, embedding array<float>, label int, v array<double>, dims int, slot long, value string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, [1.0], 3, 4, "x", 5) for i, v in rows], CLASHING).repartition(3)


def plain(vectors):
    """n, deviations and the covariance by fractions, straight from the definition."""
    x = [[floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    deviations = [sum((n * row[d] - sums[d]) ** 2 for d in range(dims)) for row in x]
    middle = [[row[d] - Fraction(sums[d], n) for d in range(dims)] for row in x]
    covariance = [[float(sum(r[a] * r[b] for r in middle) / n) for b in range(dims)] for a in range(dims)]
    return n, deviations, np.array(covariance), np.array([[float(c) for c in r] for r in middle])


def check(found, vectors, components=32):
    n, deviations, v, centred = plain([e for _, e in vectors])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == n * min(components, v.shape[0])
    for at, (vec_id, _) in enumerate(vectors):
        for c, r in by_row[vec_id].items():
            assert r.n == n and r.deviation == deviations[at] and int(r.deviation_wide) == deviations[at]
            assert r.explained == pytest.approx(max(values[c - 1], 0) / np.trace(v), rel=1e-9, abs=1e-12)
            expected = centred[at] @ axes[:, c - 1] / sqrt(values[c - 1])
            assert abs(abs(r.whitened) - abs(expected)) < 1e-6
    assert all(r.identity_error < 1e-9 for r in found)


def test_agrees_with_fractions(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1 + d) for d in range(5)]) for i in range(200)]
    check(whiten.whitened(table(spark, rows)).collect(), rows)


def test_components_are_numbered_by_falling_eigenvalue_and_limited(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 40 - d) for d in range(40)]) for i in range(300)]
    found = whiten.whitened(table(spark, rows)).collect()
    check(found, rows)
    shares = [r.explained for r in sorted(found, key=lambda r: (r.vec_id, r.component))[:32]]
    assert shares == sorted(shares, reverse=True) and len(shares) == 32


def test_unusable_vectors_other_lengths_and_repeats(spark):
    rng = random.Random(3)
    good = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(50)]
    short = [(100 + i, [rng.uniform(-1, 1) for _ in range(2)]) for i in range(20)]
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan"), 1.0, 2.0]), (903, [1.0, float("inf"), 2.0]), (904, [])]
    found = whiten.whitened(table(spark, good + short + bad)).collect()
    check([r for r in found if r.dims == 3], good)
    check([r for r in found if r.dims == 2], short)
    assert {r.vec_id for r in found} == {i for i, _ in good + short}
    twice = whiten.whitened(table(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (7, [3.0, 1.0]), (8, [0.0, 5.0])])).collect()
    assert len(twice) == 8 and sum(r.vec_id is None for r in twice) == 4 and {r.n for r in twice} == {4}


def test_components_without_variance_have_no_scale(spark):
    found = whiten.whitened(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [(r.component, r.whitened is None) for r in sorted(found, key=lambda r: (r.vec_id, r.component))] == [(1, False), (2, True)] * 2
    assert {abs(r.whitened) for r in found if r.whitened is not None} == {1.0}
    one = whiten.whitened(table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.deviation, r.explained, r.identity_error) for r in one] == [(None, 0, 0.0, None)] * 2
    assert whiten.whitened(table(spark, [])).collect() == []


def test_deviation_beyond_a_long_is_kept_wide(spark):
    rows = [(i, [1e8 * (i % 2), float(i)]) for i in range(1000)]
    found = whiten.whitened(table(spark, rows)).collect()
    _, deviations, _, _ = plain([v for _, v in rows])
    for r in found:
        assert int(r.deviation_wide) == deviations[r.vec_id]
        assert r.deviation == (deviations[r.vec_id] if deviations[r.vec_id] < 2**63 else None)


def test_limbs_are_exact():
    rng = np.random.default_rng(0)
    values = rng.integers(-(2**50), 2**50, (40, 7))
    high, middle, low = whiten.squares(values, 0)
    assert whiten._exact(high, middle, low).tolist() == [sum(int(v) ** 2 for v in column) for column in values.T]


def test_whole_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    check(whiten.whitened(vectors).collect(), rows)
