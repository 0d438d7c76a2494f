"""Hard negatives against a plain search, and the cover tree's invariants."""

import random
from math import floor

import numpy as np
import pytest

from riskloom.llm import hardneg

CLASHING = "vec_id long, embedding array<float>, label int, id long, v array<double>, row long, shard long, qid long, score long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, [1.0], 2, 3, 4, 5) for i, v, label in rows], CLASHING).repartition(3)


def plain(rows, every=50, low=50, high=95):
    kept = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = int(np.fmod(label + 1, 10)) if i % 7 == 0 else label
        kept.append((at, i, label, [floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, label, v in kept:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, k, m) for k, j, m, w in kept if len(w) == len(v))
        good = [(j, -s) for s, j, k, m in scored if m == label and k != at][:5]
        for positive, ps in good:
            fits = [(j, -s) for s, j, k, m in scored if m != label and low * ps <= -100 * s <= high * ps][:3]
            out += [(i, positive, n, j, ps, ns) for n, (j, ns) in enumerate(fits, 1)]
    return sorted(out)


def got(spark, rows, **options):
    found = hardneg.mine(hardneg.usable(table(spark, rows)), **options)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("shape", ["normal", "clusters", "signs", "norms"])
def test_agrees_with_a_plain_search(spark, shape, monkeypatch):
    monkeypatch.setattr(hardneg, "LEAF", 8)
    rng = np.random.default_rng(5)
    n, dims = 1500, 6
    base = rng.normal(size=(n, dims))
    if shape == "clusters":
        base = rng.normal(size=(12, dims))[rng.integers(0, 12, n)] + 0.05 * base
    if shape == "signs":
        base = np.sign(base)  # thousands of ties
    if shape == "norms":
        base = base * rng.exponential(2, size=(n, 1))
    rows = [(int(i), base[at].tolist(), int(rng.integers(0, 3))) for at, i in enumerate(rng.permutation(n))]
    expected = plain(rows)
    assert len(expected) > 100
    assert got(spark, rows, shard_cells=600) == expected


def test_awkward_rows(spark):
    rng = random.Random(4)
    v = lambda d=3: [rng.uniform(-1, 1) for _ in range(d)]
    rows = [(i, v(), i % 3) for i in range(120)] + [(200 + i, v(2), 1 + i % 2) for i in range(60)]
    rows += [(0, v(), 1), (50, v(), 2), (50, v(), 2), (-50, v(), 1), (-49, v(), -3)]  # repeated and negative ids
    rows += [(None, v(), 1), (1000, None, 1), (1050, v(), None), (1100, [1.0, None, 2.0], 1), (1150, [float("inf"), 1.0, 1.0], 1), (1200, [float("nan"), 1.0, 1.0], 0)]
    rows += [(1250, [], 1), (1251, [], 1), (1252, [], 2), (1300, [0.0, 0.0, 0.0], 1)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []
    assert got(spark, [(50, v(), 1)]) == []


def test_copies_of_one_vector(spark):
    rows = [(i, [0.5, -0.25], i % 2) for i in range(400)] + [(1000 + i, [0.25 + i / 4000, -0.25], i % 2) for i in range(100)]
    assert got(spark, rows, shard_cells=200) == plain(rows)


def test_busy_shards_are_copied(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "QUERIES_PER_TASK", 7)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(0, 3))) for i in range(1200)]
    assert got(spark, rows, shard_cells=800) == plain(rows)


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(7)
    points = rng.normal(size=(20, 5))[rng.integers(0, 20, 3000)] + 0.02 * rng.normal(size=(3000, 5))
    tree = hardneg.CoverTree.build(points)
    ordered = points[tree.order]
    assert sorted(tree.order.tolist()) == list(range(3000))
    children = {}
    for at, (centre, radius, low, high, parent, leaf) in enumerate(tree.nodes):
        inside = ordered[int(low) : int(high)]
        away = np.sqrt(((inside - ordered[int(centre)]) ** 2).sum(1))
        assert low <= centre < high and away.max() <= radius + 1e-12  # covering, with the node's own centre among its points
        children.setdefault(int(parent), []).append(at)
        assert leaf or at in {int(p) for p in tree.nodes[:, 4]}
    assert len(tree.nodes) > 20
    for parent, some in children.items():
        if parent < 0:
            continue
        centres = ordered[tree.nodes[some, 0].astype(int)]
        gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) + 1e9 * np.eye(len(some))
        assert gaps.min() > tree.nodes[parent, 1] / hardneg.BASE - 1e-9  # separation
        assert tree.nodes[some, 1].max() <= tree.nodes[parent, 1] / hardneg.BASE + 1e-9
        assert tree.nodes[some, 2].min() == tree.nodes[parent, 2] and tree.nodes[some, 3].max() == tree.nodes[parent, 3]


def test_bounds_hold():
    rng = np.random.default_rng(8)
    points = rng.integers(-50, 50, (200, 4))
    largest = int((points**2).sum(1).max())
    lifted = hardneg._lift(points, largest)
    queries = rng.integers(-80, 80, (30, 4)).astype(float)
    radius = hardneg._distances(lifted, lifted[0]).max()
    below, above = hardneg._bounds(queries, lifted[:1], np.array([radius]), largest)
    scores = queries @ points.T
    assert (scores >= below).all() and (scores <= above).all()
