import numpy as np
import pytest

from riskloom.llm import vptree


def brute(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in usable:
        if i % 20 == 0:
            scores = sorted(((-float(np.dot(v, w)), j) for j, w in usable if j != i and len(w) == len(v)))
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, shard int, dims string")


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == {q for q, v in want.items() if v}
    for q in got:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_factor_one_is_exact(spark, sf, shard_rows):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    usable = vptree.usable(table)
    index = vptree.build_index(usable, 20, shard_rows)
    same(result(vptree.nearest(usable.filter("id % 20 = 0"), index, 20, 1.0, block=10)), brute(rows, 20))


def test_recall_of_relaxed_pruning(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()], 20)
    got = result(vptree.search_all(table, factor=0.6))
    assert sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_awkward_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [
        (100, None), (101, []), (102, [0.0, 0.0]), (103, [None, 1.0]), (104, [float("nan"), 1.0]), (105, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (120, [5.0, -1.0, 2.0]), (121, [1.0, 1.0, 1.0]), (140, [1.0] * 4), (60, [-1.0, -2.0]), (61, [1e-20, 3.0]), (80, [3.0, 1.0]),
    ]
    same(result(vptree.search_all(frame(spark, rows))), brute(rows, 20))
    assert vptree.search_all(frame(spark, [])).collect() == []


def test_few_points_are_skipped_only_if_too_far():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, (300, 5)) for c in (-3, 0, 3)])
    tree = vptree.Tree.build(points)
    queries = rng.normal(0, 2, (40, 5))
    found, best = tree.search(queries, 7, 1.0)
    want = np.sort(((queries[:, None] - points[None]) ** 2).sum(2), 1)[:, :7]
    assert np.sort(best, 1) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("shape", ["signs", "one-hot", "integers"])
def test_thousands_of_ties_across_shards(spark, shape):
    """More different vectors at one distance than any query may return: the smallest ids must stay."""
    rng = np.random.default_rng(3)
    n = 3000
    values = {
        "signs": rng.choice([-1.0, 1.0], (n, 12)), "one-hot": np.eye(40)[rng.integers(0, 40, n)] * rng.integers(1, 3, (n, 1)), "integers": rng.integers(-2, 3, (n, 5)).astype(float),
    }[shape]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(n), values)]
    usable = vptree.usable(frame(spark, rows))
    index = vptree.build_index(usable, 20, 700)
    same(result(vptree.nearest(usable.filter("id % 20 = 0"), index, 20, 1.0, block=60)), brute(rows, 20))
