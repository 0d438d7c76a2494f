import random

import pytest

from riskloom.llm import packing


def naive(histogram, sizes):
    """Pieces one by one, in falling order, each into the open sequence with the least room; sizes opened are not compared."""
    bins = []
    for l in sorted((l for l, n in histogram.items() for _ in range(n)), reverse=True):
        fits = [b for b in bins if b[0] >= l]
        if fits:
            min(fits, key=lambda b: b[0])[0] -= l
        else:
            bins.append([max(sizes) - l])
    return len(bins)


def placed(histogram, sizes):
    plan = packing.plan(histogram, sizes)
    content = {}
    for l, n in histogram.items():
        for rank in range(n):
            b, size, offset = (int(v[0]) for v in plan.place(packing.np.array([l]), packing.np.array([rank])))
            content.setdefault(b, (size, []))[1].append((offset, l))
    return content


@pytest.mark.parametrize("seed", range(12))
def test_every_piece_has_its_own_place(seed):
    rng = random.Random(seed)
    sizes = rng.choice([(16, 32, 64), (64,), (10, 25, 60, 100)])
    histogram = {l: rng.randint(0, 40) for l in rng.sample(range(1, max(sizes) + 1), rng.randint(1, max(sizes) // 2))}
    content = placed(histogram, sizes)
    assert sum(len(p) for _, p in content.values()) == sum(histogram.values())
    for size, pieces in content.values():
        at = 0
        for offset, l in sorted(pieces):  # without gap or overlap
            assert offset == at
            at += l
        assert at <= size and not any(at <= s < size for s in sizes)  # no smaller size would do
    assert sorted(content) == list(range(len(content)))


@pytest.mark.parametrize("seed", range(6))
def test_one_size_is_plain_best_fit(seed):
    rng = random.Random(seed)
    histogram = {l: rng.randint(1, 9) for l in rng.sample(range(1, 51), 20)}
    assert len(placed(histogram, (50,))) == naive(histogram, (50,))


def test_several_sizes_cost_no_more_than_the_largest_alone():
    histogram = {l: 3000 // l for l in range(1, 2001, 7)}
    total = lambda sizes: sum(packing.cost(size) for size, _ in placed(histogram, sizes).values())
    assert total((512, 1024, 2048)) <= total((2048,))


def test_awkward_lengths(spark):
    rows = [(1, 0), (2, None), (3, -5), (4, 4096), (5, 4097), (6, 10_000), (7, 1), (7, 1), (None, 3)] + [(100 + i, 600) for i in range(5000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long")).collect()
    sums = {}
    for r in out:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.n_tokens
        assert (r.bin_id is None) == (r.n_tokens == 0)
    assert [sums[i] for i in (1, 2, 3, 4, 5, 6, 7, None)] == [0, 0, 0, 4096, 4097, 10_000, 2, 3]
    assert len(out) == len(rows) + 1 + 2  # 4097 in two pieces, 10,000 in three
    spans = sorted((r.bin_id, r.bin_offset, r.bin_offset + r.n_tokens, r.bin_size) for r in out if r.n_tokens)
    assert all(e <= size for _, _, e, size in spans) and all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).collect() == []
