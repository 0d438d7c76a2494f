import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import words

from riskloom.llm import arrays, jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """doc_id -> (n, component) by comparing all pairs that share a shingle."""
    sets = {}
    parent = {}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lists = defaultdict(list)
    for number, (doc_id, text) in enumerate(rows):
        sets[number] = shingle_set(text)
        parent[number] = number
        if doc_id is not None:
            for s in sets[number]:
                lists[s].append(number)
    for x in sets:
        if rows[x][0] is None:
            continue
        met = Counter(y for s in sets[x] for y in lists[s] if y < x)
        for y, n in met.items():
            if 100 * n >= 80 * (len(sets[x]) + len(sets[y]) - n):
                parent[find(x)] = find(y)
    least = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(x)] = min(least.get(find(x), doc_id), doc_id)
    return Counter((doc_id, len(sets[x]), least.get(find(x)) if doc_id is not None else None) for x, (doc_id, _) in enumerate(rows))


def found(docs):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())


def test_whole_table(small_documents):
    rows = [(r.doc_id, r.text) for r in small_documents.select("doc_id", "text").collect()]
    assert found(small_documents) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_families_at_the_threshold(documents, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 40, 120]))]
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    assert found(documents(rows)) == brute(rows)


def test_exactly_eighty_percent(documents):
    a = [f"a{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:-1])), (3, " ".join(a[:-2])), (4, " ".join(a[:12] + ["z"]))]
    # 1-2: 8 of 9; 1-3: 7 of 9; 2-3: 7 of 8; 1-4: 8 of 10, the threshold itself
    assert found(documents(rows)) == brute(rows)


def test_awkward_rows(documents, awkward):
    assert found(documents(awkward)) == brute(awkward)
    assert jaccard.near_duplicates(documents([])).collect() == []


def test_one_document_of_each_group_stays(documents, awkward):
    docs = documents(awkward)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {i for i, _, c in brute(awkward) if i == c} | {None}
    assert sorted(ids, key=str) == sorted(want, key=str)


def lists_table(rows):
    np, pa = jaccard.np, jaccard.pa
    short = [np.packbits(np.array(p, bool)).tobytes() for _, _, p in rows]
    return pa.table({"key": pa.array([k for k, _, _ in rows], pa.int64()), "cls": pa.array([c for _, c, _ in rows], pa.int64()), "n": pa.array([sum(p) for _, _, p in rows], pa.int64()), "short": pa.array(short, pa.binary())})


def across(monkeypatch, rows, placed):
    pa, calls, fits = jaccard.pa, [], jaccard._fits
    monkeypatch.setattr(jaccard, "_fits", lambda n, p, i, j: calls.append(len(i)) or fits(n, p, i, j))
    out = jaccard._across((), lists_table(rows), pa.table({"node": pa.array(list(placed), pa.int64()), "component": pa.array(list(placed.values()), pa.int64())}))
    return set(zip(out.column("a").to_pylist(), out.column("b").to_pylist())), calls


def test_pairs_across_components_as_plainly_found(monkeypatch):
    rng = random.Random(5)
    bases = [[rng.random() < 0.1 for _ in range(1024)] for _ in range(4)]
    sets = {c: [x ^ (rng.random() < 0.01) for x in rng.choice(bases)] for c in rng.sample(range(-500, 500), 60)}
    rows = [(key, c, sets[c]) for key in range(6) for c in rng.sample(sorted(sets), rng.choice([1, 2, 25, 40]))]
    placed = {c: rng.choice([1, 2, 3]) for c in sorted(sets)[::2]}
    want = set()
    for k, a, p in rows:
        for m, b, q in rows:
            least, total = sum(x != y for x, y in zip(p, q)), sum(p) + sum(q)
            near = 100 * min(sum(p), sum(q)) >= 80 * max(sum(p), sum(q)) and 180 * least <= 20 * total
            if k == m and a < b and placed.get(a, a) != placed.get(b, b) and near:
                want.add((a, b))
    got, calls = across(monkeypatch, rows, placed)
    assert got == want and want


def test_a_long_list_of_one_component_takes_few_steps(monkeypatch):
    shared = [i < 50 for i in range(1024)]
    rows = [(1, c, shared) for c in range(3000)] + [(2, c, shared) for c in range(3000)] + [(2, 5000, shared)]
    got, calls = across(monkeypatch, rows, {c: 0 for c in range(3000)})
    assert got == {(c, 5000) for c in range(3000)} and sum(calls) == 3000 and len(calls) < 5


def test_lists_of_the_same_sets_are_one(spark):
    rows = [(key, cls) for key in range(50) for cls in (1, 2)] + [(100, 1), (100, 2), (100, 3), (100, 3), (101, 3), (102, 2), (102, 3)]
    found = jaccard.different_lists(spark.createDataFrame(rows, "key long, cls long")).collect()
    members = {}
    for row in found:
        members.setdefault(row.key, []).append(row.cls)
    assert sorted(map(sorted, members.values())) == [[1, 2], [1, 2, 3], [2, 3]]


def test_texts_are_worked_on_in_small_pieces(monkeypatch):
    monkeypatch.setattr(arrays, "_POWERS", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    texts = pa.array([" ".join(f"w{i}" for i in range(500))] * 600)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for piece in arrays.slices(iter([batch]), "text", jaccard.TEXT_BYTES):
        jaccard.shingles(*arrays.text_bytes(piece.column(0)))
    assert sum(table.nbytes for table in arrays._POWERS.values()) <= 4 * 8 * jaccard.TEXT_BYTES


def test_lengths_are_counted_over_all_documents(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD", 50)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a b c d e", "f g h i j k l", "m n o p q", f"x{i} y z u v"]) for _ in range(4))) for i in range(300)] + [(None, "a b c d e")]
    lists = Counter(s for i, t in rows if i is not None for s in shingle_set(t))
    table, want = jaccard.list_lengths(documents(rows)), np.zeros(1 << jaccard.LENGTH_BITS, np.uint8)
    for s, n in lists.items():
        place = int(jaccard.shingles(*arrays.text_bytes(pa.array([" ".join(s)])))[0][0]) >> 64 - jaccard.LENGTH_BITS
        want[place] = max(want[place], round(8 * np.log2(n)))
    assert want.max() >= 50 and np.array_equal(table, want)
