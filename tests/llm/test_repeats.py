import hashlib
import random

import pytest

from riskloom.llm import repeats


def brute(rows):
    first = {}
    texts = [(repeats.NO_DOC if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for j in range(len(t) - 49):
            w = t[j : j + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - 49):
            if first[t[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((None if i == repeats.NO_DOC else i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, repeats.remove_repeats(docs).collect()), key=str)


def test_whole_table(small_documents):
    assert found(small_documents) == brute([(r.doc_id, r.text) for r in small_documents.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_periods_and_short_texts(documents, seed):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("ab") for _ in range(n)) for n in (30, 49, 50, 51, 80, 120)] + ["x" * 70, "xy" * 40, "é" * 40]
    rows = [(rng.randint(0, 60), "".join(rng.choice(pieces)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 8)))) for _ in range(60)]
    assert found(documents(rows)) == brute(rows)


def test_awkward_rows(documents, awkward):
    assert found(documents(awkward)) == brute(awkward)
    assert repeats.remove_repeats(documents([])).collect() == []
