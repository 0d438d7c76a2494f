import zlib

import numpy as np
import pytest

from riskloom.llm import quality, toxicity

GOOD = "This is a plain sentence with common words about the weather and the town. It goes on for a while, and it ends here."
JUNK = ["BUY!! NOW!! CHEAP!! PILLS!! HERE!! CLICK!!", "word%%% other### thing$$$ that*** all&&& ends###", "spam spam spam spam spam spam spam spam spam", "a | b | c | d | e | f | g | h"]


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    pos = label.sum()
    return (order[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos))


@pytest.mark.parametrize("operator, column, least", [(quality.quality_scores, "quality", 0.9), (toxicity.toxicity_scores, "toxic", 0.8)])
def test_held_out_order(spark, operator, column, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = operator(docs, labels).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    folds, held = (3, 1) if column == "quality" else (5, 0)
    assert (out.held_out == [zlib.crc32(str(i).encode()) % folds == held for i in out.doc_id]).all()
    known = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert auc(known.score.to_numpy(), known[column].to_numpy()) > least
    assert (known.predicted == known[column]).mean() > max(known[column].mean(), 1 - known[column].mean())


@pytest.mark.parametrize("operator", [quality.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_and_no_labels(spark, documents, awkward, operator):
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0), (4, 0, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    out = operator(documents(awkward), labels).collect()
    assert len(out) == len(awkward) and all(0 <= r.score <= 1 for r in out)
    assert operator(documents([]), labels).collect() == []
    none = operator(documents(awkward), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_held_out_labels_have_no_influence(spark, documents):
    rows = [(i, GOOD + f" number {i}") if i % 5 else (i, JUNK[i // 5 % 4] + f" {i}") for i in range(300)]
    label = [(i, int(i % 5 > 0), int(i % 5 == 0)) for i, _ in rows]
    for operator, folds, held in ((quality.quality_scores, 3, 1), (toxicity.toxicity_scores, 5, 0)):
        turned = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % folds == held else (i, q, t) for i, q, t in label]
        scores = [{r.doc_id: r.score for r in operator(documents(rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (label, turned)]
        assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_filter_agrees_with_scores(spark, documents):
    rows = [(i, GOOD + f" number {i}") if i % 5 else (i, JUNK[i // 5 % 4] + f" {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good
    assert good == {i for i, _ in rows if i % 5}


def test_risk_falls_to_its_least(spark):
    """No weights near the fitted ones have a lower non-negative unbiased risk, written plainly."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(1, 1, (400, 25)), rng.normal(-1, 1, (200, 25))]).astype(np.float32)
    positive = np.arange(600) < 150
    table = spark.createDataFrame([(r.tolist(), bool(p)) for r, p in zip(x, positive)], "x array<float>, positive boolean")
    model = quality.fit(table, ridge=1e-3)
    design = model.design(x.astype(np.float64))

    def risk(w):
        z = design @ w
        right, wrong = np.logaddexp(0, -z), np.logaddexp(0, z)  # l(z) and l(-z)
        negative = wrong.mean() - model.prior * wrong[positive].mean()
        return model.prior * right[positive].mean() + max(0.0, negative) + 1e-3 * (w[:-1] ** 2).sum() / 2

    least = risk(model.weights)
    assert all(risk(model.weights + rng.normal(0, size, len(model.weights))) > least - 5e-3 for size in (0.01, 0.1, 0.5) for _ in range(200))
    assert 0.5 < model.prior < 0.8  # the true share is 2 / 3; few positives make it an underestimate
    assert ((design @ model.weights > 0) == (np.arange(600) < 400)).mean() > 0.95


def test_ngrams_against_plain_ones():
    texts = ["Moron!", "", "ab", "x y\tz  moron"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    pairs = set()
    for (hashed, doc), n in zip(toxicity.buckets(data, offsets), toxicity.SIZES):
        want = [(d, t.lower().replace("\t", " ")[i : i + n]) for d, t in enumerate(texts) for i in range(len(t) - n + 1)]
        assert doc.tolist() == [d for d, _ in want]
        pairs |= {(g, h) for (_, g), h in zip(want, hashed.tolist())}
    assert len({g for g, _ in pairs}) == len(pairs)  # equal n-grams, equal buckets
