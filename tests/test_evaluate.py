import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate, explain


def table(spark, rows):
    return spark.createDataFrame(rows, "is_vulnerable int, probability double").withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


@pytest.fixture(scope="module")
def scores(spark):
    return table(spark, [(int((i * 31) % 10 < 3), round(((i * 7919) % 97) / 97, 2)) for i in range(400)])


def test_auc_against_pairs(scores):
    rows = scores.collect()
    pos = [r.probability for r in rows if r.is_vulnerable]
    neg = [r.probability for r in rows if not r.is_vulnerable]
    expected = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(scores, digits=None).first()[0] == pytest.approx(expected)


def test_auc_with_a_third_of_rows_on_one_score(spark):
    rows = [(i % 2, 0.5) for i in range(300)] + [(1, 0.5 + i / 10_000) for i in range(300)] + [(0, i / 10_000) for i in range(300)]
    df = table(spark, rows)
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    expected = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df, digits=None).first()[0] == pytest.approx(expected)


def test_auc_of_one_class_is_null(spark):
    assert evaluate.roc_auc(table(spark, [(1, 0.2), (1, 0.7)])).first()[0] is None


def test_sweep_at_half_equals_metrics(scores):
    sweep = {r.step: r for r in evaluate.threshold_sweep(scores).collect()}
    direct = evaluate.metrics(scores, 6).first()
    assert len(sweep) == 91 and sweep[45].threshold == 0.5
    assert [sweep[45][k] for k in ("accuracy", "precision", "recall", "f1")] == [direct[k] for k in ("accuracy", "precision", "recall", "f1")]


def test_sweep_on_the_grid_itself(spark):
    grid = [0.05 + i * 0.9 / 90 for i in range(91)] + [0.0, 1.0, 0.0499999, 0.9500001]
    df = table(spark, [(i % 2, p) for i, p in enumerate(grid)])
    for row in evaluate.threshold_sweep(df).collect():
        t = 0.05 + row.step * 0.9 / 90
        right = sum((p >= t) == (i % 2 == 1) for i, p in enumerate(grid))
        assert row.accuracy == pytest.approx(right / len(grid), abs=1e-6)


def test_zero_division_gives_zero(spark):
    row = evaluate.metrics(table(spark, [(1, 0.1), (1, 0.2)])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("kind, inner", [("focal", "focal"), ("wce", "focal"), ("cb", "focal"), ("cb", "bce")])
def test_losses_against_plain_formulas(spark, kind, inner):
    rows = [(1, 2.0), (0, -3.0), (0, 0.5), (1, -800.0), (0, 4.0)]
    df = spark.createDataFrame(rows, "is_vulnerable int, logit double")
    n1, n0 = 2, 3
    w = {1: 1 / ((1 - 0.9999**n1) / (1 - 0.9999)), 0: 1 / ((1 - 0.9999**n0) / (1 - 0.9999))}
    values = []
    for y, x in rows:
        bce = max(x, 0) - x * y + math.log1p(math.exp(-abs(x)))
        p = 1 / (1 + math.exp(-x)) if x > -700 else 0.0
        pt = p if y else 1 - p
        focal = (0.25 if y else 0.75) * (1 - pt) ** 2 * bce
        values.append({"focal": focal, "wce": bce * (10 if y else 1), "cb": (focal if inner == "focal" else bce) * 2 * w[y] / (w[0] + w[1])}[kind])
    assert evaluate.loss(df, kind, inner=inner).first()[0] == pytest.approx(sum(values) / len(values))
    assert evaluate.loss(df, kind, inner=inner, reduction="sum").first()[0] == pytest.approx(sum(values))
    assert [r.loss for r in evaluate.loss(df, kind, inner=inner, reduction="none").collect()] == pytest.approx(values)


def test_unknown_loss_is_refused(spark):
    df = spark.createDataFrame([(1, 0.0)], "is_vulnerable int, logit double")
    for options in ({"kind": "other"}, {"kind": "cb", "inner": "other"}, {"kind": "focal", "reduction": "other"}):
        with pytest.raises(ValueError):
            evaluate.loss(df, **options)


def test_reasons_need_a_positive_contribution(spark):
    df = spark.createDataFrame([(0, 3.0, 0.0), (1, 0.0, 0.0)], "doc_id int, a double, b double")
    rows = explain.top_reasons(df, ["a", "b"], [1.0, -1.0], means=[1.0, 0.0]).orderBy("doc_id").collect()
    assert rows[0].reasons == ["a"] and rows[1].reasons == [explain.NO_REASON]


def test_scores_on_thresholds_reach_them(spark):
    import numpy as np
    from riskloom import fixed_values as fixed

    grid = np.linspace(0.05, 0.95, 91)
    assert tuple(grid.tolist()) == fixed.THRESHOLDS
    scores = [round(i / 1000, 3) for i in range(1001)] + grid.tolist() + np.nextafter(grid, 0).tolist()
    rows = spark.createDataFrame([(s, i % 2) for i, s in enumerate(scores)], "probability double, is_vulnerable int")
    sweep = {r.step: r.recall for r in evaluate.threshold_sweep(rows, digits=None).collect()}
    positive = np.array(scores)[1::2]
    assert sweep == {i: (positive >= t).sum() / len(positive) for i, t in enumerate(grid)}


def test_a_million_scores_in_a_narrow_interval(spark):
    """Running sums against closed forms; scores differ in their last bits only."""
    n = 1_000_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n).alias("i")).select(
        "i", (0.5 + F.col("i").cast("double") * 2.0**-50).alias("score"), (F.col("i") % 3 == 0).cast("long").alias("pos"), (F.col("i") % 3 != 0).cast("long").alias("neg"))
    table = evaluate.cumulative_counts(rows.select("score", "pos", "neg")).withColumn("i", F.round((F.col("score") - 0.5) * 2.0**50).cast("long"))
    # Multiples of three from i to n - 1.
    tp = F.lit((n - 1) // 3) - F.floor((F.col("i") - 1) / 3.0)
    wrong = table.filter((F.col("tp") != tp) | (F.col("fp") != F.lit(n) - F.col("i") - tp))
    assert table.count() == n and wrong.count() == 0


def test_ranges_follow_the_number_of_scores(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "RANGE_SCORES", 7)
    rows = [(i % 2, round(((i * 7919) % 101) / 101, 3)) for i in range(500)] + [(1, None), (0, None), (1, float("nan")), (0, 0.0), (1, -0.0)]
    df = table(spark, rows)
    scored = [(y, math.inf if p != p else p) for y, p in rows if p is not None]
    for r in evaluate.roc_curve(df).collect():
        t = math.inf if r.threshold != r.threshold else r.threshold
        assert r.tpr == pytest.approx(sum(y == 1 and p >= t for y, p in scored) / sum(y == 1 for y, _ in scored))
        assert r.fpr == pytest.approx(sum(y == 0 and p >= t for y, p in scored) / sum(y == 0 for y, _ in scored))
    assert evaluate.roc_curve(df).count() == len({p for _, p in scored})
    assert evaluate.cumulative_counts(evaluate.score_counts(table(spark, [(1, None)]).withColumn("probability", F.lit(None).cast("double")))).collect() == []
