"""Binary-classification metrics, curves and threshold choice.

Scores are counted per distinct value or per threshold bucket first; rows never meet thresholds,
and no window runs over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import risk
from riskloom.operators.weighting import class_sizes
from riskloom.session import staged

RANGE_SCORES = 100_000  # distinct scores that one task runs over


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "is_vulnerable", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    counts = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    return df.groupBy(*by).agg(*[F.count_if(test).alias(name) for name, test in counts.items()])


def confusion_matrix(df: DataFrame, **columns: str) -> DataFrame:
    c = confusion(df, **columns)
    return c.select(F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"))


def _over(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def with_metrics(counts: DataFrame, digits: int | None = 4) -> DataFrame:
    """Accuracy, precision, recall and F1 from tn/fp/fn/tp; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    values = {
        "accuracy": _over(tp + tn, tn + fp + fn + tp),
        "precision": _over(tp, tp + fp),
        "recall": _over(tp, tp + fn),
        "f1": _over(2 * tp, 2 * tp + fp + fn),
    }
    return counts.withColumns({k: F.round(v, digits) if digits is not None else v for k, v in values.items()})


def metrics(df: DataFrame, digits: int | None = 4, **columns: str) -> DataFrame:
    return with_metrics(confusion(df, **columns), digits)


def segment_metrics(df: DataFrame, segment: str, digits: int | None = 4, **columns: str) -> DataFrame:
    counted = with_metrics(confusion(df, [segment], **columns), digits)
    return counted.select(segment, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("records"), "accuracy", "precision", "recall", "f1")


def score_counts(df: DataFrame, score: str = "probability", label: str = "is_vulnerable") -> DataFrame:
    """Rows of each class for each distinct score. Rows without a score are on no curve; NaN is above all numbers, and -0.0 is 0.0."""
    return df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def cumulative_counts(scores: DataFrame) -> DataFrame:
    """(score, pos, neg, tp, fp): counts at or above each distinct score.

    A prefix scan: distinct scores are dealt out by ranges, as many as their number asks for; ranges are summed, a running sum over the
    ranges gives what lies above each, and inside the ranges running sums go on from there. The ranges are written, because their limits
    are sampled and would differ from one reading to the next.
    """
    counted = staged(scores, "scores")
    ranges = max(1, -(-counted.count() // RANGE_SCORES))
    ranged = staged(counted.repartitionByRange(ranges, F.desc("score")).withColumn("_range", F.spark_partition_id()), "score-ranges")
    totals = ranged.groupBy("_range").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = totals.select(
        "_range", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p0"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0")
    )
    running = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(offsets, "_range").select(
        "score", "pos", "neg",
        (F.sum("pos").over(running) + F.col("_p0")).alias("tp"),
        (F.sum("neg").over(running) + F.col("_n0")).alias("fp"),
    )


def roc_auc(df: DataFrame, score: str = "probability", label: str = "is_vulnerable", digits: int | None = 4) -> DataFrame:
    """Area under the ROC curve; equal scores share their rank. Null if a class is missing."""
    table = cumulative_counts(score_counts(df, score, label))
    wins = F.col("neg").cast("double") * (2 * (F.col("tp") - F.col("pos")) + F.col("pos"))
    area = F.sum(wins) / F.nullif(2.0 * F.sum("pos") * F.sum("neg"), F.lit(0.0))
    return table.agg((F.round(area, digits) if digits is not None else area).alias("roc_auc"))


def roc_curve(df: DataFrame, score: str = "probability", label: str = "is_vulnerable") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, highest first, without the origin."""
    n0, n1 = class_sizes(df.filter(F.col(score).isNotNull()), label)
    table = cumulative_counts(score_counts(df, score, label))
    return table.select(F.col("score").alias("threshold"), _over(F.col("fp"), n0).alias("fpr"), _over(F.col("tp"), n1).alias("tpr"))


def precision_recall_curve(df: DataFrame, score: str = "probability", label: str = "is_vulnerable") -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    _, n1 = class_sizes(df.filter(F.col(score).isNotNull()), label)
    table = cumulative_counts(score_counts(df, score, label))
    return table.select(
        F.col("score").alias("threshold"), _over(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _over(F.col("tp"), n1).alias("recall")
    )


def class_report(df: DataFrame, digits: int | None = 4, **columns: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages and accuracy."""
    c = confusion(df, **columns)
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    rows = []
    for name, hit, wrong, missed in (("0", tn, fn, fp), ("1", tp, fp, fn)):
        rows.append((name, _over(hit, hit + wrong), _over(hit, hit + missed), _over(2 * hit, 2 * hit + wrong + missed), hit + missed))
    total = tn + fp + fn + tp
    accuracy = _over(tn + tp, total)
    macro = [(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)]
    weighted = [_over(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4], total) for i in (1, 2, 3)]
    rows += [("accuracy", accuracy, accuracy, accuracy, total), ("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    keep = lambda v: F.round(v, digits) if digits is not None else v
    entries = [
        F.struct(F.lit(n).alias("class"), keep(p).alias("precision"), keep(r).alias("recall"), keep(f).alias("f1"), s.alias("support"))
        for n, p, r, f, s in rows
    ]
    return c.select(F.inline(F.array(*entries)))


def threshold_value(step: Column) -> Column:
    """The fixed threshold of a step; null outside the grid."""
    return F.get(F.array(*[F.lit(t) for t in fixed.THRESHOLDS]), step.cast("int"))


def threshold_sweep(df: DataFrame, score: str = "probability", label: str = "is_vulnerable", digits: int | None = 6) -> DataFrame:
    """Metrics at each of the 91 thresholds.

    A row is counted once, in the bucket of the highest threshold it reaches; running sums over
    the at most 92 buckets give the counts at each threshold.
    """
    steps = len(fixed.THRESHOLDS) - 1
    low, high = fixed.THRESHOLDS[0], fixed.THRESHOLDS[-1]
    guess = F.floor((F.col(score) - low) * F.lit(steps / (high - low)))
    # The grid is even only up to the last digits, so the guess is compared with both neighbours.
    reached = F.when(threshold_value(guess + 1) <= F.col(score), guess + 1).when(threshold_value(guess) > F.col(score), guess - 1).otherwise(guess)
    bucket = F.greatest(F.lit(-1).cast("bigint"), F.least(reached, F.lit(steps).cast("bigint")))
    counted = df.select(bucket.alias("step"), F.col(label).alias("_y")).groupBy("step").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")
    )
    grid = df.sparkSession.range(-1, steps + 1, 1, 1).withColumnRenamed("id", "step")
    filled = grid.join(counted, "step", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = filled.withColumns(
        {
            "tp": F.sum("pos").over(above), "fp": F.sum("neg").over(above),
            "_p": F.sum("pos").over(everything), "_n": F.sum("neg").over(everything),
        }
    )
    counts = sums.filter("step >= 0").withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    return with_metrics(counts, digits).select(
        F.col("step").cast("int").alias("step"), F.round(threshold_value(F.col("step")), 4).alias("threshold"), "accuracy", "precision", "recall", "f1"
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("accuracy"), F.desc("f1"), F.desc("precision"), "step").limit(1)


def target_check(measured: DataFrame, minimum: float = fixed.MIN_ACCURACY) -> DataFrame:
    return measured.withColumns({"minimum_accuracy": F.lit(minimum), "meets_target": F.col("accuracy") >= minimum})


def loss(
    df: DataFrame, kind: str, logit: str = "logit", label: str = "is_vulnerable", reduction: str = "mean", *,
    alpha: float = 0.25, gamma: float = 2.0, weight_positive: float = 10.0, weight_negative: float = 1.0,
    beta: float = 0.9999, inner: str = "focal",
) -> DataFrame:
    """Focal, weighted or class-balanced loss of a scored table; one row, or per row with ``none``."""
    y, x = F.col(label).cast("double"), F.col(logit)
    if kind == "focal":
        value = risk.focal_loss(y, x, alpha, gamma)
    elif kind == "wce":
        value = risk.weighted_cross_entropy(y, x, weight_positive, weight_negative)
    elif kind == "cb":
        if inner not in ("focal", "bce"):
            raise ValueError(f"unknown inner loss: {inner}")
        base = risk.focal_loss(y, x, alpha, gamma) if inner == "focal" else risk.cross_entropy(y, x)
        n0, n1 = class_sizes(df, label)
        w0, w1 = 1 / risk.effective_number(n0, beta), 1 / risk.effective_number(n1, beta)
        value = base * F.when(F.col(label) == 1, 2 * w1 / (w0 + w1)).otherwise(2 * w0 / (w0 + w1))
    else:
        raise ValueError(f"unknown loss: {kind}")
    if reduction == "none":
        return df.withColumn("loss", value)
    if reduction not in ("mean", "sum"):
        raise ValueError(f"unknown reduction: {reduction}")
    return df.agg((F.avg(value) if reduction == "mean" else F.sum(value)).alias("loss"))


def metric_rows(report: DataFrame, names: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """A one-row report as (metric, value) rows."""
    return report.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])))


def compare_runs(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Difference of two (metric, value) tables in percentage points."""
    joined = current.withColumnRenamed("value", "current").join(previous.withColumnRenamed("value", "previous"), "metric")
    return joined.withColumn("delta_points", F.round((F.col("current") - F.col("previous")) * 100, 2))
