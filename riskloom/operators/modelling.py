"""Training, search, comparison and batch scoring on Spark ML."""

from __future__ import annotations

import itertools
import random
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.operators import evaluate, weighting
from riskloom.operators.sampling import folds
from riskloom.operators.vectorise import feature_pipeline
from riskloom.session import staged

LABEL, WEIGHT = "is_vulnerable", "weight"
MAX_TREE_DEPTH = 30


def logistic(**params) -> LogisticRegression:
    """Elastic-net logistic model; weights come from the ``weight`` column. The penalty acts on the columns as they are, unscaled."""
    base = {"regParam": 1e-4, "elasticNetParam": 0.15, "maxIter": 100, "standardization": False}
    return LogisticRegression(labelCol=LABEL, weightCol=WEIGHT, **{**base, **params})


def forest(**params) -> RandomForestClassifier:
    """Random forest; Spark grows trees to depth 30 at most."""
    base = {"numTrees": 600, "maxDepth": MAX_TREE_DEPTH, "featureSubsetStrategy": "sqrt", "seed": 42, "maxMemoryInMB": 512}
    return RandomForestClassifier(labelCol=LABEL, weightCol=WEIGHT, **{**base, **params})


def boosted(**params) -> GBTClassifier:
    base = {"maxIter": 180, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
    return GBTClassifier(labelCol=LABEL, weightCol=WEIGHT, **{**base, **params})


def boosted_early_stop(validation: str = "is_valid", **params) -> GBTClassifier:
    """Boosting that stops when the rows marked in ``validation`` no longer improve."""
    base = {"maxIter": 1000, "maxDepth": 12, "stepSize": 0.05, "subsamplingRate": 0.8, "validationTol": 0.01}
    return boosted(validationIndicatorCol=validation, **{**base, **params})


def linear_svc(**params) -> LinearSVC:
    """Support-vector classifier with a linear kernel."""
    return LinearSVC(labelCol=LABEL, weightCol=WEIGHT, **{"regParam": 1.0, "maxIter": 100, **params})


def model_pipeline(classifier: Estimator, buckets: int = 2**18, **options) -> Pipeline:
    """A classifier behind the features of hashed text; options as ``feature_pipeline`` takes them."""
    return Pipeline(stages=[*feature_pipeline(buckets, **options).getStages(), classifier])


def fixed_logistic(spark: SparkSession, coefficients: Sequence[float], intercept: float = 0.0, features: str = "features") -> LogisticRegressionModel:
    """A logistic model of given coefficients, to score with weights that were fitted elsewhere. It can be saved like a fitted one."""
    vector = _py2java(spark.sparkContext, Vectors.dense([float(c) for c in coefficients]))
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(f"LogisticRegression_{uuid.uuid4().hex[:12]}", vector, float(intercept))
    return LogisticRegressionModel(made).setFeaturesCol(features)


# Pieces of a scan that one task of a fit takes at most, once there are PARTS_PER_CORE of them for each core.
PIECES_PER_PART, PARTS_PER_CORE = 8, 4


def fit_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read in few parts.

    Each part of a tree fit sends statistics of all features for a node, and one task adds up a node's: with a part for each piece of
    the scan, that task would read as many of them as there are pieces.
    """
    table = staged(df, name)
    least = PARTS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return table.coalesce(max(least, -(-table.rdd.getNumPartitions() // PIECES_PER_PART)))


def fit(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit the feature stages, write the vectors once, then run the iterative fit on that table.

    Each pass of an optimiser then reads a plain scan: no text is tokenised twice, and a lost
    executor costs a re-read instead of a recomputation.
    """
    *before, classifier = pipeline.getStages()
    if not before:
        return pipeline.fit(df)
    features = Pipeline(stages=before).fit(df)
    wanted = [LABEL, WEIGHT, "features", *(c for c in ("is_valid", "fold") if c in df.columns)]
    transformed = features.transform(df)
    vectors = fit_table(transformed.select(*[c for c in wanted if c in transformed.columns]), "vectors")
    return PipelineModel([*features.stages, classifier.fit(vectors)])


def probability_of(scored: DataFrame) -> Column:
    """Probability of class 1; for margins without one, the sigmoid of the margin."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    return 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))


def score(model: Transformer, df: DataFrame, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    """Add ``probability`` and the ``prediction`` at a threshold; the input columns stay."""
    keep = [c for c in df.columns if c not in ("probability", "prediction")]
    scored = model.transform(df.select(*keep))
    return scored.select(*keep, probability_of(scored).alias("probability")).withColumn(
        "prediction", (F.col("probability") >= threshold).cast("int")
    )


def report(scored: DataFrame, digits: int = 4) -> DataFrame:
    """One row with accuracy, precision, recall, F1, AUC and the confusion counts.

    The scores are written first: the curve reads them several times, and scoring is costly.
    """
    scored = staged(scored.select(LABEL, "probability", "prediction"), "scores")
    auc = evaluate.roc_auc(scored, digits=digits).scalar()
    return evaluate.metrics(scored, digits).withColumn("roc_auc", auc)


def parameter_draws(grid: Mapping[str, Sequence], draws: int = 10, seed: int = 42) -> list[dict]:
    """Random draws without repetition from a parameter grid."""
    every = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(every, min(draws, len(every)))


def fold_vectors(estimator: Pipeline, df: DataFrame, key: str, k: int = 5, seed: int = 42) -> list[DataFrame]:
    """For each hash fold, a written table of all rows' vectors by features that were fitted on the other folds.

    Classifiers of any parameters read these tables, so a text is tokenised once for each fold however many are tried.
    """
    before = estimator.getStages()[:-1]
    folded = folds(df, key, k, seed)
    wanted = [LABEL, WEIGHT, "features", "fold"]
    tables = []
    for i in range(k):
        features = Pipeline(stages=before).fit(folded.filter(F.col("fold") != i)) if before else None
        vectors = features.transform(folded) if features else folded
        tables.append(fit_table(vectors.select(*[c for c in wanted if c in vectors.columns]), "fold-vectors"))
    return tables


@dataclass(frozen=True)
class Search:
    """The model of the best draw, fitted on all rows, its parameters, and the mean F1 of each draw."""

    bestModel: PipelineModel
    params: dict
    avgMetrics: list[float]


def random_search(
    estimator: Pipeline, train: DataFrame, grid: Mapping[str, Sequence], key: str, draws: int = 10, k: int = 3, seed: int = 42, parallelism: int = 4,
    cache: list[DataFrame] | None = None,
) -> Search:
    """Random hyper-parameter search scored by F1 over hash folds; ``grid`` names parameters of the last stage.

    Features are fitted once for each fold, or taken from ``cache`` (``fold_vectors``); only the classifier is searched.
    """
    *before, classifier = estimator.getStages()
    tables = cache or fold_vectors(estimator, train, key, k, seed)
    drawn = parameter_draws(grid, draws, seed)

    def measured(task: tuple[int, int]) -> float:
        draw, i = task
        candidate = classifier.copy({classifier.getParam(name): value for name, value in drawn[draw].items()})
        model = candidate.fit(tables[i].filter(F.col("fold") != i))
        return evaluate.metrics(score(model, tables[i].filter(F.col("fold") == i)), None).first()["f1"]

    with ThreadPool(parallelism) as pool:  # fits wait for their jobs; the cluster shares itself between them
        found = pool.map(measured, [(d, i) for d in range(len(drawn)) for i in range(len(tables))])
    means = [sum(found[d * len(tables) : (d + 1) * len(tables)]) / len(tables) for d in range(len(drawn))]
    best = drawn[means.index(max(means))]
    chosen = classifier.copy({classifier.getParam(name): value for name, value in best.items()})
    return Search(fit(Pipeline(stages=[*before, chosen]), train), best, means)


def cross_validated_f1(estimator: Pipeline, df: DataFrame, key: str, k: int = 5, seed: int = 42, cache: list[DataFrame] | None = None) -> DataFrame:
    """F1 of class 1 per fold. One distributed fit per fold, on the fold's written vectors."""
    classifier = estimator.getStages()[-1]
    results = []
    for i, table in enumerate(cache or fold_vectors(estimator, df, key, k, seed)):
        model = classifier.fit(table.filter(F.col("fold") != i))
        results.append(evaluate.metrics(score(model, table.filter(F.col("fold") == i)), None).select(F.lit(i).alias("fold"), "f1"))
    return reduce(DataFrame.unionByName, results)


def two_stage_fit(first: Pipeline, second: Pipeline, train: DataFrame, alpha: float = 0.75, gamma: float = 2.0) -> PipelineModel:
    """Fit, turn the training scores into focal weights, fit again on those weights."""
    base = fit(first, weighting.balanced_weights(train))
    scored = score(base, train)
    # The weights depend on a whole fitted model: writing them cuts that lineage for the refit.
    weighted = fit_table(weighting.focal_weights(scored, alpha=alpha, gamma=gamma).drop("probability", "prediction"), "focal-weights")
    return fit(second, weighted)


WEIGHTINGS = {
    "wce": weighting.balanced_weights,
    "cb": weighting.effective_number_weights,
}


def _settings(stages: Sequence) -> str:
    """What tells feature stages apart: their types and settings, without generated names."""
    def one(stage) -> str:
        found = {p.name: str(value) for p, value in stage.extractParamMap().items()}
        own = {k: str(v) for k, v in vars(stage).items() if isinstance(v, (str, int, float, tuple, list))}
        return re.sub(r"_[0-9a-f]{12}", "", f"{type(stage).__name__} {sorted(found.items())} {sorted((k, v) for k, v in own.items() if k != 'uid')}")

    return "; ".join(map(one, stages))


def compare_models(models: Mapping[str, Pipeline], train: DataFrame, test: DataFrame, first: Pipeline | None = None) -> DataFrame:
    """Every model under weighted, focal and class-balanced training, ranked by F1.

    A loop of distributed fits; only one metric row per fit is kept. Features do not depend on weights, so each different set of feature
    stages is fitted and its vectors written once; all fits read these. ``first`` gives the scores that focal weights follow from.
    """
    tables: dict[str, tuple[DataFrame, DataFrame]] = {}

    def vectors(stages: Sequence) -> tuple[DataFrame, DataFrame]:
        if not stages:
            return train, test
        name = _settings(stages)
        if name not in tables:
            features = Pipeline(stages=list(stages)).fit(train)
            tables[name] = tuple(fit_table(features.transform(part).select(LABEL, "features"), "vectors") for part in (train, test))
        return tables[name]

    rows = []
    for name, pipeline in models.items():
        *before, classifier = pipeline.getStages()
        rows_train, rows_test = vectors(before)
        alone = Pipeline(stages=[classifier])
        for loss in ("wce", "focal", "cb"):
            if loss == "focal":
                base = Pipeline(stages=[first.getStages()[-1]]) if first and _settings(first.getStages()[:-1]) == _settings(before) else alone
                model = two_stage_fit(base, alone, rows_train)
            else:
                model = fit(alone, WEIGHTINGS[loss](rows_train))
            rows.append(report(score(model, rows_test)).select(
                F.lit(name).alias("model"), F.lit(loss).alias("loss_type"), "accuracy", "precision", "recall", "f1", "roc_auc"))
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("f1"), "model", "loss_type")


def refit(estimator: Pipeline, *parts: DataFrame) -> PipelineModel:
    """Final fit on the union of the given tables, with balanced weights."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return fit(estimator, weighting.balanced_weights(whole))
