"""The training job: group split, threshold choice, evaluation, final fit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.operators import dedup, evaluate, explain, modelling, profile, validation
from riskloom.operators.sampling import group_split, stratified_split
from riskloom.operators.stages import TermWeights
from riskloom.operators.vectorise import SyntacticFeatures, term_pipeline
from riskloom.operators.weighting import balanced_weights
from riskloom.session import staged
from riskloom.sources import sinks


@dataclass
class TrainingParts:
    fit: DataFrame
    valid: DataFrame
    train: DataFrame
    test: DataFrame
    synthetic: DataFrame


def split_corpus(clean: DataFrame, test: float = 0.25, valid: float = 0.2, seed: int = 42, exact: bool = True) -> TrainingParts:
    """Real rows split by group, leaked content removed from training, then split again."""
    grouped = clean.withColumn("_group", n.effective_group(F.col("group_id"), F.col("code_hash")))
    real = grouped.filter(~n.is_synthetic(F.col("source")))
    marked = group_split(real, "_group", test, seed, exact)
    held = marked.filter("is_test").drop("is_test")
    train = dedup.drop_leaked(marked.filter(~F.col("is_test")).drop("is_test"), held)
    inner = group_split(train, "_group", valid, seed + 1, exact, flag="is_valid")
    return TrainingParts(
        fit=inner.filter(~F.col("is_valid")).drop("is_valid"), valid=inner.filter("is_valid").drop("is_valid"),
        train=train, test=held, synthetic=grouped.filter(n.is_synthetic(F.col("source"))),
    )


@dataclass
class TrainingResult:
    """``report`` has one row: measures on the test rows, the confusion matrix, the threshold with its measures on the validation rows, and
    the sizes of all parts; ``classes`` is the report by class."""

    model: PipelineModel
    threshold: float
    report: DataFrame
    by_language: DataFrame
    by_source: DataFrame
    classes: DataFrame


def train(clean: DataFrame, estimator: Pipeline | None = None, seed: int = 42) -> TrainingResult:
    """Train on the clean table. The table is written once; it feeds every later stage."""
    validation.check_training(clean)
    table = staged(clean, "clean")
    parts = split_corpus(table, seed=seed)
    estimator = estimator or modelling.model_pipeline(modelling.logistic())
    calibrated = modelling.score(modelling.fit(estimator, balanced_weights(parts.fit)), parts.valid)
    best = evaluate.best_threshold(evaluate.threshold_sweep(calibrated)).first()
    threshold = best["threshold"]
    fitted = modelling.fit(estimator, balanced_weights(parts.train))
    scored = staged(modelling.score(fitted, parts.test, threshold).drop("raw_code"), "test-scores")
    baseline = profile.majority_baseline(scored)
    sizes = {"total_clean_records": table, "fit_records": parts.fit, "validation_records": parts.valid, "train_records": parts.train, "test_records": parts.test}
    counts = {name: F.lit(part.count()).alias(name) for name, part in sizes.items()}
    chosen = {f"validation_{m}": F.lit(best[m]) for m in ("accuracy", "precision", "recall", "f1")}
    report = evaluate.target_check(modelling.report(scored)).withColumns(
        {
            "decision_threshold": F.lit(threshold), "baseline_majority_accuracy": baseline.select("baseline_accuracy").scalar(),
            "confusion_matrix": F.array(F.array("tn", "fp"), F.array("fn", "tp")), **chosen, **counts,
            "model": F.lit(type(estimator.getStages()[-1]).__name__), "synthetic_sources": F.array(*map(F.lit, fixed.SYNTHETIC_SOURCES)),
        }
    )
    # The table holds each content once, so no two rows tie.
    final = modelling.refit(estimator, dedup.final_training_set(parts.train, parts.synthetic, order=("code_hash",)))
    return TrainingResult(
        final, threshold, report, evaluate.segment_metrics(scored, "language"), evaluate.segment_metrics(scored, "source"), evaluate.class_report(scored)
    )


@dataclass
class Trained:
    """``report`` has one row; ``importances`` is null for models without them; ``params`` are those that a search chose."""

    model: PipelineModel
    params: dict
    report: DataFrame
    importances: DataFrame | None


GRIDS = {RandomForestClassifier: fixed.FOREST_GRID}


def train_classifier(
    df: DataFrame, classifier: Estimator, key: str, features: Pipeline | None = None, tune: bool = False, grid: Mapping[str, Sequence] | None = None,
    weigh: Callable[[DataFrame], DataFrame] = balanced_weights, seed: int = 42, model_path: str | None = None, report_path: str | None = None,
) -> Trained:
    """One trainer's whole course: stratified split, search, measures, F1 over folds, importances, refit on all rows, and what is saved.

    ``features`` defaults to the most frequent n-grams with structure and language of the code. A search draws from ``grid`` or the
    classifier's own; classifiers without one are fitted as they are.
    """
    validation.check_training(df)
    marked = staged(stratified_split(df, key, fixed.TRAINER_TEST_FRACTION, seed), "split")
    train_rows, test_rows = weigh(marked.filter(~F.col("is_test")).drop("is_test")), marked.filter("is_test").drop("is_test")
    before = (features or term_pipeline()).getStages()
    params: dict = {}
    grid = grid or next((g for kind, g in GRIDS.items() if isinstance(classifier, kind)), None)
    if tune and grid:
        params = modelling.random_search(
            Pipeline(stages=[*before, classifier]), train_rows, grid, key, fixed.SEARCH_DRAWS, fixed.SEARCH_FOLDS, seed).params
        classifier = classifier.copy({classifier.getParam(name): value for name, value in params.items()})
    estimator = Pipeline(stages=[*before, classifier])
    fitted = modelling.fit(estimator, train_rows)
    report = modelling.report(modelling.score(fitted, test_rows))
    folds = modelling.cross_validated_f1(estimator, weigh(df), key, fixed.SCORE_FOLDS, seed)
    report = report.withColumns({
        "cross_validation_f1_mean": F.round(folds.agg(F.avg("f1")).scalar(), 4), "confusion_matrix": F.array(F.array("tn", "fp"), F.array("fn", "tp"))})
    strengths = getattr(fitted.stages[-1], "featureImportances", None)
    importances = None
    if strengths is not None:
        weighted = any(isinstance(stage, TermWeights) for stage in fitted.stages)
        names = SyntacticFeatures(fitted).names if weighted else explain.feature_names(fitted.transform(test_rows))
        importances = explain.importances(df.sparkSession, names, strengths.toArray(), None)
    final = modelling.fit(estimator, weigh(df))
    if model_path:
        sinks.save_model(final, model_path)
    if report_path:
        sinks.write_report(report, report_path)
    return Trained(final, params, report, importances)
