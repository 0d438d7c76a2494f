"""Scan jobs: rules, features and scores of files, rolled up into reports."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.operators import dedup, features, profile, rules
from riskloom.operators.modelling import score
from riskloom.sources import sinks


def model_inputs(df: DataFrame, code: str = "raw_code", source: str = "manual") -> DataFrame:
    """Add the columns a model reads beside the text."""
    text = F.col(code)
    return df.withColumns(
        {
            "language": n.detect_web_language(text), "source": F.lit(source),
            "code_length": n.char_length(text), "line_count": n.nonblank_lines(text),
        }
    )


def scored(df: DataFrame, model: Transformer) -> DataFrame:
    return score(model, model_inputs(df)).drop("prediction")


def scan(
    df: DataFrame, model: Transformer | None = None, threshold: float = fixed.DECISION_THRESHOLD, reasons: str | None = None
) -> DataFrame:
    """Prediction per file. Without a model, ``df`` must bring a ``probability`` column.

    ``reasons`` names an array column with the features behind the score, as ``explain`` adds it.
    """
    rated = scored(df, model) if model is not None else df
    return rules.decide(rules.code_findings(rated), reasons=reasons, threshold=threshold)


def scan_changes(
    df: DataFrame, changed: DataFrame | None = None, model: Transformer | None = None, threshold: float = fixed.PR_THRESHOLD, source_dir: str | None = None
) -> DataFrame:
    """Change scan: the listed source files only, with features and a status per file."""
    wanted = df.filter(n.is_source_file(F.col("path")) & n.in_pr_scope(F.col("path"), source_dir) & ~n.is_blank(F.col("raw_code")))
    if changed is not None:
        wanted = dedup.restrict_to(wanted, changed)
    rated = scored(wanted, model) if model is not None else wanted
    found = features.file_summary(rules.code_findings(rated)).withColumn("suspicious_patterns", F.col("features.suspicious_patterns"))
    return rules.decide_pr(found, threshold=threshold).drop("suspicious_patterns")


def change_verdict(
    df: DataFrame, model_path: str, changed: DataFrame | None = None, allow_missing_model: bool = False, threshold: float = fixed.PR_THRESHOLD, source_dir: str | None = None
) -> DataFrame:
    """One row (status, probability, details) for a change scan with the model saved at ``model_path``.

    Without that model the verdict is UNKNOWN if ``allow_missing_model``, and else FileNotFoundError is raised.
    """
    spark = df.sparkSession
    if not sinks.model_exists(spark, model_path):
        if not allow_missing_model:
            raise FileNotFoundError(f"no model at {model_path}: train it before scanning")
        return spark.createDataFrame([("UNKNOWN", 0.0, f"No model at {model_path}.")], "status string, probability double, details string")
    return profile.scan_verdict(scan_changes(df, changed, sinks.load_model(model_path), threshold, source_dir))
