"""Class and sample weights for imbalanced training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.risk import effective_number

RF_WEIGHTS = {0: 1.0, 1: 2.5}


def class_sizes(df: DataFrame, label: str = "is_vulnerable") -> tuple[Column, Column]:
    """Sizes of class 0 and 1 as scalar subqueries of one aggregate."""
    counted = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    return counted.select("n0").scalar(), counted.select("n1").scalar()


def balanced_weights(df: DataFrame, label: str = "is_vulnerable", name: str = "weight") -> DataFrame:
    """``n / (2 n_c)`` per row."""
    n0, n1 = class_sizes(df, label)
    return df.withColumn(name, (n0 + n1) / (2 * F.when(F.col(label) == 1, n1).otherwise(n0)))


def balanced_summary(df: DataFrame, label: str = "is_vulnerable") -> DataFrame:
    counted = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    n = F.col("n0") + F.col("n1")
    return counted.withColumns(
        {
            "weight_0": n / F.nullif(2 * F.col("n0"), F.lit(0)),
            "weight_1": n / F.nullif(2 * F.col("n1"), F.lit(0)),
            "ratio": F.col("n0") / F.nullif(F.col("n1"), F.lit(0)),
        }
    )


def _mean_one(df: DataFrame, raw: Column, name: str) -> DataFrame:
    weighted = df.withColumn(name, raw)
    return weighted.withColumn(name, F.col(name) / weighted.agg(F.avg(name)).scalar())


def focal_weights(
    df: DataFrame, probability: str = "probability", label: str = "is_vulnerable", alpha: float = 0.75, gamma: float = 2.0, name: str = "weight"
) -> DataFrame:
    """``alpha_t (1 - p_t)^gamma`` with p_t kept off 0 and 1, scaled to mean 1."""
    p, positive = F.col(probability), F.col(label) == 1
    p_true = F.least(F.greatest(F.when(positive, p).otherwise(1 - p), F.lit(1e-7)), F.lit(1 - 1e-7))
    alpha_t = F.when(positive, F.lit(alpha)).otherwise(F.lit(1 - alpha))
    return _mean_one(df, alpha_t * F.pow(1 - p_true, F.lit(gamma)), name)


def effective_number_weights(df: DataFrame, label: str = "is_vulnerable", beta: float = 0.9999, name: str = "weight") -> DataFrame:
    """Inverse effective class size, scaled to mean 1."""
    n0, n1 = class_sizes(df, label)
    w0, w1 = 1 / effective_number(n0, beta), 1 / effective_number(n1, beta)
    scale = (n0 + n1) / (w0 * n0 + w1 * n1)
    return df.withColumn(name, F.when(F.col(label) == 1, w1).otherwise(w0) * scale)


def fixed_weights(df: DataFrame, weights: dict[int, float] = RF_WEIGHTS, label: str = "is_vulnerable", name: str = "weight") -> DataFrame:
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])))
