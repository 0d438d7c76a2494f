"""Risk scale, recommendations, report lines and losses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed

# What to do at each level, in this library's words.
ADVICE = {
    "HIGH": "Stop: do not merge before the findings below are fixed.",
    "MEDIUM": "A person should read this change before it is merged.",
    "LOW": "Nothing stands out; the usual process is enough.",
}


def risk_level(probability: Column, strict: bool = True) -> Column:
    """LOW, MEDIUM or HIGH. Outside [0, 1]: an error, or null when not ``strict``."""
    outside = (probability < 0) | (probability > 1) | F.isnan(probability)
    bad = F.raise_error(F.lit("risk probability must be between 0 and 1")) if strict else F.lit(None).cast("string")
    return (
        F.when(outside, bad)
        .when(probability < fixed.MEDIUM_FROM, F.lit("LOW"))
        .when(probability < fixed.HIGH_FROM, F.lit("MEDIUM"))
        .when(probability.isNotNull(), F.lit("HIGH"))
    )


def base_advice(level: Column) -> Column:
    return F.when(level == "HIGH", F.lit(ADVICE["HIGH"])).when(level == "MEDIUM", F.lit(ADVICE["MEDIUM"])).otherwise(
        F.lit(ADVICE["LOW"])
    )


def advice_text(level: Column, mitigations: Column) -> Column:
    bullets = F.array_join(F.transform(mitigations, lambda m: F.concat(F.lit("- "), m)), "\n")
    return F.when(F.size(mitigations) > 0, F.concat(base_advice(level), F.lit("\nProposed mitigations:\n"), bullets)).otherwise(
        base_advice(level)
    )


def reported_probability(probability: Column) -> Column:
    return F.round(probability, 4)


def report_line(path: Column, probability: Column, level: Column, types: Column, mitigations: Column) -> Column:
    head = F.concat(path, F.lit(" — "), F.format_string("%.1f", probability * 100), F.lit("% ("), level, F.lit(")"))
    found = F.transform(types, lambda t: F.concat(F.lit("   type: "), F.substring(t, 1, 100)))
    fixes = F.transform(F.slice(mitigations, 1, 1), lambda m: F.concat(F.lit("   fix: "), F.substring(m, 1, 120)))
    return F.array_join(F.concat(F.array(head), found, fixes), "\n")


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def feature_label(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("tfidf__"), F.lit("")), F.lit("ast__ast_"), F.lit("ast_"))


# --- losses on (label, logit) ----------------------------------------------------------------
def cross_entropy(label: Column, logit: Column, positive_weight: float = 1.0) -> Column:
    """Binary cross-entropy from logits in the form that cannot overflow."""
    softplus = F.log1p(F.exp(-F.abs(logit))) + F.greatest(-logit, F.lit(0.0))
    return (1 - label) * logit + (1 + (positive_weight - 1) * label) * softplus


def focal_loss(label: Column, logit: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    p = sigmoid(logit)
    p_true = label * p + (1 - label) * (1 - p)
    balance = label * alpha + (1 - label) * (1 - alpha)
    return balance * F.pow(1 - p_true, F.lit(gamma)) * cross_entropy(label, logit)


def weighted_cross_entropy(label: Column, logit: Column, weight_positive: float = 10.0, weight_negative: float = 1.0) -> Column:
    return cross_entropy(label, logit, weight_positive / weight_negative)


def effective_number(rows: Column, beta: float) -> Column:
    return F.when(rows > 0, (1 - F.pow(F.lit(beta), rows.cast("double"))) / (1 - beta)).otherwise(F.lit(1.0))
