"""Counts, shares and distributions of a corpus or a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_profile(normalised: DataFrame, usable: Column, error: Column | None = None, label: str = "is_vulnerable") -> DataFrame:
    """Input rows, usable rows, label counts and errors per source, in one pass.

    ``normalised`` still holds the rows the filters will drop; ``usable`` tells which stay.
    """
    ok = F.coalesce(usable, F.lit(False))
    failed = F.coalesce(error, F.lit(False)) if error is not None else F.lit(False)
    return normalised.groupBy("source").agg(
        F.count_if(~failed).alias("input_records"),
        F.count_if(ok & ~failed).alias("usable_records"),
        F.count_if(ok & ~failed & (F.col(label) == 0)).alias("label_0"),
        F.count_if(ok & ~failed & (F.col(label) == 1)).alias("label_1"),
        F.count_if(failed).alias("errors"),
    )


def combined_profile(df: DataFrame, label: str = "is_vulnerable") -> DataFrame:
    """Rows by label and by source, as (dimension, value, count)."""
    value = F.explode(
        F.array(
            F.struct(F.lit("label").alias("dimension"), F.col(label).cast("string").alias("value")),
            F.struct(F.lit("source").alias("dimension"), F.col("source").alias("value")),
        )
    )
    counted = df.groupBy(label, "source").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("n", value.alias("entry")).groupBy("entry.dimension", "entry.value").agg(F.sum("n").alias("row_count"))


def class_shares(df: DataFrame, label: str = "is_vulnerable") -> DataFrame:
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("share", F.round(F.col("row_count") / total, 6))


def cross_tab(df: DataFrame, segment: str, label: str = "is_vulnerable") -> DataFrame:
    """Rows of each segment by label, missing combinations as zero."""
    return df.groupBy(segment).agg(
        F.count_if(F.col(label) == 0).alias("label_0"), F.count_if(F.col(label) == 1).alias("label_1")
    )


def length_statistics(df: DataFrame, length: str = "code_length") -> DataFrame:
    """Exact size statistics. Rows are first counted per length, of which there are few."""
    counted = df.groupBy(F.col(length).alias("_len")).agg(F.count(F.lit(1)).alias("_n"))
    quantiles = F.percentile("_len", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("_n"))
    return counted.agg(
        F.min("_len").alias("min_length"),
        F.max("_len").alias("max_length"),
        F.round(F.sum(F.col("_len") * F.col("_n")) / F.sum("_n"), 6).alias("mean_length"),
        quantiles.alias("_q"),
    ).select(
        "min_length", "max_length", "mean_length",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("median_length"), F.col("_q")[2].alias("p75"),
    )


def field_presence(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    counted = df.agg(*[F.count(name).alias(name) for name in fields])
    return counted.select(F.explode(F.create_map(*[part for name in fields for part in (F.lit(name), F.col(name))])).alias("field", "present"))


def majority_baseline(df: DataFrame, label: str = "is_vulnerable") -> DataFrame:
    """Most frequent label and the accuracy of always answering it; the smaller label on ties."""
    counted = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.max_by("_label", F.struct(F.col("_n"), -F.col("_label"))).alias("majority_label"),
        F.round(F.max("_n") / F.sum("_n"), 6).alias("baseline_accuracy"),
    )


def scan_summary(df: DataFrame) -> DataFrame:
    total, bad = F.count(F.lit(1)), F.count_if(F.col("is_vulnerable"))
    return df.agg(
        total.alias("total_files"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high"),
        F.count_if(F.col("risk_level") == "MEDIUM").alias("medium"),
        F.count_if(F.col("risk_level") == "LOW").alias("low"),
        bad.alias("vulnerable_files"),
        (total - bad).alias("safe_files"),
        F.coalesce(F.round(bad / F.nullif(total, F.lit(0)), 4), F.lit(0.0)).alias("vulnerability_rate"),
        F.coalesce(F.round(100 * bad / F.nullif(total, F.lit(0)), 1), F.lit(0.0)).alias("vulnerable_percent"),
    )


def scan_verdict(df: DataFrame) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("status") == "VULNERABLE").alias("_bad"), F.max("probability").alias("_p")
    )
    return counted.select(
        F.when(F.col("_bad") > 0, F.lit("VULNERABLE")).otherwise(F.lit("SAFE")).alias("status"),
        F.round(F.coalesce("_p", F.lit(0.0)), 4).alias("probability"),
        F.when(F.col("_all") == 0, F.lit("No relevant source file was changed."))
        .otherwise(F.format_string("%d of %d analysed files are vulnerable.", F.col("_bad"), F.col("_all")))
        .alias("details"),
    )


def class_counts_by(df: DataFrame, category: str, label: str = "is_vulnerable") -> DataFrame:
    return df.groupBy(category, label).agg(F.count(F.lit(1)).alias("row_count"))


def kept_by_source(df: DataFrame, keep: Column) -> DataFrame:
    return df.groupBy("source").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.coalesce(keep, F.lit(False))).alias("kept")
    )
