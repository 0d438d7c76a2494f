"""Checks on module metrics and on training tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import fixed_values as fixed

ANY_JSON = T.MapType(T.StringType(), T.StringType())


def field_sets(keys: Column, required: Sequence[str] = fixed.METRIC_FIELDS) -> tuple[Column, Column]:
    """(missing, unexpected) field names, each sorted."""
    wanted = F.array(*map(F.lit, required))
    return F.sort_array(F.array_except(wanted, keys)), F.sort_array(F.array_except(keys, wanted))


def parse_metrics(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Read metric payloads: the typed fields, plus missing and unexpected names and a verdict."""
    typed = T.StructType([T.StructField(f, T.DoubleType() if f == "test_coverage" else T.LongType()) for f in fixed.METRIC_FIELDS])
    keyed = df.withColumns({"_keys": F.map_keys(F.from_json(payload, ANY_JSON)), "metrics": F.from_json(payload, typed)})
    missing, unexpected = field_sets(F.coalesce(F.col("_keys"), F.array().cast("array<string>")))
    return (
        keyed.withColumns({"missing_fields": missing, "unexpected_fields": unexpected})
        .withColumn("accepted", (F.size("missing_fields") == 0) & (F.size("unexpected_fields") == 0))
        .drop("_keys")
    )


def metric_violations(values: dict[str, Column]) -> Column:
    """Names of the violated rules of one metrics row.

    ``values`` maps each metric to its column *as text*, so that a quoted number, a boolean or
    ``NaN`` is still visible.
    """
    number = r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$"
    special = r"^[-+]?(NaN|Infinity|inf|nan)$"
    checks = []
    for name in fixed.METRIC_FIELDS:
        text = values[name]
        size = text.try_cast("double")
        # Most values are spelled as Spark spells numbers; only others need a pattern.
        whole = F.coalesce(text.try_cast("bigint").cast("string") == text, F.lit(False))
        plain = whole | F.coalesce((size.cast("string") == text) & ~F.isnan(size) & (F.abs(size) < float("inf")), F.lit(False)) if name == "test_coverage" else whole
        odd = F.when(plain, False).otherwise(F.regexp_like(text, F.lit(special)))
        numeric = F.when(plain, True).otherwise(F.regexp_like(text, F.lit(number)))
        checks.append(F.when(text.isNull() | ~(numeric | odd), F.lit(f"{name}: not numeric")))
        checks.append(F.when(odd, F.lit(f"{name}: not finite")))
        checks.append(F.when(numeric & (size < 0), F.lit(f"{name}: negative")))
        if name != "test_coverage":
            integer = F.when(plain, True).otherwise(F.regexp_like(text, F.lit(r"^-?\d+$")))
            checks.append(F.when(numeric & ~integer, F.lit(f"{name}: not an integer")))
    coverage, lines = values["test_coverage"].try_cast("double"), values["lines_of_code"].try_cast("double")
    checks.append(F.when(coverage > 100, F.lit("test_coverage: above 100")))
    checks.append(F.when(lines == 0, F.lit("lines_of_code: zero")))
    return F.array_compact(F.array(*checks))


def validate_metrics(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``violations``; ``strict`` keeps only rows that have none."""
    checked = df.withColumn("violations", metric_violations({f: F.col(f).cast("string") for f in fixed.METRIC_FIELDS}))
    return checked.filter(F.size("violations") == 0).drop("violations") if strict else checked


def training_report(df: DataFrame, features: Sequence[str] = ("raw_code",), label: str = "is_vulnerable") -> DataFrame:
    """One-row report on a training table, from a single aggregate without shuffle of its rows."""
    required = [*features, label]
    missing = [name for name in required if name not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame(
            [(0, 0, 0, 0, f"missing columns: {missing}")], "row_count long, null_rows long, bad_labels long, classes long, verdict string"
        )
    any_null = F.lit(False)
    for name in required:
        any_null = any_null | F.col(name).isNull()
    present = [(F.count_if(F.col(label) == c) > 0).cast("bigint") for c in (0, 1)]
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_null).alias("null_rows"),
        F.count_if(~F.col(label).isin(0, 1)).alias("bad_labels"),
        (present[0] + present[1]).alias("classes"),
    )
    return counted.withColumn(
        "verdict",
        F.when(F.col("row_count") == 0, F.lit("empty"))
        .when(F.col("null_rows") > 0, F.lit("null values"))
        .when(F.col("bad_labels") > 0, F.lit("labels outside 0 and 1"))
        .when(F.col("classes") < 2, F.lit("one class only"))
        .otherwise(F.lit("ok")),
    )


def check_training(df: DataFrame, features: Sequence[str] = ("raw_code",), label: str = "is_vulnerable") -> None:
    """Raise if the training table must be refused."""
    verdict = training_report(df, features, label).first()["verdict"]
    if verdict != "ok":
        raise ValueError(f"training table refused: {verdict}")
