"""Feature importances of a fitted model and the strongest reasons behind one score."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.patterns import let
from riskloom.functions.risk import feature_label

NO_REASON = "No single feature stands out"


def feature_names(scored: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from the metadata the assembler wrote."""
    meta = scored.schema[column].metadata["ml_attr"]
    names = [str(i) for i in range(meta["num_attrs"])]
    for attrs in meta.get("attrs", {}).values():
        for attr in attrs:
            names[attr["idx"]] = attr.get("name", names[attr["idx"]])
    return names


def importances(spark: SparkSession, names: Sequence[str], values: Sequence[float], top: int | None = 10) -> DataFrame:
    """(feature, importance), strongest first; as many rows as the model has features at most."""
    rows = [(name, float(value)) for name, value in zip(names, values)]
    table = spark.createDataFrame(rows, "feature string, importance double").withColumn("importance", F.round("importance", 4))
    table = table.withColumn("feature", feature_label(F.col("feature")))
    return table.orderBy(F.desc("importance"), "feature").limit(top) if top else table


def top_reasons(
    df: DataFrame, features: Sequence[str], coefficients: Sequence[float], means: Sequence[float] | None = None, top: int = 3, name: str = "reasons"
) -> DataFrame:
    """Features that raised the linear score most: ``coef * (value - mean)``, largest first.

    Computed inside each row. Without ``means``, they are taken from ``df``.
    """
    if means is None:
        averaged = df.agg(*[F.avg(f).alias(f) for f in features])
        means_columns = [averaged.select(f).scalar() for f in features]
    else:
        means_columns = [F.lit(float(m)) for m in means]
    entries = F.array(
        *[
            F.struct((-(F.lit(float(c)) * (F.col(f) - m))).alias("order"), F.lit(f).alias("feature"))
            for f, c, m in zip(features, coefficients, means_columns)
        ]
    )
    rising = F.filter(F.col("_entries"), lambda e: e["order"] < 0)
    picked = F.transform(F.slice(F.array_sort(rising), 1, top), lambda e: feature_label(e["feature"]))
    chosen = df.withColumn("_entries", entries).withColumn(name, picked).drop("_entries")
    return chosen.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.lit(NO_REASON))))


def vector_reasons(
    df: DataFrame, names: Sequence[str], coefficients: Sequence[float], means: Sequence[float] | None = None, top: int = 3,
    column: str = "features", name: str = "reasons",
) -> DataFrame:
    """``top_reasons`` for a feature vector of a fitted linear model.

    Only the slots that a row holds are looked at. An absent slot adds ``-coef * mean`` in every row, so absent slots are ranked once for
    all rows; the best ones of a row are the first ranks that its own slots leave free, found in a row of h slots among the first
    h + ``top`` ranks.
    """
    vector = F.unwrap_udt(column)
    spots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    if means is None:
        means = df.agg(Summarizer.mean(F.col(column)).alias("m")).first()["m"].toArray()
    shift = sorted((float(c) * float(m), label, i) for i, (c, m, label) in enumerate(zip(coefficients, means, names)) if c * m < 0)
    places = {slot: rank for rank, (_, _, slot) in enumerate(shift)}

    def literal(values: Sequence, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")

    labels = literal(list(names), "string")
    weights, centres = literal([float(c) for c in coefficients], "double"), literal([float(m) for m in means], "double")
    absent = literal([{"order": o, "feature": label, "slot": i} for o, label, i in shift], "struct<order:double,feature:string,slot:int>")
    ranks = literal([places.get(i) for i in range(len(names))], "int")
    held = F.transform(
        F.arrays_zip(spots.alias("i"), vector["values"].alias("x")),
        lambda e: F.struct((-(F.get(weights, e["i"]) * (e["x"] - F.get(centres, e["i"])))).alias("order"), F.get(labels, e["i"]).alias("feature"), e["i"].alias("slot")),
    )
    taken = F.array_compact(F.transform(spots, lambda i: F.get(ranks, i)))
    free = let(taken, lambda t: F.slice(F.array_except(F.sequence(F.lit(0), F.size(t) + (top - 1)), t), 1, top))
    others = F.array_compact(F.transform(free, lambda rank: F.get(absent, rank)))
    rising = F.slice(F.array_sort(F.concat(F.filter(held, lambda e: e["order"] < 0), others)), 1, top)
    picked = df.withColumn(name, F.transform(rising, lambda e: feature_label(e["feature"])))
    return picked.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.lit(NO_REASON))))


def top_terms(contributions: DataFrame, key: str, top: int = 3) -> DataFrame:
    """Top terms per document from (key, term, contribution) rows.

    A document brings at most the vocabulary; the rank filter lets each map task pass on only its
    ``top`` rows per document.
    """
    positive = contributions.filter(F.col("contribution") > 0)
    order = Window.partitionBy(key).orderBy(F.desc("contribution"), "term")
    ranked = positive.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    return ranked.select(key, "place", feature_label(F.col("term")).alias("term"), "contribution")
