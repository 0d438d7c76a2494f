"""Union with provenance, first-wins deduplication, leakage removal and equi-joins of the corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions.normalise import sample_ok
from riskloom.session import staged


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One frame from many, with the source name and its place in the given order."""
    if not frames:
        raise ValueError("no source given")
    named = [
        df.withColumns({"source": F.lit(name), "source_rank": F.lit(rank)}) for rank, (name, df) in enumerate(frames.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def combined_corpus(
    frames: Mapping[str, DataFrame],
    limit_per_source: int | None = None,
    min_code_length: int = fixed.MIN_RAW_CHARS,
    max_code_length: int = fixed.MAX_RAW_CHARS,
    filter_junk: bool = True,
    order: str | Sequence[str] = "row_pos",
) -> DataFrame:
    """Per-source cap in file order, then the quality filter, then the union."""
    from riskloom.operators.sampling import first_rows

    capped = {name: first_rows(df, [], order, limit_per_source) if limit_per_source else df for name, df in frames.items()}
    return union_sources(capped).filter(sample_ok(F.col("raw_code"), min_code_length, max_code_length, filter_junk))


def keep_first(df: DataFrame, key: str = "code_hash", order: Sequence[str] = ("source_rank", "path", "row_pos")) -> DataFrame:
    """Keep the first row of each key in the given order.

    The aggregate combines on the map side, so a key that holds a third of all rows leaves each
    map task as one row; texts cross the network once per key and task, not once per copy.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(key).agg(first).select(key, "_first.*").select(*df.columns)


def drop_leaked(train: DataFrame, held_out: DataFrame, key: str = "code_hash") -> DataFrame:
    """Train rows whose key does not occur in the held-out rows."""
    return train.join(held_out.select(key).distinct(), key, "left_anti")


def final_training_set(train: DataFrame, synthetic: DataFrame, key: str = "code_hash", order: Sequence[str] = ("row_pos",)) -> DataFrame:
    """Real training rows, then synthetic ones, without repeated content."""
    both = train.withColumn("_part", F.lit(0)).unionByName(synthetic.withColumn("_part", F.lit(1)))
    return keep_first(both, key, ["_part", *order]).drop("_part")


def dedup_audit(df: DataFrame, key: str = "code_hash") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("before_dedup"), F.count_distinct(key).alias("after_dedup"))


def restrict_to(df: DataFrame, wanted: DataFrame, key: str = "path") -> DataFrame:
    return df.join(wanted.select(key).distinct(), key, "left_semi")


def with_labels(predictions: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Predictions with truth and segment columns; rows without a label take no part."""
    return predictions.join(labels, key)


def weighted_terms(term_weights: DataFrame, coefficients: DataFrame, term: str = "term") -> DataFrame:
    """Contribution of each term of each document: its weight times the model coefficient.

    The coefficient table is as large as the model's vocabulary, which its builder bounds. It is written first, so that
    Spark knows its size when it chooses the join.
    """
    return term_weights.join(staged(coefficients, "coefficients"), term).withColumn("contribution", F.col("weight") * F.col("coefficient"))

