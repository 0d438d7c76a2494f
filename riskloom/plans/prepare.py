"""From raw collections to the clean table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import normalise as n
from riskloom.operators import dedup
from riskloom.operators.profile import source_profile
from riskloom.schemas import CLEAN, CVE_TREE
from riskloom.session import settled, staged
from riskloom.sources import health, nested, tables, text_lines


def cleaned_columns(df: DataFrame) -> DataFrame:
    """Standard records with cleaned text and numeric label; nothing is dropped yet."""
    label = n.label_of(F.col("is_vulnerable"), df.schema["is_vulnerable"].dataType)
    return settled(df, {"raw_code": n.clean_code(F.col("raw_code")), "is_vulnerable": label})


def usable() -> Column:
    """Whether a cleaned record stays: text size in range and label 0 or 1."""
    return F.coalesce(n.clean_length_ok(F.col("raw_code")) & F.col("is_vulnerable").isNotNull(), F.lit(False))


def clean_records(df: DataFrame) -> DataFrame:
    """Clean records, with the ordering columns of the input kept behind them.

    The size and label filter comes before hashing and language detection.
    """
    return _finished(cleaned_columns(df))


def _finished(cleaned: DataFrame) -> DataFrame:
    kept = cleaned.filter(usable())
    code = F.col("raw_code")
    full = kept.withColumns(
        {
            "language": n.normalise_language(F.col("language"), code),
            "group_id": F.coalesce(F.col("group_id").cast("string"), F.lit("")),
            "code_hash": n.content_key(code),
            "code_length": n.char_length(code),
            "line_count": n.nonblank_lines(code),
        }
    )
    order = [c for c in ("source_rank", "row_pos", "item", "doc_id") if c in full.columns]
    return full.select(*CLEAN.fieldNames(), *order)


def clean_table(df: DataFrame, order: tuple[str, ...] = ("source_rank", "path", "row_pos")) -> DataFrame:
    """Clean records without repeated content; the first in source order stays."""
    return dedup.keep_first(clean_records(df), order=order)


RECORD = ("raw_code", "is_vulnerable", "path", "language", "group_id", "row_pos", "item", "refused")


def _no_item() -> Column:
    return F.array().cast("array<int>")


def source_records(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Standard records of one collection, and one row with ``refused`` set for each line or file that cannot be parsed.

    A file that cannot be read to its end gives the records before the damage and one refused row; all other files are read.

    The name of the source decides the reader: ``megavul`` collections are arrays of CVE trees, ``cvefixes`` is a CSV
    file with code and safety, all others are JSON lines.
    """
    broken = health.broken_files(spark, path)
    if source.startswith("megavul"):
        read = nested.json_array(spark, path, CVE_TREE, corrupt=True, position=True, broken=broken, **health.READ_ON)
        trees = nested.from_cve_tree(read.filter(F.col(nested.CORRUPT).isNull()).drop(nested.CORRUPT), item="item")
        good = trees.withColumn("is_vulnerable", F.col("is_vulnerable").cast("string"))
    elif source.startswith("cvefixes"):
        read = tables.quoted_csv(spark, path, corrupt=True, position=True, broken=broken, **health.READ_ON)
        good = read.filter(F.col(tables.CORRUPT).isNull()).na.drop(subset=["code", "safety"]).withColumnsRenamed({"code": "raw_code", "safety": "is_vulnerable"})
        good = good.withColumns({"group_id": F.lit(""), "item": _no_item()})
    else:
        read = text_lines.json_lines(spark, path, **health.READ_ON)
        good = text_lines.standard_records(read, source).withColumn("item", _no_item())
    good = good.withColumn("refused", F.lit(False)).select(*RECORD)
    kinds = dict(good.dtypes)
    # Spark does not read the corrupt column of JSON files alone, so a second column is looked at.
    looked = F.length(F.coalesce(F.col(read.columns[0]).cast("string"), F.lit(""))) >= 0
    bad = read.filter(F.col("_corrupt").isNotNull() & looked).withColumn("refused", F.lit(True)).select("path", "row_pos", "refused")
    if not source.startswith(("megavul", "cvefixes")):  # their readers tell of broken files themselves
        place = F.struct(F.col("path"), F.lit((1 << 62)).cast("long").alias("split"), F.lit(0).cast("long").alias("row")).alias("row_pos")
        bad = bad.unionByName(broken.select("path", place, F.lit(True).alias("refused")))
    return good.unionByName(bad.select(*[F.col(c) if c in ("path", "row_pos", "refused") else F.lit(None).cast(kinds[c]).alias(c) for c in RECORD]))


@dataclass(frozen=True)
class Corpus:
    """The clean table, its profile by source, and the counts before and after removing repeated content."""

    table: DataFrame
    sources: DataFrame
    combined: DataFrame


def clean_corpus(spark: SparkSession, paths: Mapping[str, str]) -> Corpus:
    """From raw collections (source name -> path, in order of precedence) to the clean table, as one job.

    Sources whose path is missing are skipped. Cleaned records are written once; profile and table read them.
    """
    found = text_lines.readable(spark, dict(paths))
    records = dedup.union_sources({name: source_records(spark, name, path) for name, path in found.items()})
    cleaned = staged(cleaned_columns(records), "cleaned-records")
    good = staged(_finished(cleaned.filter("not refused")), "clean-records")
    order = ("source_rank", "path", "row_pos", "item")
    first = dedup.keep_first(good, order=order)
    return Corpus(first.select(*CLEAN.fieldNames()), source_profile(cleaned, usable(), F.col("refused")), dedup.dedup_audit(good))
