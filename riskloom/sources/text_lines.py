"""JSON-lines collections: one reader, and one projection per collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.schemas import RAW_LINE
from riskloom.session import settled

CORRUPT = "_corrupt"


def readable(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """The sources whose path exists; the others are skipped."""
    found = {}
    for name, path in paths.items():
        try:
            spark.read.text(path)
            found[name] = path
        except AnalysisException:
            continue
    return found


ROW_BITS = 33  # in which a task numbers its rows


def source_path() -> Column:
    """The path of a row's file. Local paths are listed as file:///x but reported per row as file:/x."""
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def with_position(df: DataFrame) -> DataFrame:
    """Add ``path`` and ``row_pos`` (path, first byte of the split, row in the task), which sorts like sorted paths and their lines.

    Every part has its own whole number, so neither many files nor long ones wrap around.
    """
    path = source_path()
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    place = F.struct(path.alias("path"), F.col("_metadata.file_block_start").alias("split"), row.alias("row"))
    return df.select("*", path.alias("path"), place.alias("row_pos"))


def json_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = RAW_LINE, **options: str) -> DataFrame:
    """Fields of each line, with path and position. Blank lines vanish, bad bytes become U+FFFD.

    A line that is not a JSON object keeps its row, with the text in ``_corrupt``.
    """
    lines = spark.read.options(**options).text(path)
    lines = with_position(lines).withColumn("value", F.make_valid_utf8("value")).filter(~n.is_blank(F.col("value")))
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return settled(lines, {"r": parsed}).select("r.*", "path", "row_pos")


def good_lines(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def load_health(df: DataFrame, by: str = "path") -> DataFrame:
    """Lines read and lines refused per file or source; a refused line stops nothing else."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col(CORRUPT).isNotNull()).alias("errors"))


def _number(field: str) -> Column:
    """A label as a number: booleans count as 1 and 0."""
    text = F.lower(F.trim(F.col(field)))
    return F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))


def _label(*fields: str) -> Column:
    """The first label that is a number, cut to a whole one."""
    return F.coalesce(*[_number(f).try_cast("int") for f in fields])


def func_target(df: DataFrame) -> DataFrame:
    """``func`` / ``target`` records with their ids."""
    code = n.first_nonempty(F.col("func"))
    return good_lines(df).select(
        code.alias("raw_code"), F.coalesce(_label("target"), F.lit(0)).alias("is_vulnerable"), "id", "project", "commit_id", "path", "row_pos"
    ).filter(F.col("raw_code").isNotNull())


def function_source(df: DataFrame) -> DataFrame:
    """``functionSource`` first, then ``func`` and ``code``; longer than 20 characters."""
    code = n.first_nonempty(F.col("functionSource"), F.col("func"), F.col("code"))
    return good_lines(df).select(
        code.alias("raw_code"), n.first_nonzero(_label("label"), _label("target")).alias("is_vulnerable"), "id", "path", "row_pos"
    ).filter(longer_than(F.col("raw_code"), 20))


def code_first(df: DataFrame) -> DataFrame:
    """``code`` first, then ``func`` and ``functionSource``; longer than 20 characters."""
    code = n.first_nonempty(F.col("code"), F.col("func"), F.col("functionSource"))
    return good_lines(df).select(
        code.alias("raw_code"), n.first_nonzero(_label("label"), _label("target")).alias("is_vulnerable"), "path", "row_pos"
    ).filter(longer_than(F.col("raw_code"), 20))


def generic(df: DataFrame, code_field: str = "func", label_field: str = "target") -> DataFrame:
    """Preferred fields, then fallbacks; the first label that is not zero; longer than 10 characters."""
    codes = [F.col(f) for f in (code_field, "func", "code", "functionSource", "raw_code")]
    labels = [_label(f) for f in (label_field, "target", "label", "is_vulnerable")]
    return good_lines(df).select(
        n.first_nonempty(*codes).alias("raw_code"), n.first_nonzero(*labels).alias("is_vulnerable"), "path", "row_pos"
    ).filter(longer_than(F.col("raw_code"), 10))


def func_label(df: DataFrame) -> DataFrame:
    """``func`` (or its other names) with a label that must be 0 or 1."""
    code = n.first_nonempty(F.col("func"), F.col("code"), F.col("processed_func"))
    label = F.coalesce(_number("target"), _number("label"), _number("is_vulnerable"))
    kept = good_lines(df).withColumn("_label", label).filter(code.isNotNull() & F.col("_label").isin(0.0, 1.0))
    return kept.select(code.alias("raw_code"), F.col("_label").cast("int").alias("is_vulnerable"), "path", "row_pos")


def passthrough(df: DataFrame) -> DataFrame:
    """Records already in the target form, with their category."""
    return good_lines(df).select("raw_code", _label("is_vulnerable").alias("is_vulnerable"), "owasp_category", "path", "row_pos")


def longer_than(code: Column, chars: int) -> Column:
    return F.coalesce(F.length(code) > chars, F.lit(False))


def standard_records(df: DataFrame, source: str) -> DataFrame:
    """Any JSON line as (raw_code, label text, source, path, language, group id); incomplete rows drop."""
    return good_lines(df).select(
        n.first_nonblank(*[F.col(f) for f in fixed.CODE_FIELDS]).alias("raw_code"),
        n.first_present(*[F.col(f) for f in fixed.LABEL_FIELDS]).alias("is_vulnerable"),
        F.lit(source).alias("source"),
        "path",
        F.coalesce("language", F.lit("")).alias("language"),
        F.coalesce(n.first_present(*[F.col(f) for f in fixed.GROUP_FIELDS]), F.lit("")).alias("group_id"),
        "row_pos",
    ).na.drop(subset=["raw_code", "is_vulnerable"])
