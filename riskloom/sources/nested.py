"""Paired and nested records: arrays of JSON objects, before/after pairs, CVE trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import normalise as n
from riskloom.schemas import PAIRED
from riskloom.session import settled
from riskloom.sources import ranges


CORRUPT = "_corrupt"


def _balance(text: Column) -> Column:
    """Opening less closing brackets of a text without strings."""
    return F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))


def json_array(spark: SparkSession, path: str, schema: T.StructType = PAIRED, corrupt: bool = False, position: bool = False, broken: DataFrame | None = None, **options: str) -> DataFrame:
    """Objects of JSON array files, read in ranges by several tasks however large a file is; files of objects alone are read too.

    Files are cut at closing braces. Whether a piece begins inside a string and how deep it is nested is carried across pieces and
    ranges; a brace outside strings that leads back to the array's depth ends an object.

    A row of nulls stands for each object that cannot be parsed and for each file that is not closed or goes on after its end; objects
    before the damage are kept. With ``corrupt``, ``_corrupt`` has the text of such rows; with ``position``, ``path`` and ``row_pos``
    (path, first byte of the range, place) sort in file order. Files that ``broken`` (path) names count as not closed.
    """
    df = ranges.pieces(spark, path, "}", **options)
    df = df.withColumn("_bare", F.regexp_replace("value", r"(?s)\\.", ""))  # escapes stand in strings only
    rest = F.regexp_replace("_bare", r'^[^"]*("|\z)', "")
    quotes = (F.length("_bare") - F.length(F.replace("_bare", F.lit('"'), F.lit("")))) % 2
    outside = [F.regexp_replace(text, r'"[^"]*("|\z)', "") for text in (F.col("_bare"), rest)]
    # The brace behind a piece closes something if the piece ends outside strings.
    step = [(_balance(text) - F.when(quotes == h, 1).otherwise(0)).alias(f"step{h}") for h, text in enumerate(outside)]
    df = settled(df.select("*", quotes.alias("quotes"), *step).drop("_bare"), {})
    df = ranges.with_states(df, F.col("quotes"), 1 - F.col("quotes"))
    df = df.withColumns({f"depth{h}": F.when(F.col(f"before{h}") == 0, F.col("step0")).otherwise(F.col("step1")) for h in (0, 1)})
    starts = ranges.range_starts(df, ("depth",))
    # A file that ends well has one brace too few behind its last piece, or none.
    damaged = (F.col("final") != 0) | ~F.col("depth_final").isin(0, -1)
    files = ranges.damaged_files(starts, damaged, broken)

    df = ranges.at_range_start(df, starts)
    depth = F.col("depth") + F.sum(F.when(F.col("before") == 0, F.col("step0")).otherwise(F.col("step1"))).over(ranges.upto())
    base = F.when(F.col("opening").rlike(r"^[\s\x{FEFF}]*\["), 1).otherwise(0)
    # No brace stands behind the last piece if that many bytes were read; a compressed file tells by what the piece is.
    unclosed = F.when(F.col("read") == F.col("file_size"), False).when(F.col("read") == F.col("file_size") + 1, True).otherwise(F.col("value").rlike(r"^[\s\[\]]*\z"))
    ends = (F.col("after") == 0) & (depth == base) & ~(ranges.last_piece() & unclosed)
    found = ranges.records(df.withColumn("ends", ends).select(*ranges.RANGE, "row", "value", "ends"), "}", files)
    found = found.filter("finished OR damaged OR NOT text RLIKE '^[\\\\s\\\\x{FEFF}]*\\\\[?\\\\s*\\\\]?\\\\s*$'")

    body = F.when(F.col("finished"), F.regexp_replace(F.concat("text", F.lit("}")), r"^[\s\x{FEFF}]*[\[,]?\s*", "")).otherwise(F.col("text"))
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # What is left over is no object even if it reads like one.
    parsed = F.from_json(F.when(F.col("finished"), F.make_valid_utf8(body)).otherwise(F.concat(F.lit("!"), F.make_valid_utf8(body))), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    found = settled(found, {"r": parsed})
    rows = found.select("r.*", "path", F.struct("path", "split", "row").alias("row_pos"))
    rows = rows.withColumn(CORRUPT, F.when(F.col(CORRUPT).startswith("!"), F.expr(f"substring({CORRUPT}, 2)")).otherwise(F.col(CORRUPT)))
    return rows.drop(*([] if corrupt else [CORRUPT]), *([] if position else ["path", "row_pos"]))


def array_to_lines(spark: SparkSession, path: str, out: str, schema: T.StructType = PAIRED, files: int = 0) -> None:
    """Rewrite JSON array files as JSON lines, spread over ``files`` files if given."""
    rows = json_array(spark, path, schema)
    (rows.repartition(files) if files else rows).write.json(out)


def from_pairs(df: DataFrame, before: str = "func_before", after: str = "func", min_chars: int = 0) -> DataFrame:
    """Each pair as two rows: the text before the fix is 1, the text after it 0."""
    rest = [c for c in df.columns if c not in (before, after)]
    stacked = df.select(*rest, F.stack(F.lit(2), F.col(before), F.lit(1), F.col(after), F.lit(0)).alias("raw_code", "is_vulnerable"))
    return stacked.filter(F.coalesce(F.length("raw_code") > min_chars, F.lit(False)))


def from_cve_tree(df: DataFrame, source: str | None = None, item: str | None = None) -> DataFrame:
    """Rows of a CVE tree: before 1, after 0, untouched functions 0, with a composed group id.

    The lists of one file are unrolled inside its row, so no join brings them together again. ``item`` names a
    column for the row's place in its tree (commit, file, function), which sorts in the tree's order.
    """
    keep = [c for c in df.columns if c not in ("cve_id", "commits")]
    cve = F.coalesce("cve_id", F.lit(""))
    commits = df.select(*keep, cve.alias("_cve"), F.posexplode("commits").alias("_at_commit", "c"))
    commit = F.coalesce(n.first_nonempty(F.col("c.commit_hash"), F.col("c.id")), F.col("_cve"))
    files = commits.select(*keep, "_cve", "_at_commit", commit.alias("_commit"), F.posexplode("c.files").alias("_at_file", "f"))
    path = F.coalesce("f.file_path", F.lit(""))

    def row(code: Column, label: int, function: Column) -> Column:
        group = n.composed_group(F.col("_cve"), F.col("_commit"), path, function)
        return F.struct(code.alias("raw_code"), F.lit(label).alias("is_vulnerable"), group.alias("group_id"))

    def pair(fn: Column, i: Column) -> Column:
        name = F.coalesce(fn["func_name"], i.cast("string"))
        before = n.first_nonempty(fn["func_before"], fn["before"])
        after = n.first_nonempty(fn["func_after"], fn["func"], fn["after"])
        return F.array(row(before, 1, name), row(after, 0, name))

    def untouched(fn: Column, i: Column) -> Column:
        return row(fn["func"], 0, F.concat(F.lit("non_vul:"), i.cast("string")))

    empty = F.array().cast("array<struct<raw_code:string,is_vulnerable:int,group_id:string>>")
    changed = F.coalesce(F.flatten(F.transform("f.vulnerable_functions", pair)), empty)
    others = F.coalesce(F.transform("f.non_vulnerable_functions", untouched), empty)
    unrolled = files.select(
        *keep, "_at_commit", "_at_file", F.coalesce("f.language", F.lit("")).alias("language"), path.alias("file_path"), F.posexplode(F.concat(changed, others)).alias("_at", "r")
    )
    place = [F.array("_at_commit", "_at_file", "_at").alias(item)] if item else []
    rows = unrolled.select(*keep, "language", "file_path", "r.*", *place).filter(~n.is_blank(F.col("raw_code")))
    return rows.withColumn("source", F.lit(source)) if source else rows
