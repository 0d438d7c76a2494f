"""Text files read in ranges of bytes by several tasks, though their records lie across ranges.

Spark's text reader cuts files at a separator of one's choice and deals out ranges of bytes. A piece between two separators changes a
reader's state (inside quotes or not) in a way that does not depend on where the piece stands: from either state it leads to a known one.
Running compositions of these steps give each range's own step, composing those of a file's ranges gives the state in which each range
begins, and from it the state at every piece. Only numbers move for that, and a row for each range is written. Then pieces move once, to the rows of their range, where
records are put together; the few that cross an edge are joined from the fragments at both sides.

A range is one task's work and memory, however long the file; a record is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from riskloom.session import staged
from riskloom.sources.text_lines import ROW_BITS, source_path

RANGE = ("path", "split")


def ordered() -> WindowSpec:
    """The pieces of a range in their order."""
    return Window.partitionBy(*RANGE).orderBy("row")


def upto() -> WindowSpec:
    return ordered().rowsBetween(Window.unboundedPreceding, 0)


def pieces(spark: SparkSession, path: str, separator: str, **options: str) -> DataFrame:
    """The pieces between separators: value, path, split (first byte of the range), row (place in the range), bytes, file_size, and the file's ``opening``."""
    lines = spark.read.options(**options).option("lineSep", separator).text(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return lines.select(
        "value", source_path().alias("path"), F.col("_metadata.file_block_start").alias("split"), row.alias("row"),
        F.col("_metadata.file_size").alias("file_size"), (F.octet_length("value") + F.lit(len(separator.encode()))).alias("bytes"),
        F.when(F.col("_metadata.file_block_start") == 0, F.left("value", F.lit(64))).alias("opening"))


def with_states(df: DataFrame, from0: Column, from1: Column, along: WindowSpec | None = None) -> DataFrame:
    """Add before0/after0 and before1/after1: the states around each piece if its range begins in state 0 or 1.

    A step from ``from0`` and ``from1`` keeps the state, swaps it, or forces one. So the state is the last forced one, or else the first,
    swapped as often as swaps came since.
    """
    along = along if along is not None else ordered()
    window = along.rowsBetween(Window.unboundedPreceding, 0)
    parity = F.sum(F.when((from0 == 1) & (from1 == 0), 1).otherwise(0)).over(window) % 2
    df = df.withColumns({"_parity": parity, "_forced": F.when(from0 == from1, from0)})
    unswapped = F.when(F.col("_forced").isNotNull(), F.col("_forced").bitwiseXOR(F.col("_parity")))
    df = df.withColumn("_last", F.last(unswapped, ignorenulls=True).over(window))
    df = df.withColumns({f"after{h}": F.col("_parity").bitwiseXOR(F.coalesce("_last", F.lit(h).cast("long"))) for h in (0, 1)})
    return df.withColumns({f"before{h}": F.lag(f"after{h}", 1, h).over(along) for h in (0, 1)}).drop("_parity", "_forced", "_last")


def range_starts(df: DataFrame, sums: tuple[str, ...] = ()) -> DataFrame:
    """A written row for each range: its first state (``start``), the file's last (``final``), bytes of the file and its last range.

    ``df`` has states and, for each name of ``sums``, columns name0 and name1: what a piece adds if its range begins in state 0 or 1. The
    result has ``name`` (the sum before the range) and ``name_final``.
    """
    totals = [F.sum(f"{s}{h}").alias(f"{s}{h}") for s in sums for h in (0, 1)]
    ends = [F.max_by(f"after{h}", "row").alias(f"from{h}") for h in (0, 1)]
    ranges = df.groupBy(*RANGE).agg(
        *ends, *totals, F.sum("bytes").alias("bytes"), F.max("file_size").alias("file_size"), F.min_by("opening", "row").alias("opening"))
    along = Window.partitionBy("path").orderBy("split")
    before, file = along.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("path")
    ranges = with_states(ranges, F.col("from0"), F.col("from1"), along).withColumn("start", F.col("before0"))
    for s in sums:
        ranges = ranges.withColumn("_own", F.when(F.col("start") == 0, F.col(f"{s}0")).otherwise(F.col(f"{s}1")))
        ranges = ranges.withColumns({s: F.sum("_own").over(before) - F.col("_own"), f"{s}_final": F.sum("_own").over(file)})
    ranges = ranges.select(
        *RANGE, "start", *sums, *[f"{s}_final" for s in sums], F.max_by("after0", "split").over(file).alias("final"),
        F.sum("bytes").over(file).alias("read"), "file_size", F.max("split").over(file).alias("last_split"), F.min_by("opening", "split").over(file).alias("opening"))
    return staged(ranges, "range-starts")


def at_range_start(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """``df`` with its ranges' starts and the states ``before`` and ``after`` each piece; its rows stay where they are."""
    joined = df.drop("file_size", "bytes", "opening").join(ranges, list(RANGE))
    return joined.withColumns({c: F.when(F.col("start") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("before", "after")})


def damaged_files(ranges: DataFrame, damaged: Column, broken: DataFrame | None) -> DataFrame:
    """path and damaged of each file; ``broken`` (path) names files that could not be read to their end, or not at all."""
    files = ranges.filter(F.col("split") == F.col("last_split")).select("path", damaged.alias("damaged"))
    if broken is None:
        return files
    return files.join(broken.select("path", F.lit(True).alias("broken")), "path", "full").select("path", F.coalesce("broken", "damaged").alias("damaged"))


def last_piece() -> Column:
    """Whether a piece is the last of its file."""
    return (F.col("split") == F.col("last_split")) & F.lead("row").over(ordered()).isNull()


def records(df: DataFrame, separator: str, files: DataFrame) -> DataFrame:
    """Pieces joined up to each piece with ``ends``: path, split and row of that piece, text, ``first`` (of its file), ``finished``.

    What follows a file's last end is one row with ``finished`` false, if there is anything, or if ``files`` (path, damaged) says that the file is damaged.
    """
    # Records are numbered by the ends before a piece, a running count; a window that looks ahead would take each range's pieces squared.
    before = F.sum(F.when(F.col("ends"), 1).otherwise(0)).over(ordered().rowsBetween(Window.unboundedPreceding, -1))
    keyed = df.withColumns({"_record": F.coalesce(before, F.lit(0).cast("long")), "_first": (F.col("split") == 0) & F.lag("row").over(ordered()).isNull()})
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "value"))), lambda p: p["value"]), separator)
    groups = keyed.groupBy(*RANGE, "_record").agg(joined.alias("text"), F.max(F.when(F.col("ends"), F.col("row"))).alias("_end"), F.max("_first").alias("first"))
    inside = (F.col("_record") > 0) & F.col("_end").isNotNull()
    inner = groups.filter(inside)
    edge = groups.filter(~inside).withColumn("damaged", F.lit(False)).drop("_record")
    closing = files.select(
        "path", F.lit((1 << 62)).cast("long").alias("split"), F.lit(None).cast("long").alias("_end"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("first"), "damaged")
    fragments = edge.unionByName(closing)
    # A fragment without an end belongs to the next range that has one. In a range, what ends comes before what does not.
    ahead = Window.partitionBy("path").orderBy(F.desc("split"), F.col("_end").isNull().desc()).rowsBetween(Window.unboundedPreceding, 0)
    owned = fragments.withColumn("_owner", F.last(F.when(F.col("_end").isNotNull(), F.col("split")), ignorenulls=True).over(ahead))
    # Of what no end follows, the first fragment stands for all.
    again = F.lag(F.col("_owner").isNull()).over(Window.partitionBy("path").orderBy("split", F.col("_end").isNull()))
    owned = owned.withColumn("text", F.when(F.col("_owner").isNotNull() | ~F.coalesce(again, F.lit(False)), F.col("text")))
    part = F.struct("split", F.col("_end").isNull().alias("open"), "text")
    none = F.lit(1 << 62).cast("long")
    across = owned.groupBy("path", F.coalesce("_owner", none).alias("_owner")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["text"]), separator).alias("text"), F.min("split").alias("split"),
        F.max("_end").alias("row"), F.max("first").alias("first"), F.max("damaged").alias("damaged"), F.count("text").alias("parts"))
    finished = F.col("_owner") != none
    across = across.filter(finished | (F.col("parts") > 0) | F.col("damaged")).select(
        "path", F.when(finished, F.col("_owner")).otherwise(F.col("split")).alias("split"), F.coalesce("row", F.lit((1 << ROW_BITS) - 1).cast("long")).alias("row"), "text", "first",
        finished.alias("finished"), "damaged")
    whole = inner.select(*RANGE, F.col("_end").alias("row"), "text", "first", F.lit(True).alias("finished"), F.lit(False).alias("damaged"))
    return whole.unionByName(across)
