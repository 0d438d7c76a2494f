"""Which files of a collection cannot be read to their end, so that they are counted and all others are read."""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# With this, Spark keeps what it read of a file up to the damage and goes on with the next.
READ_ON = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
STEP = 1 << 20


def problem(name: str, data: memoryview) -> str | None:
    """What is wrong with a compressed file, found by unpacking it piece by piece; several members may follow each other."""
    new = bz2.BZ2Decompressor if name.endswith(".bz2") else lambda: zlib.decompressobj(31)
    unpack, rest, at, begun = new(), b"", 0, False
    try:
        while rest or at < len(data):
            if not rest:
                rest, at = bytes(data[at : at + STEP]), at + STEP
            if unpack.eof:
                rest = rest.lstrip(b"\0")  # padding between or behind members
                if not rest:
                    continue
                unpack, begun = new(), False
            unpack.decompress(rest)
            begun, rest = True, unpack.unused_data if unpack.eof else b""
    except (OSError, EOFError, zlib.error) as error:
        return f"damaged: {error}"
    return "truncated" if begun and not unpack.eof else None


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """path and problem of the compressed files that are damaged or cut off.

    Such files cannot be split, so each is one task's work here as it is for any reader.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [problem(name, memoryview(batch.column(1)[i].as_buffer() or b"")) for i, name in enumerate(names)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["path", "problem"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,bz2}").load(path)
    named = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "content")
    return named.mapInArrow(look, "path string, problem string").filter(F.col("problem").isNotNull())
