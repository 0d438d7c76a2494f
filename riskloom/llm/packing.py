"""Variable-capacity best-fit packing of documents into training sequences.

Pieces (documents, cut at the largest permitted length) are placed in order of falling length into the open
sequence with the least room that holds them. If none does, a new one is opened: of all permitted sizes the
one whose cost for each token that it can still be filled with is least. At the end each sequence shrinks to
the smallest permitted size that holds its contents.

Placement depends on lengths alone, so it is planned on the histogram of lengths, which has no more entries
than the largest size however many documents there are. The plan says, for runs of pieces of one length, which
run of sequences takes them; each piece finds its place by its rank among pieces of its length. Ranks are
numbered in slices, so that a length that a third of all pieces share is not ranked in one task.

Defined results: lengths null, zero or negative get one piece of length 0 outside all sequences (null bin);
repeated rows are separate pieces; ties are ordered by doc_id, then piece; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import staged

SIZES = (512, 1024, 2048, 4096)
# Cost of a sequence of n tokens: n * (1 + n / SCALE), as attention adds a square term.
SCALE = 16384.0
SLICES = 1024


def cost(size: int) -> float:
    return size * (1 + size / SCALE)


@dataclass
class Plan:
    """Runs of pieces: ``rank`` to the next run's, of ``length``; ``each`` pieces to a sequence from ``bin`` on, from ``offset`` on."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: np.ndarray  # first sequence of each run of sequences of one final size
    sizes: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, its size and the offset within it of each piece."""
        key = self.length.astype(np.int64) << 40 | self.rank
        at = np.searchsorted(key, length.astype(np.int64) << 40 | rank, "right") - 1
        nth = rank - self.rank[at]
        bin_ = self.bin[at] + nth // self.each[at]
        return bin_, self.sizes[np.searchsorted(self.bins, bin_, "right") - 1], self.offset[at] + nth % self.each[at] * length


def _fill(size: int, length: int, left: dict[int, int], mask: int) -> tuple[int, list[tuple[int, int]]]:
    """Contents of a new sequence: the longest remaining pieces that fit, starting with ``length``."""
    room, taken = size - length, [(length, 1)]
    below = min(room, length)
    while below > 0:
        low = mask & ((1 << (below + 1)) - 1)
        if not low:
            break
        l = low.bit_length() - 1
        have = left[l] - (1 if l == length else 0)
        n = min(have, room // l)
        if n > 0:
            taken.append((l, n))
            room -= n * l
        below = min(room, l - 1)
    return size - room, taken


def plan(histogram: dict[int, int], sizes: Sequence[int] = SIZES) -> Plan:
    """Place ``histogram[length]`` pieces of each length. Work and result are bounded by the largest size alone."""
    sizes = sorted(sizes)
    left = {l: n for l, n in histogram.items() if n}
    mask = 0
    for l in left:
        mask |= 1 << l
    runs: list[tuple[int, int, int, int, int]] = []
    open_runs: dict[int, list[tuple[int, int, int]]] = {}  # by room: first sequence, how many, size when opened
    rooms = 0
    next_bin = 0

    def put(room: int, run: tuple[int, int, int]) -> None:
        nonlocal rooms
        open_runs.setdefault(room, []).append(run)
        rooms |= 1 << room

    for l in sorted(left, reverse=True):
        n, rank = left[l], 0
        while n:
            fitting = rooms >> l
            if not fitting:
                choices = []
                for size in sizes:
                    if size >= l:
                        content, taken = _fill(size, l, left, mask)
                        final = next(s for s in sizes if s >= content)
                        choices.append((cost(final) / content, -size, taken))
                _, size, taken = min(choices, key=lambda c: c[:2])
                size = -size
                # As many alike as the remaining pieces can fill in the same way.
                each = max(1, sum(k for length, k in taken if length == l))
                alike = min([left[length] // k for length, k in taken if length != l] + [-(-n // each)])
                put(size, (next_bin, max(1, alike), size))
                next_bin += max(1, alike)
                continue
            room = l + (fitting & -fitting).bit_length() - 1
            first, count, size = open_runs[room].pop()
            if not open_runs[room]:
                rooms &= ~(1 << room)
            each = room // l
            full = min(count, n // each)
            if full:
                runs.append((l, rank, first, each, size - room))
                put(room - each * l, (first, full, size))
                n, rank = n - full * each, rank + full * each
            if full < count:
                if n:  # fewer than fill one more sequence
                    runs.append((l, rank, first + full, n, size - room))
                    put(room - n * l, (first + full, 1, size))
                    left[l] = n = 0
                    if full + 1 < count:
                        put(room, (first + full + 1, count - full - 1, size))
                else:
                    put(room, (first + full, count - full, size))
            left[l] = n
        mask &= ~(1 << l)
    final = sorted((first, next(s for s in sizes if s >= size - room)) for room, ranges in open_runs.items() for first, _, size in ranges)
    runs.sort()
    column = lambda rows, i: np.array([r[i] for r in rows], np.int64)
    return Plan(*[column(runs, i) for i in range(5)], column(final, 0), column(final, 1))


def ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank``, from 0, among the pieces of the same length."""
    sliced = pieces.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)))
    counts = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_slice")) - F.col("_n")
    own = F.row_number().over(Window.partitionBy("length", "_slice").orderBy("doc_id", "piece")) - 1
    return sliced.withColumn("_own", own).join(counts.withColumn("_before", before).drop("_n"), ["length", "_slice"]).select(
        "doc_id", "piece", "length", (F.col("_before") + F.col("_own")).cast("long").alias("rank")
    )


def pack(lengths: DataFrame, sizes: Sequence[int] = SIZES) -> DataFrame:
    """doc_id, piece, n_tokens, bin_id, bin_size and bin_offset of each piece, from doc_id and n_tokens."""
    spark = lengths.sparkSession
    largest = max(sizes)
    n = F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0))
    last = F.greatest(F.ceil(n / largest).cast("long") - 1, F.lit(0))
    pieces = lengths.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("_n"), F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(largest), F.col("_n") - F.col("piece").cast("long") * largest).cast("int").alias("length")
    )
    pieces = staged(pieces, "pieces")  # lengths may be costly, and are read three times
    histogram = {r.length: r.n for r in pieces.filter("length > 0").groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``largest`` rows
    shared = spark.sparkContext.broadcast(plan(histogram, sizes))  # bounded by the largest size, not by the documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            some = length > 0
            found = [np.zeros(len(length), np.int64) for _ in range(3)]
            if some.any():
                for out, values in zip(found, shared.value.place(length[some], rank[some])):
                    out[some] = values
            placed = [pa.array(v.astype(t), mask=~some) for v, t in zip(found, (np.int64, np.int32, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *placed], ["doc_id", "piece", "n_tokens", "bin_id", "bin_size", "bin_offset"])

    return ranked(pieces).mapInArrow(run, "doc_id long, piece int, n_tokens int, bin_id long, bin_size int, bin_offset int")
