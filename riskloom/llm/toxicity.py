"""Toxicity by character n-grams scaled with naive Bayes log-count ratios.

N-grams of three to nine bytes (odd sizes) of the lower-cased text fall into hashed buckets. A bucket's
ratio is the log of its share among toxic texts over its share among clean texts. A logistic model over presence
times ratio is then fitted. Both are learnt from a bounded sample of labelled rows, ``MAX_ROWS`` of each class at
most; scores cover every document.

Defined results: null and empty texts have no n-grams and get the score of the constant; without labels of both
classes all scores are 0.5; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import arrays
from riskloom.session import staged

BITS = 20
BUCKETS = 1 << BITS
SIZES = (3, 5, 7, 9)
# At most so many labelled rows of each class are learnt from, those with the smallest hashes of doc_id.
MAX_ROWS = 6000
# Pseudo-texts added to each class, equally likely in both.
SMOOTH = 2.0
# Ratios nearer to zero than this say little about the class and are taken as zero.
LEAST_RATIO = 1.2


def buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n, the hashed n-grams of a slice and the number of their document; none crosses documents."""
    data = arrays.LOWER[data]
    data = np.where(arrays.SPACE[data], np.uint8(32), data)
    sums = arrays.prefix_sums(data)
    _, down = arrays._powers(len(sums))
    doc = arrays.doc_numbers(offsets).astype(np.int32)
    left = offsets[1:][doc] - np.arange(len(data))
    for n in SIZES:
        if len(data) < n:
            continue
        hashed = (sums[n:] - sums[:-n]) * down[: len(data) - n + 1]
        hashed ^= hashed >> np.uint64(32)
        hashed *= arrays.BASE
        inside = left[: len(hashed)] >= n
        yield (hashed >> np.uint64(64 - BITS)).astype(np.int32)[inside], doc[: len(hashed)][inside]


def presences(column: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of the texts of a column, each pair once; with ``kept`` only its true buckets."""
    pairs = []
    for hashed, doc in buckets(*arrays.text_bytes(column)):
        if kept is not None:
            some = np.flatnonzero(kept[hashed])
            hashed, doc = hashed[some], doc[some]
        pairs.append(doc.astype(np.int64) << BITS | hashed)
    pairs = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    if len(pairs):
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
    return pairs >> BITS, pairs & (BUCKETS - 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by bucket, the ratio multiplied in
    constant: float


def _ratios(rows: DataFrame) -> np.ndarray | None:
    """Log-count ratios over all rows of ``text`` and ``toxic``: each task adds up its rows by bucket and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1))  # the last counts texts
        for batch in arrays.slices(batches, "text"):
            label = batch.column(1).to_numpy(zero_copy_only=False)
            doc, found = presences(batch.column(0))
            for c in (0, 1):
                counts[c, :BUCKETS] += np.bincount(found[label[doc] == c], minlength=BUCKETS)
                counts[c, BUCKETS] += (label == c).sum()
        some = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bucket", "clean", "toxic"])

    parts = rows.select("text", "toxic").mapInArrow(run, "bucket int, clean double, toxic double")
    summed = staged(parts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-counts")
    texts = summed.filter(F.col("bucket") == BUCKETS).first()
    if texts is None or not texts.clean or not texts.toxic:
        return None
    least = min(texts.clean, texts.toxic)
    shares = [(F.col(c) + SMOOTH * texts[c] / least) / (texts[c] + 2 * SMOOTH * texts[c] / least) for c in ("toxic", "clean")]
    strong = summed.filter(F.col("bucket") < BUCKETS).select("bucket", F.ln(shares[0] / shares[1]).alias("ratio")).filter(F.abs("ratio") >= LEAST_RATIO)
    part = strong.toPandas()  # a number for each bucket at most
    ratios = np.zeros(BUCKETS)
    ratios[part.bucket.to_numpy()] = part.ratio.to_numpy()
    return ratios


def _sample(rows: DataFrame, ratios: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Label and distinct buckets of the training sample."""
    shared = rows.sparkSession.sparkContext.broadcast(ratios != 0)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            doc, found = presences(batch.column(0), shared.value)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            cut = [found[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(cut, pa.binary())], ["toxic", "found"])

    out = rows.select("text", "toxic").mapInArrow(run, "toxic int, found binary").collect()  # bounded by MAX_ROWS
    return [(r.toxic, np.frombuffer(r.found, np.int32)) for r in out]


def _logistic(sample: list[tuple[int, np.ndarray]], ratios: np.ndarray, steps: int = 200, rate: float = 0.03, ridge: float = 1e-3) -> Model:
    """Full-batch descent with momentum. A text is its present buckets, each with the bucket's ratio as its value."""
    y = np.array([label for label, _ in sample], np.float64)
    index = np.concatenate([found for _, found in sample])
    row = np.repeat(np.arange(len(sample)), [len(found) for _, found in sample])
    used, at = np.unique(index, return_inverse=True)
    r = ratios[used]
    value = r[at]
    w, b = np.full(len(used), 0.01), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, value * w[at], len(sample)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.bincount(at, value * error[row], len(used)) + ridge * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w = w - rate * fix * m / (np.sqrt(v) + 1e-8)
        b = b - 10 * rate * fix * mb / (np.sqrt(vb) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = w * r
    return Model(weights, float(b))


def fit(rows: DataFrame) -> Model:
    """Fit on a bounded, written table of text and toxic (0 or 1)."""
    ratios = _ratios(rows)
    return Model(np.zeros(BUCKETS), 0.0) if ratios is None else _logistic(_sample(rows, ratios), ratios)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each document, over its whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # fixed size: a number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kept = model.weights != 0
        for batch in arrays.slices(batches, "text"):
            doc, found = presences(batch.column(1), kept)
            z = np.bincount(doc, model.weights[found], batch.num_rows) + model.constant
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, score double")


def training_fold(folds: int = 5, held_out: int = 0) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds != held_out


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_ROWS) -> DataFrame:
    """text and toxic of at most ``limit`` labelled rows of each class in the training folds.

    A document with several labels counts once, as toxic if any says so. The chosen labels are broadcast, as their
    number is bounded; texts are not shuffled.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(training_fold()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    first, second = [known.filter(F.col("toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(limit) for label in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(first.unionByName(second)), "_id").select("text", "toxic")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    rows = staged(training_rows(docs, labels), "toxic-training")
    return scored(docs, fit(rows)).select(
        "doc_id", (~training_fold()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
