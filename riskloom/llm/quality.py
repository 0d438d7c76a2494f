"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that the fit sees. It minimises the non-negative
unbiased risk of a linear logistic model,

    prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)]),

by damped Newton steps whose sums over all documents Spark adds up; only those sums (a few hundred numbers)
reach the driver. The class prior is estimated first: a model of positives against unlabelled text
orders all documents, and the prior is the least ratio of unlabelled to positive mass above a score.

Defined results: null or empty texts have all counts zero and are scored like others; without any positives
all scores are 0.5; repeated rows count as often as they occur; columns other than those named are ignored.
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

FEATURES = (
    "log_words", "log_word_length", "upper", "digits", "spaces", "line_ends", "letters", "wide", "stops", "commas", "marks", "bars",
    "bangs", "symbols", "marked_words", "capital_words", "upper_words", "short_words", "long_words", "repeated_next", "distinct_words",
    "distinct_lines", "words_per_line", "same_ends", "none",
)
CLASSES = {
    "upper": range(65, 91), "digits": range(48, 58), "spaces": (9, 11, 12, 13, 32), "line_ends": (10,), "letters": range(97, 123),
    "wide": range(128, 256), "stops": b".?;:", "commas": b",", "marks": b"#$%&*@^~=+<>\\_/{}[]", "bars": b"|", "bangs": b"!",
    "symbols": b"\"'()-`",
}


def _byte_classes() -> np.ndarray:
    table = np.zeros((len(CLASSES), 256), np.float64)
    for row, values in enumerate(CLASSES.values()):
        table[row, list(values)] = 1
    return table


BYTE_CLASSES = _byte_classes()


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Different values in each document."""
    doc = arrays.doc_numbers(bounds)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=len(bounds) - 1).astype(np.float64)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text; every feature is a share or a logarithm, so that length alone decides little."""
    docs = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    key = arrays.doc_numbers(offsets) * 256 + data
    counts = np.bincount(key, minlength=docs * 256).reshape(docs, 256) @ BYTE_CLASSES.T
    shares = counts / np.maximum(size, 1)[:, None]
    starts, ends, bounds = arrays.words(data, offsets)
    n = np.diff(bounds).astype(np.float64)
    some = np.maximum(n, 1)
    sums = arrays.prefix_sums(data)
    hashes = arrays.stretch_hashes(sums, starts, ends)
    length = ends - starts
    first, last = (data[starts], data[ends - 1]) if len(starts) else (np.zeros(0, np.uint8),) * 2
    upper = (first >= 65) & (first < 91)
    doc = arrays.doc_numbers(bounds)
    uppers = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    alike = np.zeros(len(hashes), bool)
    same_end = np.zeros(len(hashes), bool)
    if len(hashes):
        near = doc[1:] == doc[:-1]
        alike[1:] = near & (hashes[1:] == hashes[:-1])
        letter = (last >= 97) & (last < 123) | (last >= 128)
        same_end[1:] = near & (last[1:] == last[:-1]) & ~letter[1:]
    marked = np.zeros(256, bool)
    marked[list(b"#$%&*@^~=+<>|!_")] = True
    word = lambda values: _per_doc(values, bounds) / some
    edges = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    lines = np.searchsorted(edges, offsets)
    line_hash = arrays.stretch_hashes(sums, edges[:-1], edges[1:]) if len(edges) > 1 else np.zeros(0, np.uint64)
    n_lines = np.maximum(np.diff(lines), 1).astype(np.float64)
    rows = np.column_stack([
        np.log1p(n), np.log1p(_per_doc(length, bounds) / some), shares, word(marked[last]), word(upper),
        word((uppers[ends] - uppers[starts] >= 2) & (uppers[ends] - uppers[starts] >= 0.6 * length)), word(length <= 2), word(length >= 16),
        word(alike), _distinct(hashes, bounds) / some, _distinct(line_hash, lines) / n_lines, np.log1p(n / n_lines), word(same_end),
        (n == 0).astype(np.float64),
    ])
    return rows


def featured(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``x``, the features of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            rows = text_features(*arrays.text_bytes(batch.column(batch.num_columns - 1)))
            flat = pa.array(rows.astype(np.float32).ravel())
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], [*keep, "x"])

    source = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(run, f"{kinds}, x array<float>")


@dataclass(frozen=True)
class Model:
    """A linear logistic score over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([z, np.ones(len(z))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), len(FEATURES))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _summed(table: DataFrame, length: int, function) -> np.ndarray:
    """The sum over all rows of ``function(x, positive)``: each task sums its rows, Spark adds up the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += function(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], ["i", "v"])

    parts = table.select("x", "positive").mapInArrow(run, "i long, v double")
    out = np.zeros(length)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # ``length`` rows
        out[row.i] = row.v
    return out


BINS = 2000
CORNER = 0.005


def _prior(table: DataFrame, model: Model, least_mass: float) -> float:
    """Least ratio of unlabelled to positive mass above a score, among scores above which enough positives lie."""

    def histogram(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        at = np.clip((_sigmoid(model.margin(x)) * BINS).astype(np.int64), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[positive], minlength=BINS)]).astype(np.float64)

    counts = _summed(table, 2 * BINS, histogram)
    all_above = np.cumsum(counts[:BINS][::-1])
    pos_above = np.cumsum(counts[BINS:][::-1])
    n, p = all_above[-1], pos_above[-1]
    ratio, mass = all_above / n, pos_above / p
    slack = np.sqrt(1 / np.maximum(pos_above, 1)) + np.sqrt(1 / np.maximum(all_above, 1))  # one standard error
    usable = mass >= least_mass
    estimate = ratio / np.maximum(mass, 1e-9)
    best = np.where(usable, estimate * (1 + slack), np.inf).argmin()  # chosen with its error, reported without
    return float(np.clip(estimate[best], 0.01, 0.99))


def _newton(table: DataFrame, model: Model, n: float, p: float, prior: float | None, passes: int, ridge: float) -> Model:
    """Newton steps, halved until the risk falls; each trial is one pass over the documents.

    Without a prior: positives against unlabelled text. With one: the non-negative unbiased risk.
    """
    d = len(FEATURES) + 1
    keep = np.full(d, ridge)
    keep[-1] = 1e-6

    def measured(w: np.ndarray) -> tuple[float, np.ndarray]:
        """The penalised risk at w, and the Newton step from it."""
        now = Model(model.mean, model.scale, w, 0.5)

        def sums(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            a = now.design(x)
            z = a @ w
            s = _sigmoid(z)
            q = s * (1 - s)
            loss = np.logaddexp(0, z)  # l(-z); l(z) is that less z
            b, sp, qp = a[positive], s[positive], q[positive]
            h_all, h_pos = (a * q[:, None]).T @ a, (b * qp[:, None]).T @ b
            return np.concatenate([s @ a, h_all.ravel(), sp @ b, b.sum(0), h_pos.ravel(), [loss.sum(), loss[positive].sum()]])

        out = _summed(table, 3 * d + 2 * d * d + 2, sums)
        g_all, h_all = out[:d] / n, out[d : d + d * d].reshape(d, d) / n
        rest = out[d + d * d :]
        g_pos, one_pos, h_pos = rest[:d] / p, rest[d : 2 * d] / p, rest[2 * d : 2 * d + d * d].reshape(d, d) / p
        loss_all, loss_pos = out[-2] / n, out[-1] / p
        right_pos = loss_pos - one_pos @ w  # E_p[l(z)]
        if prior is None:
            risk, gradient, hessian = (loss_all + right_pos) / 2, (g_all + g_pos - one_pos) / 2, (h_all + h_pos) / 2
        else:
            negative, slope = loss_all - prior * loss_pos, g_all - prior * g_pos
            # max(0, negative), rounded off within CORNER so that Newton steps see where it bends.
            weight = float(_sigmoid(np.float64(negative / CORNER)))
            risk = prior * right_pos + CORNER * float(np.logaddexp(0, negative / CORNER))
            gradient = prior * (g_pos - one_pos) + weight * slope
            hessian = prior * (1 - weight) * h_pos + weight * h_all + weight * (1 - weight) / CORNER * np.outer(slope, slope)
        step = np.linalg.solve(hessian + np.diag(keep), gradient + keep * w)
        return risk + float(keep @ (w * w)) / 2, step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-9))

    w = model.weights
    risk, step = measured(w)
    share = 1.0
    for _ in range(passes - 1):
        trial = w - share * step
        found, following = measured(trial)
        if found < risk:
            small = risk - found < 1e-6
            w, risk, step, share = trial, found, following, 1.0
            if small:
                break
        else:
            share /= 2
            if share < 1 / 64:
                break
    return Model(model.mean, model.scale, w, prior if prior is not None else 0.5)


def fit(table: DataFrame, passes: int = 16, ridge: float = 1e-3, least_mass: float = 0.3) -> Model:
    """Fit on a written table of ``x`` and ``positive`` (true for trusted positives; every row is unlabelled text too)."""
    d = len(FEATURES)
    out = _summed(table, 2 * d + 2, lambda x, positive: np.concatenate([x.sum(0), (x * x).sum(0), [len(x), positive.sum()]]))
    n, p = out[-2], out[-1]
    mean = out[:d] / max(n, 1)
    scale = np.sqrt(np.maximum(out[d : 2 * d] / max(n, 1) - mean**2, 0)) + 1e-3
    start = Model(mean, scale, np.zeros(d + 1), 0.5)
    if p == 0:
        return start
    prior = _prior(table, _newton(table, start, n, p, None, passes, ridge), least_mass)
    return _newton(table, start, n, p, prior, passes, ridge)


def scored(table: DataFrame, model: Model) -> DataFrame:
    """Replace ``x`` by ``score``, the probability of good quality."""
    names = [c for c in table.columns if c not in ("x", "positive")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _sigmoid(model.margin(_matrix(batch.column(batch.num_columns - 1)))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*names, "score"])

    source = table.select(*names, "x")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(run, f"{kinds}, score double")


def training_fold(folds: int = 3, held_out: int = 1) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds != held_out


def learnt(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """The features of all documents, in a written table, and the model fitted on them."""
    good = labels.filter("quality = 1").filter(training_fold()).select(F.col("doc_id").cast("long").alias("_good")).distinct()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = staged(featured(ids, "doc_id"), "quality")
    marked = staged(table.join(good, table.doc_id == good._good, "left").select("doc_id", "x", F.col("_good").isNotNull().alias("positive")), "quality-marked")
    return marked, fit(marked)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; positives are the good labels of the training folds."""
    marked, model = learnt(docs, labels)
    return scored(marked, model).select(
        "doc_id", (~training_fold()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``least``, unchanged. Texts are scored where they are read and not shuffled."""
    _, model = learnt(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            score = _sigmoid(model.margin(text_features(*arrays.text_bytes(batch.column(at))).astype(np.float32).astype(np.float64)))
            yield batch.filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)
