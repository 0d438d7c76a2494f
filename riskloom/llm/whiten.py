"""Whitening of embeddings from polarised variances, with exact sums.

Entries become integers x. With n vectors and sums S, the centred entry n*x - S is an integer, and so are its square
and the square of the centred sum of two entries. Tasks add up those squares for each dimension and each pair of
dimensions and Spark adds up the tasks; since var(a + b) = var(a) + var(b) + 2 cov(a, b), the variances give every
covariance as an exact fraction, rounded once. The driver sees a row for each pair of dimensions, however many vectors
there are, and finds the eigenvectors. Three more passes read the table: the moments of the whitened vectors, the same
again for the rows, and no pass writes vectors.

Defined results: vectors that are null or hold null or non-finite entries are dropped; empty vectors have no component
and no row; vectors of another length are a fit list of their own; null and repeated ids are rows like others. A component
without variance (fewer different vectors than dimensions, constant entries) has no scale: its ``whitened`` is null
and ``identity_error`` leaves it out (null if none is left). A ``deviation`` that a long cannot hold is null; ``deviation_wide``
has it in any case. Entries of 2**34 and more raise an error, since their squares could not be kept exact. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
COMPONENTS = 32
CHUNK_CELLS = 1 << 20  # pair sums held at once: 8 MB
LIMB = 24
LONGEST = 2**40  # of scaled entries


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """floor(64 * c) of all entries as rows of ``dims``. The offset of 1,000,000 of x cancels in n*x - S, so it is never added."""
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dims)
    if values.size and np.abs(values).max() >= LONGEST:
        raise ArithmeticError(f"an entry of {LONGEST // SCALE} or more cannot be summed exactly")
    return values.astype(np.int64)


def by_length(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch, parted by the length of their vectors."""
    lengths = np.diff(batch.column(batch.schema.get_field_index(column)).offsets.to_numpy())
    if len(lengths) and (lengths == lengths[0]).all():
        if lengths[0]:
            yield int(lengths[0]), batch
        return
    for dims in np.unique(lengths[lengths > 0]):
        yield int(dims), batch.take(pa.array(np.flatnonzero(lengths == dims)))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _added(rows: DataFrame, sums) -> dict[int, list[int]]:
    """Exact totals for each length of vectors; ``sums`` gives each task's own as (dims, slot, value) of Python integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, some in by_length(batch):
                step = max(1, CHUNK_CELLS // (dims * (dims + 1) // 2))
                for at in range(0, some.num_rows, step):
                    part = sums(dims, integers(some.slice(at, step).column(0), dims))
                    totals[dims] = totals[dims] + part if dims in totals else part
        for dims, values in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), dims, np.int32)), pa.array(np.arange(len(values))), pa.array([str(v) for v in values])], ["dims", "slot", "value"]
            )

    parts = rows.select("v").mapInArrow(run, "dims int, slot long, value string")
    totals: dict[int, list[int]] = {}
    # A row for each length and pair of dimensions: their number does not depend on the table.
    for row in parts.groupBy("dims", "slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("dims", "slot").collect():
        totals.setdefault(row.dims, []).append(int(row.value))
    return totals


def _exact(high: np.ndarray, middle: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(object) * (1 << 2 * LIMB) + middle.astype(object) * (1 << LIMB + 1) + low.astype(object)


def squares(values: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of squares in three limbs: with v = h * 2**24 + l, those of h*h, h*l and l*l."""
    high, low = values >> LIMB, values & ((1 << LIMB) - 1)
    if high.size and int(np.abs(high).max()) ** 2 * values.shape[axis] >= 1 << 62:
        raise ArithmeticError("centred entries are too large to be squared exactly")
    return (high * high).sum(axis), (high * low).sum(axis), (low * low).sum(axis)


def totals(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """The number of vectors and the sum of each dimension of floor(64 * c)."""
    found = _added(rows, lambda dims, x: np.concatenate([[len(x)], x.sum(0)]).astype(object))
    return {dims: (values[0], values[1:]) for dims, values in found.items()}


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: about the whole mean first, so that products stay small."""
    whole = [s // n for s in sums]
    rest = np.array([s - w * n for s, w in zip(sums, whole)], np.int64)
    z = x - np.array(whole, np.int64)
    if z.size and (int(np.abs(z).max()) + 1) * n >= 1 << 62:
        raise ArithmeticError("centred entries are too large for 64 bits")
    return n * z - rest


def polarised(rows: DataFrame, size: dict[int, tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, float]]:
    """The covariance of x and its trace for each length, from squares of single entries and of sums of two."""
    places = {dims: np.triu_indices(dims, 1) for dims in size}

    def sums(dims: int, x: np.ndarray) -> np.ndarray:
        y = centred(x, *size[dims])
        first, second = places[dims]
        return np.concatenate([_exact(*squares(y, 0)), _exact(*squares(y[:, first] + y[:, second], 0))])

    out = {}
    for dims, values in _added(rows, sums).items():
        n = size[dims][0]
        alone, pairs = values[:dims], values[dims:]
        v = np.zeros((dims, dims))
        for i in range(dims):
            v[i, i] = alone[i] / n**3  # divisions of integers: rounded once
        for i, j, square in zip(*(p.tolist() for p in places[dims]), pairs):
            v[i, j] = v[j, i] = (square - alone[i] - alone[j]) / (2 * n**3)
        out[dims] = v, sum(alone) / n**3
    return out


class Whitening:
    """Unit eigenvectors by falling eigenvalue and what their scores are divided by; NaN where there is no variance."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, trace: float, components: int):
        values, vectors = np.linalg.eigh(covariance)
        by = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums = n, sums
        self.vectors = vectors[:, by]
        none = values[by] <= max(trace, 0) * len(values) * np.finfo(float).eps
        self.scale = np.where(none, np.nan, np.sqrt(np.where(none, 1.0, values[by])))
        self.explained = np.where(none, 0.0, values[by] / trace if trace > 0 else 0.0)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centred(x, self.n, self.sums)
        return y, (y / self.n) @ self.vectors / self.scale


def identity_errors(rows: DataFrame, models: dict[int, Whitening]) -> dict[int, float | None]:
    """The largest distance of an entry of the whitened vectors' covariance from the identity, measured over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dims, some in by_length(batch):
                _, w = models[dims].apply(integers(some.column(0), dims))
                first, second = moments.get(dims, (0.0, 0.0))
                moments[dims] = first + w.sum(0), second + w.T @ w
        for dims, (first, second) in moments.items():
            values = np.concatenate([first, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), dims, np.int32)), pa.array(np.arange(len(values))), pa.array(values)], ["dims", "slot", "value"])

    found: dict[int, list[float]] = {}
    for row in rows.select("v").mapInArrow(run, "dims int, slot long, value double").groupBy("dims", "slot").agg(F.sum("value").alias("value")).orderBy("dims", "slot").collect():
        found.setdefault(row.dims, []).append(row.value)
    errors = {}
    for dims, values in found.items():
        n, k = models[dims].n, len(models[dims].scale)
        mean, second = np.array(values[:k]) / n, np.array(values[k:]).reshape(k, k) / n
        off = np.abs(second - np.outer(mean, mean) - np.eye(k))
        errors[dims] = None if np.isnan(off).all() else float(np.nanmax(off))
    return errors


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, dims, deviation_wide."""
    rows = usable(vectors)
    size = totals(rows)
    models = {dims: Whitening(*size[dims], *found, components) for dims, found in polarised(rows, size).items()}
    errors = identity_errors(rows, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, some in by_length(batch):
                model = models[dims]
                k = len(model.scale)
                for at in range(0, some.num_rows, 1024):
                    part = some.slice(at, 1024)
                    y, w = model.apply(integers(part.column(1), dims))
                    m = part.num_rows
                    ids = part.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                    limbs = [pa.array(np.repeat(limb, k)) for limb in squares(y, 1)]
                    flat = w.ravel()
                    fixed = [np.full(m * k, model.n), np.full(m * k, dims, np.int32), np.tile(model.explained, m)]
                    error = pa.array([errors[dims]], pa.float64()).take(pa.array(np.zeros(m * k, np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), *limbs, pa.array(flat, mask=np.isnan(flat)), *map(pa.array, fixed), error],
                        ["vec_id", "component", "high", "middle", "low", "whitened", "n", "dims", "explained", "identity_error"],
                    )

    found = rows.select("vec_id", "v").mapInArrow(
        run, "vec_id long, component int, high long, middle long, low long, whitened double, n long, dims int, explained double, identity_error double")
    wide = [F.col(c).cast("decimal(20,0)") * F.lit(str(1 << shift)).cast("decimal(17,0)") for c, shift in (("high", 2 * LIMB), ("middle", LIMB + 1), ("low", 0))]
    exact = (wide[0] + wide[1] + wide[2]).cast("decimal(38,0)")
    return found.withColumn("deviation_wide", exact).select(
        "vec_id", "component", "n", F.expr("try_cast(deviation_wide AS bigint)").alias("deviation"), "whitened", "explained", "identity_error", "dims", "deviation_wide")
