"""Hard negatives by inner product with cover trees over norm-augmented candidates.

Integer vectors x get one more coordinate, sqrt(M - |x|^2) with M the largest squared norm, and queries a zero. Then
the squared distance is |q|^2 + M - 2 q.x, so a ball of radius r around a centre at distance d bounds the inner products of its
points between (|q|^2 + M - (d + r)^2) / 2 and (|q|^2 + M - (d - r)^2) / 2. A cover tree keeps such balls level by level:
the centres of a node's children are a net of the node's points, each further than radius / BASE from the others, and each child
keeps the true radius of what it covers. A search skips nodes whose bounds lie outside a query's window of scores or below
what it has found, opens leaves in order of their upper bounds, and computes the scores of a leaf's points exactly.

The top of the tree is a set of pivots, at most MAX_PIVOTS sampled points: each row goes to the cell of its nearest
pivot, cells are cut into shards of bounded size, and each shard is a tree. A search goes in two rounds. Each query first meets
its own shard, which gives it a score to beat; then only the shards of those cells whose ball can hold something as good. Points of
the index and queries go to a shard by one shuffle and stream through its task: a tree and one batch of queries at a time.

Defined results: rows with a null id, label, vector or component, an empty vector, or a component that is not finite, take no part; vectors of
different lengths never meet; rows are told apart by their place, so repeated ids are rows of their own and each anchor row has
its own result; ties go to the smaller id; an anchor without positives, or a positive without negatives, gives no row. Vectors
whose inner products could reach 2**55 raise an error. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import staged

SCALE = 256
BASE = 1.3
LEAF = 64
SHARD_CELLS = 1 << 18  # numbers in a shard's vectors: 4,096 rows of 64
MAX_PIVOTS = 4096
BATCH_QUERIES = 512
QUERIES_PER_TASK = 200_000
FIELDS = "shard long, kind int, place long, qid long, id long, label long, v array<long>, low long, high long, best long, nodes binary"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


class CoverTree:
    """Points in leaf order. Nodes in order of levels: centre, radius, first and last point, parent, and whether it is a leaf."""

    def __init__(self, order: np.ndarray, nodes: np.ndarray):
        self.order, self.nodes = order, nodes

    @staticmethod
    def build(lifted: np.ndarray) -> "CoverTree":
        order = np.arange(len(lifted))
        middle = int(((lifted - lifted.mean(0)) ** 2).sum(1).argmin())
        level = [(middle, 0, len(lifted), -1)]
        nodes: list[list[float]] = []
        while level:
            below = []
            for centre, low, high, parent in level:
                part = order[low:high].copy()
                distance = _distances(lifted[part], lifted[centre])
                radius = float(distance.max())
                at = len(nodes)
                nodes.append([centre, radius, low, high, parent, 1.0])
                if high - low <= LEAF or radius == 0:
                    continue
                centres, owner = _net(lifted[part], int(np.flatnonzero(part == centre)[0]), distance, radius / BASE)
                if 4 * len(centres) > high - low:  # no structure at this scale: the points are as good as their balls
                    continue
                nodes[at][5] = 0.0
                by = np.argsort(owner, kind="stable")
                order[low:high] = part[by]
                bounds = low + np.searchsorted(owner[by], np.arange(len(centres) + 1))
                below += [(int(part[c]), int(a), int(b), at) for c, a, b in zip(centres, bounds[:-1], bounds[1:])]
            level = below
        table = np.array(nodes, np.float64).reshape(-1, 6)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table[:, 0] = place[table[:, 0].astype(np.int64)]
        return CoverTree(order, table)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


def _net(points: np.ndarray, first: int, distance: np.ndarray, reach: float) -> tuple[list[int], np.ndarray]:
    """Centres further than ``reach`` apart that cover all points within it, by furthest-first steps, and each point's centre."""
    centres, owner, near = [first], np.zeros(len(points), np.int64), distance.copy()
    while near.max() > reach and 4 * len(centres) <= len(points):
        centres.append(int(near.argmax()))
        other = _distances(points, points[centres[-1]])
        closer = other < near
        owner[closer] = len(centres) - 1
        near[closer] = other[closer]
    return centres, owner


def _lift(values: np.ndarray, largest: int) -> np.ndarray:
    values = values.astype(np.float64)
    return np.column_stack([values, np.sqrt(np.maximum(largest - (values**2).sum(1), 0))])


def _bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest inner products that points within the radii of lifted centres can have; a little wide, for rounding."""
    squares = (queries**2).sum(1)[:, None] + float(largest)
    d = np.sqrt(np.maximum(squares - 2 * queries @ centres[:, :-1].T, 0))
    slack = 1e-9 * squares + 1e-3
    return (squares - (d + radii) ** 2) / 2 - slack, (squares - np.maximum(d - radii, 0) ** 2) / 2 + slack


class Shard:
    """One tree with its points, ready to be asked."""

    def __init__(self, ids, rows, labels, values, nodes, largest: int):
        self.ids, self.rows, self.labels, self.largest = ids, rows, labels, largest
        self.values = values.astype(np.float64) if largest < 1 << 52 else values  # sums of products below 2**53 are exact in doubles
        self.centre, self.radius, low, high, self.parent, leaf = nodes.T
        self.low, self.high, self.parent, self.leaf = low.astype(np.int64), high.astype(np.int64), self.parent.astype(np.int64), leaf > 0
        self.centres = _lift(values[self.centre.astype(np.int64)], largest)
        self.least = np.array([labels[a:b].min() for a, b in zip(self.low, self.high)])
        self.most = np.array([labels[a:b].max() for a, b in zip(self.low, self.high)])

    def search(self, rows, labels, values, low, high, best, k: int, same: bool):
        """(query, id, score, row) of up to ``k`` points of each query: of its label (not its own row) or of others, inside its window."""
        asked = values.astype(self.values.dtype)
        below, above = _bounds(asked.astype(np.float64), self.centres, self.radius, self.largest)
        floor = np.maximum(low, best)
        open_ = (above >= floor[:, None]) & (below <= high[:, None])
        mine = labels[:, None]
        open_ &= (self.least <= mine) & (mine <= self.most) if same else (self.least != mine) | (self.most != mine)
        for node in range(1, len(self.parent)):  # parents come first
            open_[:, node] &= open_[:, self.parent[node]]
        leaves = np.flatnonzero(self.leaf)
        top = np.where(open_[:, leaves], above[:, leaves], -np.inf)
        first = np.argsort(-np.minimum(top, high[:, None]), 1, kind="stable")
        n = len(asked)
        found = [np.zeros(0, np.int64)] * 4  # query, id, score, row
        for step in range(len(leaves)):
            chosen = first[:, step]
            going = np.flatnonzero(top[np.arange(n), chosen] >= floor)
            if not len(going):
                break
            new = [found]
            for leaf in np.unique(chosen[going]):
                some = going[chosen[going] == leaf]
                a, b = self.low[leaves[leaf]], self.high[leaves[leaf]]
                scores = (asked[some] @ self.values[a:b].T).astype(np.int64)
                fits = (self.labels[a:b] == labels[some, None]) == same
                fits &= (scores >= floor[some, None]) & (scores <= high[some, None])
                if same:
                    fits &= self.rows[a:b] != rows[some, None]
                if b - a > k:  # what is below the k-th of the leaf itself cannot count; equals stay
                    cut = np.partition(np.where(fits, scores, np.iinfo(np.int64).min), b - a - k, 1)[:, b - a - k]
                    fits &= scores >= cut[:, None]
                q, c = np.nonzero(fits)
                new.append([some[q], self.ids[a:b][c], scores[q, c], self.rows[a:b][c]])
            found = [np.concatenate(c) for c in zip(*new)]
            by = np.lexsort((found[3], found[1], -found[2], found[0]))
            nth = np.arange(len(by)) - np.searchsorted(found[0][by], found[0][by])
            by, nth = by[nth < k], nth[nth < k]
            found = [c[by] for c in found]
            full = nth == k - 1
            floor = floor.copy()
            floor[found[0][full]] = np.maximum(floor[found[0][full]], found[2][full])
        return found


def _floor_div(a: Column, b: int) -> Column:
    """The whole part towards minus infinity, without leaving longs."""
    b = F.lit(b).cast("long")
    return F.call_function("div", a - F.pmod(a, b), b)


def usable(vectors: DataFrame, relabel_every: int = 7, classes: int = 10) -> DataFrame:
    """id, label and v (array<long>) of the rows that take part; every ``relabel_every``-th id has the next label."""
    doubles = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), doubles.alias("d"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("d") > 0) & F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label = F.when(F.col("id") % relabel_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return rows.select("id", label.alias("label"), F.transform("d", lambda x: F.floor(x * float(SCALE))).alias("v"))


class Index:
    """A written table of rows in shards, with what the driver knows: for each length of vectors its pivots, radii and cuts."""

    def __init__(self, spark, table: DataFrame, rows: DataFrame, tops: dict[int, dict]):
        self.spark, self.table, self.rows, self.tops = spark, table, rows, tops


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.diff(batch.column(batch.schema.get_field_index("v")).offsets.to_numpy())
    for dims in np.unique(lengths):
        yield int(dims), batch if (lengths == dims).all() else batch.take(pa.array(np.flatnonzero(lengths == dims)))


def build_index(vectors: DataFrame, shard_cells: int = SHARD_CELLS) -> Index:
    """Cells of sampled pivots, cut into shards, with a cover tree for each. Every row is indexed."""
    spark = vectors.sparkSession
    rows = staged(vectors.withColumn("row", F.monotonically_increasing_id()), "hardneg-rows")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    tops: dict[int, dict] = {}
    for r in rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.max(square).alias("largest")).orderBy("dims").collect():  # a row for each length
        if r.largest >= 2.0**55:
            raise ArithmeticError("inner products of 2**55 and more are not exact here")
        tops[r.dims] = {"n": r.n, "largest": math.ceil(r.largest), "rows": max(LEAF, shard_cells // max(r.dims, 1))}
    shard_base = 0
    for dims, top in tops.items():
        wanted = min(MAX_PIVOTS, math.ceil(top["n"] / top["rows"]))
        sample = rows.filter(F.size("v") == dims).select("v", F.xxhash64("row", F.lit(11)).alias("by")).orderBy("by").limit(wanted).collect()  # MAX_PIVOTS rows at most
        pivots = np.unique(np.array([r.v for r in sample], np.int64).reshape(-1, dims), axis=0)
        top["pivots"] = _lift(pivots, top["largest"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, some in _by_length(batch):
                pivots, largest = tops[dims]["pivots"], tops[dims]["largest"]
                for at in range(0, some.num_rows, 1024):
                    part = some.slice(at, 1024)
                    lifted = _lift(_matrix(part.column(2), dims), largest)
                    squares = (lifted**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * lifted @ pivots.T
                    cell = squares.argmin(1)
                    away = _distances(lifted, pivots[cell])
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(cell), dims, np.int32)), pa.array(cell), pa.array(away)], [*part.schema.names, "dims", "cell", "away"])

    kinds = "id long, label long, v array<long>, row long, dims int, cell long, away double"
    celled = staged(rows.select("id", "label", "v", "row").mapInArrow(assign, kinds), "hardneg-cells")
    for top in tops.values():
        top["radius"], top["cuts"] = np.zeros(len(top["pivots"])), np.zeros(len(top["pivots"]), np.int64)
    for r in celled.groupBy("dims", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():  # MAX_PIVOTS rows at most for a length
        top = tops[r.dims]
        top["radius"][r.cell], top["cuts"][r.cell] = r.radius, math.ceil(r.n / top["rows"])
    for top in tops.values():  # shards are numbered through: those of a cell follow each other
        top["first"] = shard_base + np.concatenate([[0], np.cumsum(top["cuts"])[:-1]]).astype(np.int64)
        shard_base += int(top["cuts"].sum())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, dims, row = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "dims", "row"))
            shard = np.empty(len(cell), np.int64)
            for d in np.unique(dims):
                of = dims == d
                shard[of] = tops[d]["first"][cell[of]] + _scatter(row[of]) % np.maximum(tops[d]["cuts"][cell[of]], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shard)], ["id", "label", "v", "row", "shard"])

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("row", "ascending")]).combine_chunks()
        dims = len(table.column("v")[0])
        values = _matrix(table.column("v").combine_chunks(), dims)
        tree = CoverTree.build(_lift(values, tops[dims]["largest"]))
        out = table.take(pa.array(tree.order))
        n = out.num_rows
        nodes = pa.array([tree.nodes.tobytes()] + [None] * (n - 1), pa.binary())
        return out.select(["id", "label", "v", "row", "shard"]).append_column("place", pa.array(np.arange(n))).append_column("nodes", nodes)

    placed = staged(celled.select("id", "label", "v", "row", "cell", "dims").mapInArrow(place, "id long, label long, v array<long>, row long, shard long"), "hardneg-placed")
    table = staged(placed.groupBy("shard").applyInArrow(build, "id long, label long, v array<long>, row long, shard long, place long, nodes binary"), "hardneg-index")
    return Index(spark, table, placed, tops)


def _scatter(row: np.ndarray) -> np.ndarray:
    """Spread row numbers, which count on within a partition, evenly over a cell's shards."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(0x7FFFFFFF)).astype(np.int64)


def _route(queries: DataFrame, index: Index) -> DataFrame:
    """Each query once for each shard whose cell's ball can hold a point inside its window and no worse than its ``best``."""
    tops = index.tops

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, some in _by_length(batch):
                top = tops[dims]
                for at in range(0, some.num_rows, 256):
                    part = some.slice(at, 256)
                    low, high, best = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("low", "high", "best"))
                    values = _matrix(part.column(part.schema.get_field_index("v")), dims).astype(np.float64)
                    below, above = _bounds(values, top["pivots"], top["radius"], top["largest"])
                    query, cell = np.nonzero((above >= np.maximum(low, best)[:, None]) & (below <= high[:, None]))
                    cuts = top["cuts"][cell]
                    shard = np.repeat(top["first"][cell], cuts) + np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                    query = np.repeat(query, cuts)
                    for a in range(0, len(query), 8192):
                        yield pa.RecordBatch.from_arrays([pa.array(shard[a : a + 8192]), *part.take(pa.array(query[a : a + 8192])).columns], ["shard", *part.schema.names])

    fields = "qid long, row long, label long, v array<long>, low long, high long, best long"
    return queries.select(*[f.split()[0] for f in fields.split(", ")]).mapInArrow(run, "shard long, " + fields)


def _ask(asked: DataFrame, index: Index, k: int, same: bool) -> DataFrame:
    """The ``k`` best points of each query over the shards it was sent to: qid, id, score."""
    tops = index.tops
    parts = max(1, int(index.spark.conf.get("spark.sql.shuffle.partitions")))
    # Shards met by very many queries are copied, so that no task has more than QUERIES_PER_TASK of them; few ever are.
    busy = {r.shard: math.ceil(r.n / QUERIES_PER_TASK) for r in asked.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > QUERIES_PER_TASK).collect()}
    copies = F.lit(1)
    if busy:
        copies = F.coalesce(F.create_map(*[F.lit(x).cast("long") for pair in busy.items() for x in pair])[F.col("shard")], F.lit(1))
    none = {"long": F.lit(None).cast("long"), "binary": F.lit(None).cast("binary")}
    points = index.table.select(
        "shard", F.lit(0).alias("kind"), "place", F.col("row").alias("qid"), "id", "label", "v", none["long"].alias("low"), none["long"].alias("high"), none["long"].alias("best"), "nodes",
        F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)).alias("copy"))
    rows = asked.select(
        "shard", F.lit(1).alias("kind"), F.col("row").alias("place"), "qid", none["long"].alias("id"), "label", "v", "low", "high", "best", none["binary"].alias("nodes"),
        F.pmod(F.xxhash64("qid"), copies.cast("long")).alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, number = None, [], None
        for batch in batches:
            edges = np.concatenate([batch.column(0).to_numpy(), [-1]])
            kinds = np.concatenate([batch.column(1).to_numpy(), [-1]])
            copy = np.concatenate([batch.column(len(NAMES)).to_numpy(), [-1]])
            cuts = np.flatnonzero((np.diff(edges) != 0) | (np.diff(kinds) != 0) | (np.diff(copy) != 0)) + 1
            at = 0
            for end in cuts.tolist():
                key = (edges[at], copy[at])
                part = batch.slice(at, end - at)
                at = end
                if kinds[end - 1] == 0:
                    held, shard = (held if key == number else []) + [part], None
                    number = key
                    continue
                if key != number:
                    continue
                if shard is None:
                    points = pa.Table.from_batches(held).combine_chunks()
                    dims = len(points.column("v")[0])
                    nodes = np.frombuffer(points.column("nodes")[0].as_py(), np.float64).reshape(-1, 6)
                    values = _matrix(points.column("v").combine_chunks(), dims)
                    shard = Shard(*(points.column(c).to_numpy() for c in ("id", "qid", "label")), values, nodes, tops[dims]["largest"])
                    held = []
                for a in range(0, part.num_rows, BATCH_QUERIES):
                    some = part.slice(a, BATCH_QUERIES)
                    get = {c: some.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(NAMES) if c in ("place", "qid", "label", "low", "high", "best")}
                    query, ids, scores, _ = shard.search(get["place"], get["label"], _matrix(some.column(NAMES.index("v")), shard.values.shape[1]), get["low"], get["high"], get["best"], k, same)
                    yield pa.RecordBatch.from_arrays([pa.array(get["qid"][query]), pa.array(ids), pa.array(scores)], ["qid", "id", "score"])

    both = points.unionByName(rows).select(*NAMES, "copy")
    streamed = both.repartition(parts, "shard", "copy").sortWithinPartitions("shard", "copy", "kind", "place")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    met = streamed.mapInArrow(run, "qid long, id long, score long")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best_of(queries: DataFrame, index: Index, k: int, same: bool) -> DataFrame:
    """The ``k`` best rows of each query (qid, row, shard, label, v, low, high): first its own shard, then those that can hold better."""
    least = -(1 << 62)
    home = _ask(queries.withColumn("best", F.lit(least).cast("long")), index, k, same)
    beaten = home.groupBy("qid").agg(F.when(F.count("*") >= k, F.min("score")).alias("best"))
    again = queries.join(beaten, "qid", "left").withColumn("best", F.coalesce("best", F.lit(least).cast("long")))
    return _ask(_route(staged(again, "hardneg-asked"), index), index, k, same)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """Hard negatives of each anchor (ids divisible by ``every``) for each of its best rows of the same label.

    ``rows`` has id, label and v (array<long>). A negative's score lies between ``low`` and ``high`` percent of the positive's.
    """
    index = build_index(rows, shard_cells)
    limit = F.lit(1 << 61).cast("long")
    anchors = index.rows.filter(F.col("id") % every == 0).select(
        F.col("row").alias("qid"), "row", "shard", "label", "v", (-limit).alias("low"), limit.alias("high"), F.col("id").alias("anchor_id"))
    anchors = staged(anchors, "hardneg-anchors")
    good = staged(best_of(anchors.drop("anchor_id"), index, positives, True), "hardneg-positives")
    pairs = anchors.drop("low", "high").join(good.select("qid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("nth")), "qid")
    floor = -_floor_div(-F.col("positive_score") * low, 100)
    pairs = pairs.withColumns({"low": floor, "high": _floor_div(F.col("positive_score") * high, 100), "qid": F.monotonically_increasing_id()}).filter(F.col("low") <= F.col("high"))
    pairs = staged(pairs, "hardneg-pairs")
    found = best_of(pairs.select("qid", "row", "shard", "label", "v", "low", "high"), index, negatives, False)
    return found.join(pairs.select("qid", "anchor_id", "positive_id", "positive_score"), "qid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
