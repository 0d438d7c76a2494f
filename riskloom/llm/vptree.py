"""Nearest neighbours by inner product with a vantage-point tree for each shard.

Vectors are lifted by one coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that the largest inner
product is the least Euclidean distance, where the triangle inequality holds. A node keeps a vantage point and
the median distance to it; a query at distance d skips the half that starts further than ``factor`` times its current
radius from d. Factor one is exact search; below it, search is approximate and faster.

Shards have a bounded number of rows and are built once. Queries go in blocks; each block meets each shard. Equal
vectors of a shard are one point with the smallest ids that can be asked for, so that copies cost nothing.

Defined results: vectors null, empty, zero or with null or non-finite components take no part; vectors of
different length are never compared; repeated ids are rows of their own; ties go to the smaller id; other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import staged

LEAF = 128
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4096
FACTOR = 1.0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in pairs, columns added in their order: the same numbers for equal vectors in any shard and any batch."""
    out = np.zeros(len(a))
    for column in range(b.shape[1]):
        out += a[:, column] * b[:, column]
    return out


class Tree:
    """Points in leaf order, and nodes in order of their building; children < 0 are leaves. ``least`` has the smallest id of each point."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, ranges: np.ndarray, least: np.ndarray | None = None):
        self.points, self.order, self.nodes, self.ranges = points, order, nodes, ranges
        self.least = np.arange(len(points)) if least is None else least

    @staticmethod
    def build(lifted: np.ndarray) -> "Tree":
        order = np.arange(len(lifted))
        nodes: list[list[float]] = []  # vantage point, median, inner child, outer child
        ranges: list[tuple[int, int]] = []

        def split(low: int, high: int) -> int:
            if high - low <= LEAF:
                ranges.append((low, high))
                return -len(ranges)
            at = len(nodes)
            part = order[low:high]
            # The point furthest from the middle sees the others at the most varied distances.
            middle = lifted[part].mean(0)
            vantage = part[((lifted[part] - middle) ** 2).sum(1).argmax()]
            distance = np.sqrt(((lifted[part] - lifted[vantage]) ** 2).sum(1))
            half = (high - low) // 2
            by = np.argpartition(distance, half)
            order[low:high] = part[by]
            nodes.append([float(vantage), float(distance[by[half]]), 0.0, 0.0])
            nodes[at][2] = split(low, low + half)
            nodes[at][3] = split(low + half, high)
            return at

        root = split(0, len(lifted)) if len(lifted) else 0
        table = np.array(nodes, np.float64).reshape(-1, 4)
        assert root == 0 or len(table) == 0
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        if len(table):
            table[:, 0] = place[table[:, 0].astype(np.int64)]
        return Tree(lifted[order], order, table, np.array(ranges, np.int64).reshape(-1, 2))

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` points (in leaf order) nearest to each lifted query that the walk meets, -1 where there are fewer.

        Of points at one distance those with the smaller ids stay, so the walk goes on where a distance may equal the last one kept.
        """
        n = len(queries)
        best = np.full((n, k), np.inf)  # half the squared distance, less what is the same for all points
        found = np.full((n, k), -1, np.int64)
        home = np.full(n, -1, np.int64)
        squares = (queries**2).sum(1)
        # Lifted points have the same length but for rounding, and then the inner product alone is the order: ties stay ties.
        own = (self.points**2).sum(1)
        bound = float(own.max()) if len(own) else 0.0
        shorter = (own - bound) / 2
        shorter[np.abs(shorter) <= 1e-9 * bound] = 0.0

        # Distances that are equal but for rounding: of a difference near zero, the root is what counts.
        slack = 1e-6 * math.sqrt(bound + float(squares.max())) if n else 0.0

        def radius(some: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(squares[some] + bound + 2 * best[some].max(1), 0))

        def leaf(number: int, some: np.ndarray) -> None:
            low, high = self.ranges[number]
            # A matrix product rounds differently from place to place. So it only finds the pairs near the cut; those are computed anew.
            rough = shorter[low:high] - queries[some] @ self.points[low:high].T
            every = np.concatenate([best[some], rough], 1)
            cut = np.partition(every, k - 1, 1)[:, k - 1] + 1e-9 * (squares[some] + bound)
            row, column = np.nonzero(every <= cut[:, None])
            value, place = every[row, column], np.full(len(row), -1, np.int64)
            old, new = column < k, column >= k
            place[old] = found[some[row[old]], column[old]]
            place[new] = low + column[new] - k
            value[new] = shorter[place[new]] - products(queries[some[row[new]]], self.points[place[new]])
            by = np.lexsort((np.where(place < 0, np.iinfo(np.int64).max, self.least[place]), value, row))
            row, value, place = row[by], value[by], place[by]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            row, value, place, nth = row[nth < k], value[nth < k], place[nth < k], nth[nth < k]
            new_best, new_found = np.full((len(some), k), np.inf), np.full((len(some), k), -1, np.int64)
            new_best[row, nth], new_found[row, nth] = value, place
            best[some], found[some] = new_best, new_found

        def distances(node: int, some: np.ndarray) -> np.ndarray:
            vantage = self.points[int(self.nodes[node, 0])]
            return np.sqrt(np.maximum(((queries[some] - vantage) ** 2).sum(1), 0))

        def descend(node: int, some: np.ndarray) -> None:
            """First the leaf that each query falls into: a radius to prune with."""
            if not len(some):
                return
            if node < 0:
                home[some] = -node - 1
                leaf(-node - 1, some)
                return
            inner = distances(node, some) < self.nodes[node, 1]
            descend(int(self.nodes[node, 2]), some[inner])
            descend(int(self.nodes[node, 3]), some[~inner])

        def walk(node: int, some: np.ndarray) -> None:
            if not len(some):
                return
            if node < 0:
                some = some[home[some] != -node - 1]
                if len(some):
                    leaf(-node - 1, some)
                return
            d, median = distances(node, some), self.nodes[node, 1]
            reach = factor * radius(some) + slack
            walk(int(self.nodes[node, 2]), some[d - median <= reach])
            reach = factor * radius(some) + slack
            walk(int(self.nodes[node, 3]), some[median - d <= reach])

        if len(self.points):
            root = 0 if len(self.nodes) else -1
            descend(root, np.arange(n))
            walk(root, np.arange(n))
        return found, np.maximum(squares[:, None] + bound + 2 * best, 0)


def usable(vectors: DataFrame) -> DataFrame:
    """id and v (array<double>) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    return rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A written table of trees: for each shard its points in leaf order with their ids, and the nodes in the first row."""
    rows = vectors.withColumn("dims", F.size("v"))
    stats = {r.dims: r for r in rows.groupBy("dims").agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm")
    ).collect()}  # a row for each length of vectors
    shards = F.lit(1)
    for dims, r in stats.items():
        shards = F.when(F.col("dims") == dims, math.ceil(r.n / shard_rows)).otherwise(shards)
    norms = {dims: r.norm for dims, r in stats.items()}

    def build(key: tuple, table: pa.Table) -> pa.Table:
        dims = key[0].as_py()
        values = _matrix(table.column("v"), dims)
        ids = table.column("id").to_numpy()
        by = np.argsort(ids, kind="stable")
        values, ids = values[by] + 0.0, ids[by]
        points, group = np.unique(values, axis=0, return_inverse=True)
        lift = np.sqrt(np.maximum(norms[dims] - (points**2).sum(1), 0))
        tree = Tree.build(np.column_stack([points, lift]))
        place = np.empty(len(points), np.int64)
        place[tree.order] = np.arange(len(points))
        group = place[group.reshape(-1)]
        by = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[by], np.arange(len(points) + 1))
        first = [ids[by[a : min(b, a + k + 1)]] for a, b in zip(bounds[:-1], bounds[1:])]  # no more are ever among k others
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(i) for i in first])]).astype(np.int32)), pa.array(np.concatenate(first)))
        head = [tree.nodes.tobytes()] + [None] * (len(points) - 1)
        ends = [tree.ranges.tobytes()] + [None] * (len(points) - 1)
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, tree.points.size + 1, dims + 1, dtype=np.int32)), pa.array(tree.points.ravel()))
        n = len(points)
        return pa.table({
            "dims": pa.array(np.full(n, dims, np.int32)), "shard": pa.array(np.full(n, key[1].as_py(), np.int64)), "place": pa.array(np.arange(n, dtype=np.int32)),
            "ids": lists, "point": vectors, "nodes": pa.array(head, pa.binary()), "ranges": pa.array(ends, pa.binary()),
        })

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards.cast("long")))
    return staged(sharded.groupBy("dims", "shard").applyInArrow(
        build, "dims int, shard long, place int, ids array<long>, point array<double>, nodes binary, ranges binary"), "vptree")


def nearest(queries: DataFrame, index: DataFrame, k: int = 20, factor: float = FACTOR, block: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for each query (id, v), without the query's own id."""
    rows = queries.withColumn("dims", F.size("v"))
    blocks = max(1, math.ceil(rows.count() / block))
    parts = index.select(F.col("dims").alias("_dims"), F.col("shard").alias("_shard")).distinct()
    asked = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).join(parts, F.col("dims") == F.col("_dims")).select("id", "v", "dims", "block", F.col("_shard").alias("shard"))
    points = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(key: tuple, some: pa.Table, shard: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not some.num_rows or not shard.num_rows:
            return empty
        dims = key[0].as_py()
        shard = shard.sort_by("place")
        nodes = np.frombuffer(shard.column("nodes")[0].as_py(), np.float64).reshape(-1, 4)
        ranges = np.frombuffer(shard.column("ranges")[0].as_py(), np.int64).reshape(-1, 2)
        ids = shard.column("ids").combine_chunks()
        bounds, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        tree = Tree(_matrix(shard.column("point"), dims + 1), np.zeros(0), nodes, ranges, flat[bounds[:-1]])
        asked_ids = some.column("id").to_numpy()
        values = _matrix(some.column("v"), dims)
        found, _ = tree.search(np.column_stack([values, np.zeros(len(values))]), k + 1, factor)
        query, column = np.nonzero(found >= 0)
        point = found[query, column]
        score = products(values[query], tree.points[point, :dims])
        size = bounds[point + 1] - bounds[point]
        query, score, base = np.repeat(query, size), np.repeat(score, size), np.repeat(bounds[point], size)
        vec = flat[base + np.arange(len(base)) - np.repeat(np.cumsum(size) - size, size)]
        other = vec != asked_ids[query]
        query, score, vec = query[other], score[other], vec[other]
        by = np.lexsort((vec, -score, query))
        query, score, vec = query[by], score[by], vec[by]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        keep = nth < k
        return pa.table({"query_id": asked_ids[query[keep]], "vec_id": vec[keep], "score": score[keep]})

    met = asked.groupBy("dims", "shard", "block").cogroup(points.groupBy("dims", "shard", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_all(vectors: DataFrame, every: int = 20, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """Every row whose id is divisible by ``every`` against all rows."""
    rows = usable(vectors)
    return nearest(rows.filter(F.col("id") % every == 0), build_index(rows, k), k, factor)
