"""Near-duplicate join on word shingles: T-occurrence search with DivideSkip, spread over the cluster.

A document's set has n shingles, each with an inverted list of documents. A partner of Jaccard similarity s
shares T >= ceil(s * n) of them, so at most T - 1 lists may be left out: DivideSkip leaves out the longest, merges the
n - T + 1 shortest, and looks into the long ones by binary search only for documents that the merge has met.

1. List lengths: the documents of each shingle are counted, over all documents. A table of fixed size has, for each place of the
   hash, the length of its longest list. It only orders the lists (long ones last, then by hash), alike for all documents.
2. The short lists are merged by a shuffle on their shingles. Lists of one set end here, and lists of the same sets become one.
   The merge is that shuffle and its sort, not a heap, and the search in long lists is the binary search of step 4.
3. Within a list, sets are compared by size and by the parities of the number of their shingles in 1024 classes; classes
   of different parity are a lower bound of the sets' difference, so no link is lost. The first set that fits becomes the
   leader of the later ones, and only pairs of leader and member go on.
4. Each member's pair with its first leader is decided: large sets have longer vectors of parities, a sharper bound;
   pairs that pass are decided exactly by binary search of all shingles of one set in the other. This gives components.
5. Then every pair of a list whose sets lie in different components, and that step 3 cannot exclude, is decided
   in the same way. Pairs within a component need no test: they cannot change the components.

Documents with equal sets are one set throughout. Each task of step 2 gives the lists of a set once, so a group of copies
sends as many rows to a list as there are tasks at most, and one is left behind the shuffle.

Defined results: null or blank texts have no shingles and are their own component; fewer words than ``WORDS`` make one
shingle; repeated rows are linked as copies; a null doc_id is a row without component; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import arrays
from riskloom.session import shared_dir, staged

WORDS = 5
PERCENT = 80
TABLE_BITS = 24
LENGTH_BITS = 22
PART_BITS = 10  # of hashes: their parts are counted one by one
HELD = 1 << 18  # shingles that a task holds back to count them together
SLICE_BITS = 20
TEXT_BYTES = 1 << 18  # of texts that a task works on at a time
SET_BYTES = 5  # of each hash, where two sets are compared
BUCKET_ROWS = 100_000  # rows of lists, of about 150 bytes each, that one task compares
PARITIES = (1024, 1 << 22)  # least and largest length of a vector of parities; lists carry the least


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, in order, and the bounds of documents among them."""
    data = arrays.LOWER[data]
    starts, ends, bounds = arrays.words(data, offsets)
    tokens = arrays.stretch_hashes(arrays.prefix_sums(data), starts, ends)
    n = np.diff(bounds)
    doc = arrays.doc_numbers(bounds)
    hashes = arrays.window_hashes(tokens, WORDS)
    inside = np.arange(len(hashes)) + WORDS <= bounds[1:][doc[: len(hashes)]]
    keys, docs = hashes[inside], doc[: len(hashes)][inside]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        few = np.array([arrays.window_hashes(tokens[bounds[d] : bounds[d + 1]], int(n[d]))[0] + np.uint64(n[d]) for d in short], np.uint64)
        keys, docs = np.concatenate([keys, arrays.mix(few)]), np.concatenate([docs, short])
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[new], docs[new]
    return keys, np.searchsorted(docs, np.arange(len(offsets)))


def required(n: np.ndarray | int) -> np.ndarray | int:
    """The overlap that any partner of a set of n shingles must reach."""
    return -(-PERCENT * n // 100)


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def bit_table(numbers: DataFrame, bits: int) -> np.ndarray:
    """Mark the numbers (column i, below 2**bits) in a table of fixed size, put together from slices."""

    def mark(key: tuple, table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << min(SLICE_BITS, bits), bool)
        marks[table.column("i").to_numpy() & (len(marks) - 1)] = True
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    size = min(SLICE_BITS, bits)
    sliced = numbers.select("i").distinct().withColumn("slice", F.shiftright("i", size).cast("long"))
    table = np.zeros(1 << bits, bool)
    for row in sliced.groupBy("slice").applyInArrow(mark, "slice long, marks binary").collect():  # of fixed size
        table[row.slice << size : (row.slice + 1) << size] = np.unpackbits(np.frombuffer(row.marks, np.uint8))
    return table


def _parts(held: list[np.ndarray]) -> pa.RecordBatch:
    """The first 32 + ``PART_BITS`` bits of the different shingles and how often each is held, a row for each part."""
    keys, counts = np.unique(np.concatenate(held) >> np.uint64(32 - PART_BITS), return_counts=True)
    part, first = np.unique(keys >> np.uint64(32), return_index=True)
    ends = pa.py_buffer((4 * np.append(first, len(keys))).astype(np.int32))
    columns = [pa.Array.from_buffers(pa.binary(), len(part), [None, ends, pa.py_buffer(x.astype("<u4"))]) for x in (keys & np.uint64(0xFFFFFFFF), counts)]
    return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), *columns], ["part", "keys", "counts"])


def _longest(key: tuple, table: pa.Table) -> pa.Table:
    """The length of the longest list at each place of a part, on a scale of eighths of its logarithm."""
    keys, counts = (np.ascontiguousarray(arrays.text_bytes(table.column(c))[0]).view("<u4") for c in ("keys", "counts"))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    length = np.add.reduceat(counts[order], first, dtype=np.int64)
    place, start = np.unique(keys[first] >> np.uint32(32 + PART_BITS - LENGTH_BITS), return_index=True)
    out = np.zeros(1 << (LENGTH_BITS - PART_BITS), np.uint8)
    out[place] = np.minimum(np.rint(8 * np.log2(np.maximum.reduceat(length, start))), 255)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "lengths": pa.array([out.tobytes()], pa.binary())})


def list_lengths(docs: DataFrame) -> np.ndarray:
    """For each place (the first ``LENGTH_BITS`` of a hash) the length of its longest list: in how many of all documents a shingle is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in arrays.slices(batches, "text", TEXT_BYTES):
            held.append(shingles(*arrays.text_bytes(batch.column(0)))[0])
            size += len(held[-1])
            if size >= HELD:
                yield _parts(held)
                held, size = [], 0
        if size:
            yield _parts(held)

    counted = _source(docs).filter("doc_id is not null").select("text").mapInArrow(run, "part long, keys binary, counts binary")
    table = np.zeros((1 << PART_BITS, 1 << (LENGTH_BITS - PART_BITS)), np.uint8)
    for row in counted.groupBy("part").applyInArrow(_longest, "part long, lengths binary").collect():  # of fixed size
        table[row.part] = np.frombuffer(row.lengths, np.uint8)
    return table.ravel()


def sketches(docs: DataFrame) -> DataFrame:
    """For each document: doc_id, n, cls (a hash of its set), vectors of parities, and the shingles whose lists are merged."""
    lengths = docs.sparkSession.sparkContext.broadcast(list_lengths(docs).tobytes())  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(lengths.value, np.uint8)
        seen: set[int] = set()  # sets whose lists this task has given; no more than it has documents
        for batch in arrays.slices(batches, "text", TEXT_BYTES):
            keys, bounds = shingles(*arrays.text_bytes(batch.column(1)))
            n = np.diff(bounds)
            cls = _class_of(keys, bounds).view(np.int64)
            first = np.zeros(len(n), bool)
            for i in np.flatnonzero((n > 0) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)):
                if (own := int(cls[i])) not in seen:
                    seen.add(own)
                    first[i] = True
            doc = arrays.doc_numbers(bounds)
            length = table[(keys >> np.uint64(64 - LENGTH_BITS)).astype(np.int64)]
            order = np.lexsort((keys, length, doc))
            nth = np.arange(len(keys)) - bounds[doc]
            kept = (nth < (n - required(n) + 1)[doc]) & first[doc]
            merged = keys[order][kept]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=len(n)))])
            parities = _parities(keys, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n), pa.array(cls),
                    pa.array([folded(p, PARITIES[0] // 8) for p in parities], pa.binary()), pa.array(parities, pa.binary()), _lists(merged.view(np.int64), ends),
                ],
                ["doc_id", "n", "cls", "short", "parities", "merged"],
            )

    return staged(_source(docs).mapInArrow(run, "doc_id long, n long, cls long, short binary, parities binary, merged array<long>"), "sketches")


def _class_of(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each document's set; equal sets have equal ones."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arrays.mix(keys + arrays.BASE))])
    return arrays.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))


def _parities(keys: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set of n, the parity of the number of its shingles in each of 2n to 4n classes (the hash's low bits)."""
    n = np.diff(bounds)
    size = np.clip(1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64), *PARITIES)
    begin = np.concatenate([[0], np.cumsum(size)])
    at = begin[:-1][arrays.doc_numbers(bounds)] + (keys & (np.repeat(size, n) - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=int(begin[-1])) & 1).astype(bool)) if len(n) else np.zeros(0, np.uint8)
    return [bits[a:b].tobytes() for a, b in zip(begin[:-1] // 8, begin[1:] // 8)]


def folded(parities: bytes, size: int) -> bytes:
    """The parities of fewer classes, ``size`` bytes of them: classes that share their low bits fall together."""
    if len(parities) <= size:
        return parities
    a = np.frombuffer(parities, np.uint8)
    while len(a) > size:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return a.tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the difference of two sets: classes of different parity."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(np.frombuffer(folded(x, size), np.uint8) ^ np.frombuffer(folded(y, size), np.uint8)).sum())


PAIR = "a long, b long"


def _met(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Rows of a bucket of lists by shingle and set: start of each row's list, set, size, parities."""
    key, cls = table.column("key").to_numpy(), table.column("cls").to_numpy()
    order = np.lexsort((cls, key))
    key, cls, n = key[order], cls[order], table.column("n").to_numpy()[order]
    flat, _ = arrays.text_bytes(table.column("short"))
    parities = np.ascontiguousarray(flat).view(np.uint64).reshape(-1, PARITIES[0] // 64)[order]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), np.arange(len(key)), 0))
    return start, cls, n, parities


def _fits(n: np.ndarray, parities: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sets i and j can be linked: their difference is no more than (n_i + n_j) * (100 - s) / (100 + s)."""
    total = n[i] + n[j]
    out = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
    some = np.flatnonzero(out)
    for low in range(0, len(some), 1 << 16):  # bounded working arrays
        part = some[low : low + (1 << 16)]
        least = np.bitwise_count(parities[i[part]] ^ parities[j[part]]).sum(1, dtype=np.int64)
        out[part] = (100 + PERCENT) * least <= (100 - PERCENT) * total[part]
    return out


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    low, high = np.minimum(a, b), np.maximum(a, b)
    if len(low):
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]) & (low != high)
        low, high = low[new], high[new]
    return pa.table({"a": pa.array(low, pa.int64()), "b": pa.array(high, pa.int64())})


def _leaders(key: tuple, table: pa.Table) -> pa.Table:
    """Pairs of leader and member in each list, all lists at once: the first set left leads, those that fit leave, and so on."""
    start, cls, n, parities = _met(table)
    left = np.arange(len(cls))
    found_a, found_b = [], []
    while len(left):
        first = np.concatenate([[True], start[left][1:] != start[left][:-1]])
        leader = left[np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))]
        fits = _fits(n, parities, leader, left) & ~first
        found_a.append(cls[leader[fits]])
        found_b.append(cls[left[fits]])
        left = left[~first & ~fits]
    return _pairs(np.concatenate(found_a), np.concatenate(found_b)) if found_a else _pairs(cls, cls)


def _across(key: tuple, table: pa.Table, placed: pa.Table) -> pa.Table:
    """All pairs of a list in different components that fit. Sets without a component are alone.

    Each set is compared with those of the components after its own, so pairs within a component take no step.
    """
    if not table.num_rows:
        return _pairs(np.zeros(0, np.int64), np.zeros(0, np.int64))
    start, cls, n, parities = _met(table)
    component = cls.copy()
    if placed.num_rows:
        nodes, found = placed.column("node").to_numpy(), placed.column("component").to_numpy()
        order = np.argsort(nodes)
        at = np.minimum(np.searchsorted(nodes[order], cls), len(nodes) - 1)
        known = nodes[order][at] == cls
        component[known] = found[order][at][known]
    order = np.lexsort((component, start))
    lists, runs = start[order], component[order]
    list_edge = np.concatenate([[True], lists[1:] != lists[:-1], [True]])
    run_edge = list_edge.copy()
    run_edge[1:-1] |= runs[1:] != runs[:-1]
    index = np.arange(len(cls))
    list_ends, run_ends = (np.flatnonzero(edge) for edge in (list_edge, run_edge))
    after = run_ends[np.searchsorted(run_ends, index, "right")]
    others = list_ends[np.searchsorted(list_ends, index, "right")] - after
    rows = np.flatnonzero(others)
    begin = np.concatenate([[0], np.cumsum(others[rows])])
    found_a, found_b = [], []
    at = 0
    while at < len(rows):  # bounded working arrays, but one set with all of its list at least
        upto = max(at + 1, int(np.searchsorted(begin, begin[at] + (1 << SLICE_BITS), "right")) - 1)
        some, times = rows[at:upto], others[rows[at:upto]]
        i = np.repeat(some, times)
        j = np.arange(begin[at], begin[upto]) - np.repeat(begin[at:upto] - after[some], times)
        i, j = order[i], order[j]
        fits = _fits(n, parities, i, j)
        found_a.append(cls[i[fits]])
        found_b.append(cls[j[fits]])
        at = upto
    return _pairs(np.concatenate(found_a), np.concatenate(found_b)) if found_a else _pairs(cls[:0], cls[:0])


def _packed(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SET_BYTES :])


def _unpacked(content: bytes) -> np.ndarray:
    wide = np.zeros((len(content) // SET_BYTES, 8), np.uint8)
    wide[:, 8 - SET_BYTES :] = np.frombuffer(content, np.uint8).reshape(-1, SET_BYTES)
    return wide.view("<u8").reshape(-1)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets, by binary search of the smaller in the larger."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _sets_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """cls and shingles of the sets named by ``needed`` (doc_id, one for each set), computed where the texts are read.

    A bit table of the wanted ids keeps the other texts out. It may let a few more pass, which find no pair.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << TABLE_BITS))
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(bit_table(needed.select(place.alias("i")), TABLE_BITS)).tobytes())  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(wanted.value, np.uint8)

        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column(1).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))

        for batch in arrays.slices(chosen(), "text", TEXT_BYTES):
            keys, bounds = shingles(*arrays.text_bytes(batch.column(0)))
            packed = _packed(keys)
            cut = [packed[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(_class_of(keys, bounds).view(np.int64)), pa.array(cut, pa.binary())], ["cls", "shingles"])

    source = _source(docs).filter("doc_id is not null").withColumn("place", place)
    return source.select("text", "place").mapInArrow(run, "cls long, shingles binary")


def _both(pairs: DataFrame, left: DataFrame, right: DataFrame, columns: list[str], good) -> DataFrame:
    """The pairs of which ``good`` holds, given the columns of both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array([good(*values) for values in zip(*batch.columns[2:])], pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    x = left.select(F.col("cls").alias("a"), *[F.col(c).alias(f"x_{c}") for c in columns])
    y = right.select(F.col("cls").alias("b"), *[F.col(c).alias(f"y_{c}") for c in columns])
    names = [side + c for c in columns for side in ("x_", "y_")]
    return pairs.join(y, "b").join(x, "a").select("a", "b", *names).mapInArrow(run, PAIR)


def linked(docs: DataFrame, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b of sets) that are similar enough, in a written table."""

    def near(x, y, n_x, n_y) -> bool:
        return (100 + PERCENT) * least_difference(x.as_buffer(), y.as_buffer()) <= (100 - PERCENT) * (n_x.as_py() + n_y.as_py())

    def similar(x, y) -> bool:
        one, two = _unpacked(x.as_buffer()), _unpacked(y.as_buffer())
        common = overlap(one, two)
        return 100 * common >= PERCENT * (len(one) + len(two) - common)

    close = staged(_both(pairs, sets, sets, ["parities", "n"], near), f"close-{name}")
    ends = [_sets_of(docs, close.select(F.col(c).alias("cls")).distinct().join(sets, "cls").select("doc_id")) for c in ("a", "b")]
    return staged(_both(close, *ends, ["shingles"], similar).distinct(), name)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all ends of the links (a, b): labels sink to the least neighbour, then jump."""
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        sunk = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("component").alias("higher"))
        jumped = staged(sunk.join(up, "low").select("node", F.least("low", "higher").alias("component"), (F.least("low", "higher") != F.col("component")).alias("moved")), "labels")
        labels = jumped.select("node", "component")
        if not jumped.filter("moved").limit(1).count():
            return labels


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    both = pairs
    for end in ("a", "b"):
        both = both.join(found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")), end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    return both.filter("_a <> _b").select("a", "b")


def different_lists(lists: DataFrame) -> DataFrame:
    """The lists (key, cls) of two sets and more. Lists of the same sets are one; its key is a hash of the sets.

    Near copies share most of their shingles, so most lists repeat another one and would give its pairs again. Lists whose hashes were
    equal by chance would be one list of the sets of both: that loses no pair.
    """
    by_key = Window.partitionBy("key")
    shared = lists.withColumn("low", F.min("cls").over(by_key)).withColumn("high", F.max("cls").over(by_key)).filter("low < high").select("key", "cls").distinct()
    return shared.select(F.bit_xor(F.xxhash64("cls")).over(by_key).alias("key"), "cls").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""
    spark = docs.sparkSession
    known = sketches(docs)
    some = known.filter("n > 0 and doc_id is not null")
    firsts = [F.min(c).alias(c) for c in ("doc_id", "n", "short", "parities")]
    sets = staged(some.groupBy("cls").agg(*firsts), "sets")
    shared = staged(different_lists(some.select("cls", F.explode("merged").alias("key"))), "merged-lists")
    buckets = max(1, -(-shared.count() // BUCKET_ROWS))
    name = f"lists_{uuid.uuid4().hex[:12]}"
    # The lists of a bucket lie together in a bucketed table, so that both readers below find them without another shuffle.
    met = shared.join(sets.select("cls", "n", "short"), "cls").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    met.repartition(buckets, "bucket").write.bucketBy(buckets, "bucket").option("path", shared_dir(spark, "lists")).saveAsTable(name)
    lists = spark.table(name)
    led = staged(lists.groupBy("bucket").applyInArrow(_leaders, PAIR).distinct(), "leader-pairs")
    # First each member with its least leader, then with those of its leaders that this has not brought together with it.
    tested = staged(led.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "least-leaders")
    links = linked(docs, tested, sets, "leader-links")
    found = components(spark, links)
    more = staged(_apart(led.join(tested, ["a", "b"], "left_anti"), found), "more-leaders")
    links = links.unionByName(linked(docs, more, sets, "more-links"))
    tested = tested.unionByName(more)
    found = components(spark, links)
    placed = lists.select(F.col("bucket").alias("place"), F.col("cls").alias("node")).distinct().join(found, "node")
    across = lists.groupBy("bucket").cogroup(placed.groupBy("place")).applyInArrow(_across, PAIR)
    others = staged(across.distinct().join(tested, ["a", "b"], "left_anti"), "other-pairs")
    spark.sql(f"DROP TABLE {name}")
    if not others.isEmpty():
        links = links.unionByName(linked(docs, others, sets, "other-links"))
        found = components(spark, links)
    # Components of sets become components of documents, named by their smallest doc_id.
    named = sets.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "doc_id", F.coalesce("component", "cls").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(least, "component").select("cls", "component_id")
    own = known.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("cls")).alias("cls"))
    return own.join(of_set, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest doc_id of their component; of rows with that id, one is kept."""
    kept = near_duplicates(docs).filter("doc_id = component_id or doc_id is null").select(F.col("doc_id").alias("_kept")).distinct()
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    joined = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    return joined.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1 or doc_id is null").drop("_nth")
