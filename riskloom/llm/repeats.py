"""Bytes that repeat an earlier document: a depth-limited radix sort of suffixes over all documents.

Suffixes matter only to the depth of ``DEPTH`` bytes, so equal groups of the sort are exactly the repeated windows.
The passes go from the most significant digit on, and each drops what is already decided:

1. First digit: the window's anchor, its least ``ANCHOR``-byte substring by hash. All windows around one anchor move
   as one key, about a sixteenth of the positions. Anchors of one document only end here.
2. Second digit: all bytes that the windows around an anchor cover. Where an earlier document has the same bytes,
   every window is a repeat; the others go on only if the anchor stands among different bytes too.
3. Last digit: each remaining window.

Documents stay in blocks, a bucketed table that no pass shuffles. A block sends the distinct keys of its
documents, sorted and cut by range, and gets one answer for each key in the same order, so a key that fills a third
of the corpus arrives once from each block. Keys are 64-bit hashes of the bytes.

Defined results: a null or empty text has no bytes; texts shorter than ``DEPTH`` bytes have no windows; documents with
equal doc_id are not earlier than each other; a null doc_id is earlier than all others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import arrays
from riskloom.session import shared_dir, staged

DEPTH = 50
ANCHOR = 20
NO_DOC = -(1 << 63)
# Text in a block, about. A worker holds one block and, for each sixteenth byte or so, 40 bytes of what it knows.
# Blocks times blocks answers are exchanged, so let blocks grow with the corpus as far as memory allows.
BLOCK_BYTES = 8 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with the same anchor: (anchor hash, hash of all their bytes, first window, windows, document).

    Of equal hashes the leftmost is the anchor, so the choice depends on the window's bytes alone.
    """
    none = np.zeros(0, np.int64)
    if len(data) < depth:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    sums = arrays.prefix_sums(data)
    gram = arrays.stretch_hashes(sums, np.arange(len(data) - size + 1), np.arange(size, len(data) + 1))
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    wide, done = depth - size + 1, 1
    while done * 2 <= wide:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < wide:
        least = np.minimum(least[: len(least) - (wide - done)], least[wide - done :])
    own = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = arrays.doc_numbers(offsets)
    left = offsets[1:][doc] - np.arange(len(data))
    at = np.flatnonzero(left[: len(own)] >= depth)
    own = own[at]
    new = np.ones(len(at), bool)
    new[1:] = own[1:] != own[:-1]
    run = np.flatnonzero(new)
    first = at[run]
    count = np.diff(np.append(run, len(at)))
    anchor = own[run]
    around = arrays.mix(arrays.stretch_hashes(sums, first, first + count - 1 + depth) + (anchor - first).astype(np.uint64))
    return gram[anchor], around, first, count, doc[first] if len(first) else none


def _grouped(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the least document of each, and the place of every input key among them."""
    distinct, place = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, place, docs)
    return distinct, least, place


class Block:
    """The documents of one block and what its passes know of them. Arrays depend on the documents alone, not on their order."""

    def __init__(self, table: pa.Table):
        self.doc_ids = table.column("doc_id").fill_null(NO_DOC).to_numpy()
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        kinds = (np.uint64, np.uint64, np.int32, np.int32, np.int32, np.int32)
        found: list[list[np.ndarray]] = [[] for _ in kinds]
        row = 0
        batches = iter(table.select(["text"]).combine_chunks().to_batches())
        for number, batch in enumerate(arrays.slices(batches, "text", arrays.SLICE_BYTES // 2)):
            data, offsets = arrays.text_bytes(batch.column(0))
            key, around, first, count, doc = anchors(data, offsets)
            for kept, values, kind in zip(found, (key, around, first, count, doc + row, np.full(len(key), number)), kinds):
                kept.append(values.astype(kind))
            self.parts.append((data, offsets))
            row += batch.num_rows
        self.key, self.around, self.first, self.count, self.row, self.part = [np.concatenate([np.zeros(0, t), *found.pop(0)]) for t in kinds]
        self.doc = self.doc_ids[self.row] if len(self.row) else np.zeros(0, np.int64)

    # Pass 1
    def anchor_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors and whether documents with different ids of this block have them."""
        self.keys, least, self.at = _grouped(self.key, self.doc)
        many = np.zeros(len(self.keys), bool)
        many[self.at[self.doc != least[self.at]]] = True
        return self.keys, many

    # Pass 2
    def stretches(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (anchor, bytes around it) of the anchors that several documents have, with their least documents."""
        self.some = np.flatnonzero(repeated[self.at])
        key, around, doc = self.key[self.some], self.around[self.some], self.doc[self.some]
        order = np.lexsort((doc, around, key))
        new = np.ones(len(order), bool)
        k, a = key[order], around[order]
        new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1])
        self.stretch = np.empty(len(order), np.int64)
        self.stretch[order] = np.cumsum(new) - 1
        return k[new], a[new], doc[order][new]

    # Pass 3
    def window_keys(self, least: np.ndarray, varied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows that pass 2 left open, with their least documents. ``least`` and ``varied`` are its answers."""
        doc = self.doc[self.some]
        self.whole = self.some[least[self.stretch] < doc]
        self.open = self.some[(least[self.stretch] >= doc) & varied[self.stretch]]
        hashes, self.spots = [], []
        for number, (data, _) in enumerate(self.parts):
            mine = self.open[self.part[self.open] == number]
            n = self.count[mine].astype(np.int64)
            spot = np.repeat(self.first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            self.spots.append((spot, np.repeat(self.row[mine], n)))
            hashes.append(arrays.stretch_hashes(arrays.prefix_sums(data), spot, spot + DEPTH) if len(spot) else np.zeros(0, np.uint64))
        rows = np.concatenate([r for _, r in self.spots]) if self.spots else np.zeros(0, np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        keys, least_doc, self.window = _grouped(flat, self.doc_ids[rows] if len(rows) else np.zeros(0, np.int64))
        return keys, least_doc

    def result(self, least: np.ndarray) -> Iterator[tuple[int | None, int, int, int, str]]:
        """doc_id, bytes, removed bytes, removed runs and the digest of what is left of each document."""
        done = row = 0
        for number, (data, offsets) in enumerate(self.parts):
            starts = np.zeros(len(data) + 1, np.int32)
            spot, rows = self.spots[number]
            repeated = least[self.window[done : done + len(spot)]] < self.doc_ids[rows] if len(spot) else np.zeros(0, bool)
            done += len(spot)
            starts[spot[repeated]] = 1
            mine = self.whole[self.part[self.whole] == number]
            n = self.count[mine].astype(np.int64)
            starts[np.repeat(self.first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = 1
            total = np.cumsum(starts)
            covered = total[:-1].copy()
            covered[DEPTH:] -= total[: max(0, len(data) - DEPTH)]
            gone = covered > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            begins = gone & (np.concatenate([[True], ~gone[:-1]]) | edge[:-1]) if len(data) else gone
            removed = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(begins)])
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                part = data[a:b] if removed[a] == removed[b] else data[a:b][~gone[a:b]]
                doc_id = int(self.doc_ids[row])
                yield (None if doc_id == NO_DOC else doc_id), b - a, int(removed[b] - removed[a]), int(spans[b] - spans[a]), hashlib.sha256(part.tobytes()).hexdigest()
                row += 1


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the ranges of sorted keys that go to each bucket."""
    edges = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


SENT = "bucket int, block int, keys binary, extra binary, docs binary"
ANSWER = "block int, step int, bucket int, least binary, flags binary"


def _sent(block: int, buckets: int, keys: np.ndarray, extra: np.ndarray | None, docs: np.ndarray | None) -> pa.Table:
    bounds = _cuts(keys, buckets)
    rows = []
    for bucket, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a < b:
            rows.append((bucket, block, keys[a:b].tobytes(), None if extra is None else extra[a:b].tobytes(), None if docs is None else docs[a:b].tobytes()))
    columns = [list(c) for c in zip(*rows)] or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("bucket", "block", "keys", "extra", "docs"), columns, kinds)})


def _answers(step: int):
    """The answers of one bucket to all blocks, key for key."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name).combine_chunks()]
        keys = read("keys", np.uint64)
        sizes = np.cumsum([0] + [len(k) for k in keys])
        flat = np.concatenate(keys)
        least = flags = None
        if step == 1:
            many = np.concatenate(read("extra", bool))
            order = np.argsort(flat, kind="stable")
            k = flat[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            repeated = (size > 1) | (np.bincount(group, many[order]) > 0)
            flags = np.empty(len(k), bool)
            flags[order] = repeated[group]
        else:
            docs = np.concatenate(read("docs", np.int64))
            extra = np.concatenate(read("extra", np.uint64)) if step == 2 else np.zeros(len(flat), np.uint64)
            order = np.lexsort((extra, flat))
            k, x = flat[order], extra[order]
            new_key = np.ones(len(k), bool)
            new_key[1:] = k[1:] != k[:-1]
            new = new_key.copy()
            new[1:] |= x[1:] != x[:-1]
            group = np.cumsum(new) - 1
            least = np.empty(len(k), np.int64)
            least[order] = np.minimum.reduceat(docs[order], np.flatnonzero(new))[group]
            of_key = np.cumsum(new_key) - 1
            flags = np.empty(len(k), bool)
            flags[order] = (np.bincount(of_key, new) > 1)[of_key]
        cut = list(zip(sizes[:-1], sizes[1:]))
        n = len(cut)
        return pa.table({
            "block": table.column("block").cast(pa.int32()), "step": pa.array([step] * n, pa.int32()), "bucket": pa.array([key[0].as_py()] * n, pa.int32()),
            "least": pa.array([None if least is None else least[a:b].tobytes() for a, b in cut], pa.binary()),
            "flags": pa.array([flags[a:b].tobytes() for a, b in cut], pa.binary()),
        })

    return run


def _known(table: pa.Table, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers to one block, put together in the order of its keys."""
    rows = sorted((r for r in table.to_pylist() if r["step"] == step), key=lambda r: r["bucket"])
    least = b"".join(r["least"] or b"" for r in rows)
    return np.frombuffer(least, np.int64), np.frombuffer(b"".join(r["flags"] for r in rows), bool)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _replayed(table: pa.Table, answers: pa.Table, steps: int) -> tuple[Block, tuple]:
    """A block, taken through the passes that have been answered, and the keys of the next one."""
    block = Block(table)
    sent: tuple = block.anchor_keys()
    if steps >= 1:
        sent = block.stretches(_known(answers, 1)[1])
    if steps >= 2:
        sent = block.window_keys(*_known(answers, 2))
    return block, sent


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    splits = max(1, source.rdd.getNumPartitions())
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    each = max(1, -(-size // (splits * BLOCK_BYTES)))
    count = splits * each
    name = f"repeat_blocks_{uuid.uuid4().hex[:12]}"
    # Some blocks for each split of the scan. Bucketing by block lets the passes below meet their answers without a shuffle of texts.
    block = (F.spark_partition_id() * each + F.pmod(F.xxhash64("doc_id"), F.lit(each))).cast("int")
    source.withColumn("block", block).write.bucketBy(count, "block").option("path", shared_dir(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)

    def first(key: tuple, table: pa.Table) -> pa.Table:
        _, (keys, many) = _replayed(table, None, 0)
        return _sent(key[0].as_py(), count, keys, many, None)

    def second(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        _, (keys, around, least) = _replayed(table, answers, 1)
        return _sent(key[0].as_py(), count, keys, around, least)

    def third(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        _, (keys, least) = _replayed(table, answers, 2)
        return _sent(key[0].as_py(), count, keys, None, least)

    def last(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        block, _ = _replayed(table, answers, 2)
        rows = list(block.result(_known(answers, 3)[0]))
        columns = [list(c) for c in zip(*rows)] or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), columns, kinds)})

    def answered(sent: DataFrame, step: int) -> DataFrame:
        return staged(sent.groupBy("bucket").applyInArrow(_answers(step), ANSWER), f"repeats-{step}")

    own = blocks.groupBy("block")
    known = answered(own.applyInArrow(first, SENT), 1)
    known = known.unionByName(answered(own.cogroup(known.groupBy("block")).applyInArrow(second, SENT), 2))
    known = known.unionByName(answered(own.cogroup(known.groupBy("block")).applyInArrow(third, SENT), 3))
    return own.cogroup(known.groupBy("block")).applyInArrow(last, RESULT)
