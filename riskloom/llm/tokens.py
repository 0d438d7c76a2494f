"""Token ids of whole texts, and files of bit-packed ids.

A file holds the ids of consecutive documents, each id in the fewest bits that the vocabulary needs:

    magic (8 bytes), version, bits, ids in a block, 0 (4 x uint32), documents, ids, blocks (3 x uint64),
    doc_id of each document (int64), first id of each document and the end (uint64),
    first word of each block and the end (uint64), words (uint64, little-endian, lowest bits first)

Each block starts at a word, so that any stretch of ids is unpacked from its blocks alone. Files are written by
the tasks that hold the ids, under a temporary name and then moved, so that a repeated task gives the same
file. They are read back as Spark's binary files.

Defined results: null and empty texts have only the end id; rows with the same doc_id follow each other in
the order of their text; a null doc_id comes first and stays null; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import arrays
from riskloom.session import shared_dir, staged

MAGIC, VERSION = b"PACKIDS1", 1
HEADER = struct.Struct("<8s4I3Q")
BLOCK_IDS = 4096  # a multiple of 64, so that whole groups of lanes fill whole words
FILE_IDS = 1 << 23
END_ID = 1
NO_DOC = -(1 << 63)  # stands for a null doc_id


def id_bits(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids in words of 64 bits: 64 ids fill ``bits`` words, all groups at once, lane by lane."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    groups = -(-count // 64)
    words = words[: groups * bits].reshape(groups, bits)
    mask = np.uint64((1 << bits) - 1)
    lanes = np.empty((groups, 64), np.uint32)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, lane] = (value & mask).astype(np.uint32)
    return lanes.reshape(-1)[:count]


def file_bytes(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    blocks = -(-len(ids) // BLOCK_IDS)
    words = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK_IDS // 64 * bits), len(words))
    head = HEADER.pack(MAGIC, VERSION, bits, BLOCK_IDS, 0, len(doc_ids), len(ids), blocks)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


class PackedFile:
    """A file's bytes: documents, and any stretch of ids."""

    def __init__(self, content: bytes):
        magic, version, self.bits, self.block, _, docs, self.n_ids, blocks = HEADER.unpack_from(content)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of packed ids")
        at = HEADER.size
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.starts = np.frombuffer(content, "<u8", docs + 1, at + 8 * docs).astype(np.int64)
        at += 8 * docs + 8 * (docs + 1)
        self.offsets = np.frombuffer(content, "<u8", blocks + 1, at).astype(np.int64)
        self.words = np.frombuffer(content, "<u8", int(self.offsets[-1]), at + 8 * (blocks + 1))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop), unpacked from the blocks that hold them."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        upto = min(last * self.block, self.n_ids)
        words = self.words[self.offsets[first] : self.offsets[last]]
        return unpack(words, self.bits, upto - first * self.block)[start - first * self.block : stop - first * self.block]


_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


class Encoder:
    """Ids of texts as little-endian uint32 bytes.

    With ``by_word`` the tokenizer must drop white space and lower-case its input, as ``word_bpe_49k.json`` does:
    words then have the same ids wherever they stand, and each is encoded once and remembered. Words of a slice are told apart by two
    64-bit hashes of their bytes, and only different ones are looked up.
    """

    MAX_WORDS = 800_000
    WORD_END = "</w>"

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.WORD_END)]] = True
        # Known words by rising hash: a second hash, where their ids start, how many there are, and when they were met last.
        self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.count, self.met = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)
        self.now = 0

    @staticmethod
    def of(path: str, by_word: bool) -> "Encoder":
        """One encoder for each Python worker, kept between tasks."""
        if (path, by_word) not in _ENCODERS:
            _ENCODERS[path, by_word] = Encoder(path, by_word)
        return _ENCODERS[path, by_word]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int32)

    def _together(self, text: bytes, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, encoded as one text: each is one word of the tokenizer, and its last token ends it."""
        ids = np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != words:  # the tokenizer's letters are others than Python's
            return self._plain(text.decode().split(" "))
        return ids, np.diff(cuts, prepend=0).astype(np.int32)

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, how many each has, and the order in which the words come."""
        others = np.concatenate([[0], np.cumsum((data < 97) | (data > 122))])
        plain = others[ends] == others[starts]
        some = np.flatnonzero(plain)
        parts = []
        if len(some):
            size = ends[some] - starts[some] + 1
            last = np.cumsum(size)
            text = data[np.minimum(_stretches(starts[some], size), len(data) - 1)]
            text[last - 1] = 32  # each word with the byte behind it, which becomes a blank
            parts.append((*self._together(text[:-1].tobytes(), len(some)), some))
        rest = np.flatnonzero(~plain)
        words = [(i, data[starts[i] : ends[i]].tobytes().decode()) for i in rest.tolist()]
        for letters in (True, False):
            chosen = [(i, w) for i, w in words if w.isalpha() == letters]
            if chosen:
                texts = [w for _, w in chosen]
                parts.append((*(self._together(" ".join(texts).encode(), len(texts)) if letters else self._plain(texts)), np.array([i for i, _ in chosen])))
        return tuple(np.concatenate(c) for c in zip(*parts))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        ids, count, order = self._encoded(data, starts, ends)
        start = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, ids])
        by = np.argsort(first[order])
        at = np.searchsorted(self.hash, first[order][by])
        for name, values in (("hash", first[order]), ("check", second[order]), ("start", start), ("count", count), ("met", np.full(len(count), self.now, np.int32))):
            setattr(self, name, np.insert(getattr(self, name), at, values[by]))

    def _forget(self) -> None:
        """Keep the half of the words that were met last."""
        keep = np.sort(np.argsort(-self.met, kind="stable")[: self.MAX_WORDS // 2])
        for name in ("hash", "check", "start", "count", "met"):
            setattr(self, name, getattr(self, name)[keep])
        self.flat = self.flat[_stretches(self.start, self.count)]
        self.start = np.cumsum(self.count, dtype=np.int64) - self.count

    def _slots(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word the place of its ids, and for each document and the end its first word."""
        data = arrays.LOWER[data]
        starts, ends, bounds = arrays.words(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), bounds
        # A full stop or comma behind a letter is a token of its own, so it is cut off as a word.
        mark = data[ends - 1]
        before = data[np.maximum(ends - 2, 0)]
        cut = ((mark == 46) | (mark == 44)) & (ends - starts > 1) & (before >= 97) & (before <= 122)
        extra = np.concatenate([[0], np.cumsum(cut)])
        bounds = bounds + extra[bounds]
        at = np.flatnonzero(cut)
        starts, ends = np.insert(starts, at + 1, ends[at] - 1), np.insert(ends - cut, at + 1, ends[at])
        sums = arrays.prefix_sums(data)
        first = arrays.stretch_hashes(sums, starts, ends)
        second = arrays.mix(arrays.stretch_hashes(arrays.prefix_sums(data ^ np.uint8(0xA5)), starts, ends) + (ends - starts).astype(np.uint64))
        distinct, sample, word = np.unique(first, return_index=True, return_inverse=True)
        if (second != second[sample][word]).any():
            raise ValueError("two words share a hash")  # and so only together with the second one could they be taken for each other
        if len(self.hash) > self.MAX_WORDS:
            self._forget()
        self.now += 1
        slots = np.searchsorted(self.hash, distinct)
        held = slots < len(self.hash)
        held[held] = self.hash[slots[held]] == distinct[held]
        if (self.check[slots[held]] != second[sample][held]).any():
            raise ValueError("two words share a hash")
        if not held.all():
            new = sample[~held]
            self._learn(data, starts[new], ends[new], first[new], second[new])
            slots = np.searchsorted(self.hash, distinct)
        self.met[slots] = self.now
        return slots[word.reshape(-1)], bounds

    def _by_slice(self, column: pa.Array):
        """(first document, data, offsets, documents that hold special tokens) of slices of a text column."""
        data, offsets = arrays.text_bytes(column)
        at = 0
        while at < len(column):
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + arrays.SLICE_BYTES, "right")) - 1)
            some, bounds = data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
            marks = np.flatnonzero((some[:-1] == 60) & (some[1:] == 124))  # "<|": special tokens are looked for in the text as it is
            special = np.unique(np.searchsorted(bounds, marks, "right") - 1)
            yield at, some, bounds, special
            at = upto

    def counts(self, column: pa.Array) -> np.ndarray:
        """The number of ids of each text of a column without nulls."""
        if not self.by_word:
            return self._plain(column.to_pylist())[1].astype(np.int64)
        parts = []
        for at, data, offsets, special in self._by_slice(column):
            slots, bounds = self._slots(data, offsets)
            total = np.concatenate([[0], np.cumsum(self.count[slots], dtype=np.int64)])
            n = np.diff(total[bounds])
            if len(special):
                n[special] = self._plain([column[at + int(i)].as_py() for i in special])[1]
            parts.append(n)
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not self.by_word:
            ids, n = self._plain(column.to_pylist())
            return _cut(ids, np.concatenate([[0], np.cumsum(n)]))
        out: list[bytes] = []
        for at, data, offsets, special in self._by_slice(column):
            slots, bounds = self._slots(data, offsets)
            ids = self.flat[_stretches(self.start[slots], self.count[slots])]
            found = _cut(ids, np.concatenate([[0], np.cumsum(self.count[slots], dtype=np.int64)])[bounds])
            for i in special.tolist():
                found[i] = self._plain([column[at + i].as_py()])[0].astype("<u4").tobytes()
            out += found
        return out


def _stretches(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1 ... of all stretches, one after another."""
    before = np.cumsum(count, dtype=np.int64) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


def _cut(ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    content, at = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
    return [content[a:b] for a, b in zip(at[:-1], at[1:])]


def token_counts(docs: DataFrame, tokenizer: str, by_word: bool) -> DataFrame:
    """doc_id and n_tokens, the end id included, of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, by_word)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(encoder.counts(part.column(1)) + 1)], ["doc_id", "n_tokens"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long")


def write_files(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, by_word: bool, end_id: int = END_ID) -> DataFrame:
    """Write all documents in order of doc_id; returns name, part, number, n_docs and n_ids of each file, in a written table."""
    bits = id_bits(max(vocabulary, end_id + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        encoder = Encoder.of(tokenizer, by_word)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, pieces, sizes, number, files = [], [], [], 0, []

        def flush() -> None:
            nonlocal number
            ids = np.frombuffer(b"".join(pieces), "<u4")
            content = file_bytes(np.array(doc_ids, np.int64), np.concatenate([[0], np.cumsum(sizes)]), ids, bits)
            name = f"part-{part:07d}-{number:05d}.ids"
            temporary = f"{base}/_{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                out.write(content)
            store.move(temporary, f"{base}/{name}")
            files.append((name, part, number, len(doc_ids), len(ids)))
            number += 1
            doc_ids.clear(), pieces.clear(), sizes.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1))):
                    doc_ids.append(NO_DOC if doc_id is None else doc_id)
                    pieces.append(ids + end)
                    sizes.append(len(ids) // 4 + 1)
                if sum(sizes) >= FILE_IDS:
                    flush()
        if doc_ids:
            flush()
        columns = [list(c) for c in zip(*files)] or [[]] * 5
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["name", "part", "number", "n_docs", "n_ids"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ranged.mapInArrow(run, "name string, part int, number int, n_docs long, n_ids long"), "token-files")


def read_files(spark, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, unpacked from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                packed = PackedFile(batch.column(1)[row].as_buffer())
                ids = packed.ids(0, packed.n_ids).astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(packed.starts[:-1].tolist(), packed.starts[1:].tolist())]
                doc_ids = pa.array(packed.doc_ids, mask=packed.doc_ids == NO_DOC)
                names = pa.array([batch.column(0)[row].as_py()] * len(sums), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names, doc_ids, pa.array(packed.starts[:-1]), pa.array(np.diff(packed.starts)), pa.array(sums, pa.int64())],
                    ["name", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    # One row for each file: a running sum over the files' sizes, not over documents.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select("name", before.alias("before"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    read = content.select(F.substring_index("path", "/", -1).alias("name"), "content").mapInArrow(run, "name string, doc_id long, local long, n_tokens long, ids_crc32 long")
    return read.join(starts, "name").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int, by_word: bool) -> DataFrame:
    """Write the documents' ids to files in a fresh shared folder and read them back."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "token-ids")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    files = write_files(docs, folder, tokenizer, vocabulary, by_word)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_files(spark, folder, files)
