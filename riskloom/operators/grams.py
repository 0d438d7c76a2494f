"""Words, word n-grams and character n-grams of texts in Arrow batches, without a string for each n-gram.

Words are those of ``vectorise.words`` and ``vectorise.plain_words``. A slice of texts is one array of bytes; its words are numbered, and an
n-gram is the numbers of its words. Strings are made for the different n-grams that leave a task alone. Character n-grams are those of
``vectorise.char_ngrams`` and ``vectorise.boundary_ngrams``, as numbers of their characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that are worked on at a time, in some arrays of eight bytes for each word.
SLICE_BYTES = 1 << 23
# Different n-grams that a task holds back to add up before they leave it.
HELD_TERMS = 1 << 20
# Bytes of text whose character n-grams are sorted at a time.
CHAR_BYTES = 1 << 22
BLANK = 32
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class WordTerms:
    """The n-grams of ``low`` to ``high`` words of column ``text``; ``plain`` takes words of one character too and removes accents."""

    text: str
    low: int = 1
    high: int = 1
    plain: bool = False

    def folded(self) -> Column:
        from riskloom.operators.vectorise import strip_accents

        lowered = F.lower(F.col(self.text))
        return strip_accents(lowered) if self.plain else lowered


@dataclass(frozen=True)
class CharTerms:
    """The n-grams of ``low`` to ``high`` characters of column ``text``; ``inside`` takes those of blank-padded words."""

    text: str
    low: int
    high: int
    inside: bool = False


def _letters(spark: SparkSession) -> bytes:
    return _points(spark, r"(?U)\W+")


@cache
def _points(spark: SparkSession, others: str) -> bytes:
    """A bit for each code point: whether a regex of this Spark's Java leaves it out of ``others``."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = spark.range(1).select(F.regexp_replace(F.lit(every), others, "")).first()[0]
    held = np.zeros(0x110000, bool)
    held[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = True
    return np.packbits(held).tobytes()


class Texts:
    """The words of a slice of texts: ``words`` are the different ones, ``codes`` their numbers in order, ``text`` the number of the text of each."""

    def __init__(self, column: pa.StringArray, letters: np.ndarray, least: int):
        column = pc.fill_null(column, "")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        offsets -= offsets[0]
        mask = letters[:128][np.minimum(data, 127)] & (data < 128)
        leads = np.flatnonzero(data >= 0xC0)
        size = np.ones(256, np.int64)
        size[0xC0:0xE0], size[0xE0:0xF0], size[0xF0:] = 2, 3, 4
        if len(leads):
            length = size[data[leads]]
            point = data[leads].astype(np.int64) & (0x7F >> length)
            for k in (1, 2, 3):
                more = length > k
                point[more] = point[more] << 6 | data[leads[more] + k] & 0x3F
            part = letters[point]
            for k in range(4):
                more = part & (length > k)
                mask[leads[more] + k] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = mask[:-1], mask[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False  # a word ends with its text
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
        if least > 1:
            single = ends - starts == size[data[starts]]
            for k in range(4):
                at = starts[single] + k
                mask[at[at < ends[single]]] = False
            starts, ends = starts[~single], ends[~single]
        places = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=places[1:])
        every = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data[mask]))
        encoded = every.dictionary_encode()
        self.words, self.codes = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        self.text = np.searchsorted(offsets, starts, "right") - 1

    def starts(self, n: int) -> np.ndarray:
        """Where an n-gram starts: n words of one text follow."""
        last = len(self.codes) - n + 1
        return np.flatnonzero(self.text[:last] == self.text[n - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        """A number for each different word, the same in all tasks; other words may have it too."""
        places = np.frombuffer(self.words.buffers()[1], np.int32)[: len(self.words) + 1].astype(np.int64)
        data = np.frombuffer(self.words.buffers()[2], np.uint8)[: places[-1]]
        sizes = np.diff(places)
        powers = np.cumprod(np.full(max(1, sizes.max(initial=0)), FACTOR, np.uint64))
        inside = np.arange(len(data)) - np.repeat(places[:-1], sizes)
        return np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[inside], places[:-1]) if len(sizes) else np.zeros(0, np.uint64)

    def buckets(self, hashes: np.ndarray, at: np.ndarray, n: int, buckets: int) -> np.ndarray:
        """The bucket of each n-gram that starts at ``at``; ``hashes`` are those of all words in order."""
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total = (total ^ total >> np.uint64(29)) * FACTOR + hashes[at + k]
        total = (total ^ total >> np.uint64(32)) * FACTOR
        return (total >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64)

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """A number for each n-gram that starts at ``at``, the same for equal ones."""
        size = max(1, len(self.words))
        keys, most = self.codes[at], size
        for k in range(1, n):
            if most > (1 << 62) // size:
                found, keys = np.unique(keys, return_inverse=True)
                most = len(found)
            keys, most = keys * size + self.codes[at + k], most * size
        return keys

    def strings(self, at: np.ndarray, n: int) -> pa.StringArray:
        parts = [self.words.take(pa.array(self.codes[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]


class Characters:
    """The characters of a slice of texts as numbers: ``points`` are the different ones, ``codes`` their numbers in order, ``text`` the number of the text of each."""

    def __init__(self, column: pa.StringArray, shown: np.ndarray, inside: bool):
        column = pc.fill_null(column, "")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        ends = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])[offsets - offsets[0]]
        text = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(ends))
        same = text[1:] == text[:-1]
        blank = ~shown[points]
        if inside:  # each word behind a blank, and one at the end
            points, text, at = points[~blank], text[~blank], np.flatnonzero(~blank)
            new = np.ones(len(points), bool)
            new[1:] = (np.diff(at) > 1) | (text[1:] != text[:-1])
            word = np.cumsum(new)
            padded, of = np.full(len(points) + int(new.sum()) + 1, BLANK, np.uint32), np.zeros(len(points) + int(new.sum()) + 1, np.int32)
            place = np.arange(len(points)) + word
            padded[place], of[place], of[place[new] - 1] = points, text, text[new]
            points, text = padded, of
            self.blanks = np.concatenate([[0], np.cumsum(points == BLANK)])
        else:  # runs of white space are one blank
            more = np.zeros(len(points), bool)
            more[1:] = blank[1:] & blank[:-1] & same
            first = np.zeros(len(points), bool)
            first[:-1] = more[1:]
            points = np.where(first, np.uint32(BLANK), points)[~more]
            text = text[~more]
            self.blanks = None
        number = np.zeros(0x110000, np.int64)
        self.points = np.flatnonzero(np.bincount(points, minlength=1)).astype(np.uint32)
        number[self.points] = np.arange(len(self.points))
        self.codes, self.text, self.texts = number[points], text, len(column)

    def starts(self, n: int, whole: bool = False) -> np.ndarray:
        """Where an n-gram starts; ``whole`` takes whole padded words alone."""
        last = len(self.codes) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        if self.blanks is None:
            return np.flatnonzero(self.text[:last] == self.text[n - 1 :])
        free = self.blanks[n - 1 : n - 1 + last] == self.blanks[1 : 1 + last]  # no blank but the first and the last character
        if whole:
            free &= np.diff(self.blanks)[:last].astype(bool) & np.diff(self.blanks)[n - 1 :].astype(bool)
        return np.flatnonzero(free)

    def counted(self, at: np.ndarray, n: int) -> pa.RecordBatch:
        """(term, total, doc) of the n-grams that start at ``at``."""
        size, texts = max(1, len(self.points)), max(1, self.texts)
        own, bits = self.text[at], texts.bit_length()  # a blank has the text of the word behind it
        if size**n << bits < 1 << 62:
            last = len(self.codes) - n + 1
            keys = self.codes[:last].copy() if last > 0 else self.codes[:0]
            for k in range(1, n):
                keys *= size
                keys += self.codes[k : last + k]
            pairs = keys[at] << bits | own
            pairs.sort()
            keys = pairs >> bits
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            found = keys[first]
            rows = np.stack([found // size ** (n - 1 - k) % size for k in range(n)], axis=1)
            new = np.diff(pairs, prepend=-1) != 0
            total, doc = np.diff(first, append=len(pairs)), np.add.reduceat(new, first, dtype=np.int64) if len(first) else first
        else:
            keys, most = self.codes[at], size
            for k in range(1, n):
                if most > (1 << 62) // size:
                    found, keys = np.unique(keys, return_inverse=True)
                    most = len(found)
                keys, most = keys * size + self.codes[at + k], most * size
            _, first, number = np.unique(keys, return_index=True, return_inverse=True)
            rows = np.stack([self.codes[at[first] + k] for k in range(n)], axis=1)
            pairs = np.unique(number * texts + own)
            total, doc = np.bincount(number, minlength=len(first)), np.bincount(pairs // texts, minlength=len(first))
        points = self.points[rows.ravel()] if len(rows) else np.zeros(0, np.uint32)
        lengths = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
        ends = np.concatenate([[0], np.cumsum(lengths)])[::n].astype(np.int32)
        content = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        terms = pa.StringArray.from_buffers(len(rows), pa.py_buffer(ends), pa.py_buffer(content))
        return pa.RecordBatch.from_arrays([terms, pa.array(total, pa.int64()), pa.array(doc, pa.int64())], ["term", "total", "doc"])


def char_statistics(df: DataFrame, terms: CharTerms) -> DataFrame:
    """(term, total, doc) of character n-grams, in parts to be added up: a term is a row once for a slice of texts."""
    if terms.low < 2 and terms.inside:
        raise ValueError("n-grams of padded words have two characters at least")
    shows = _points(df.sparkSession, r"(?U)\s+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = _unpacked(shows)
        for batch in batches:
            for column in slices(batch.column(0), CHAR_BYTES):
                found = Characters(column, shown, terms.inside)
                for n in range(terms.low, terms.high + 1):
                    yield found.counted(found.starts(n), n)
                for n in range(3, terms.low if terms.inside else 0):  # a shorter word gives itself
                    yield found.counted(found.starts(n, whole=True), n)

    return df.select(F.lower(F.col(terms.text))).mapInArrow(run, "term string, total long, doc long")


def slices(column: pa.StringArray, size: int | None = None) -> Iterator[pa.StringArray]:
    """Texts of about ``size`` bytes (``SLICE_BYTES``) together, one at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (size or SLICE_BYTES), "right")))
        yield column.slice(at, upto - at)
        at = upto


def _unpacked(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)


def bucket_totals(df: DataFrame, terms: WordTerms, buckets: int) -> DataFrame:
    """(bucket, n): how many n-grams are in each of ``buckets`` buckets, a power of two. A task sends each bucket once."""
    letters, least = _letters(df.sparkSession), 1 if terms.plain else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _unpacked(letters), np.zeros(buckets, np.int64)
        for batch in batches:
            for column in slices(batch.column(0)):
                texts = Texts(column, known, least)
                hashes = texts.hashes()[texts.codes]
                for n in range(terms.low, terms.high + 1):
                    total += np.bincount(texts.buckets(hashes, texts.starts(n), n, buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return df.select(terms.folded()).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def statistics(df: DataFrame, terms: WordTerms, buckets: int, chosen: np.ndarray) -> DataFrame:
    """(term, total, doc) of the n-grams in the chosen buckets, in parts to be added up."""
    letters, least = _letters(df.sparkSession), 1 if terms.plain else 2
    wanted = np.zeros(buckets, bool)
    wanted[chosen] = True
    packed = np.packbits(wanted).tobytes()

    def counted(texts: Texts, at: np.ndarray, n: int) -> pa.Table:
        _, first, number = np.unique(texts.keys(at, n), return_index=True, return_inverse=True)
        pairs = np.sort(texts.text[at] * max(1, len(first)) + number)
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        doc = np.bincount(pairs[new] % max(1, len(first)), minlength=len(first))
        return pa.table([texts.strings(at[first], n), pa.array(np.bincount(number, minlength=len(first))), pa.array(doc)], ["term", "total", "doc"])

    def added(parts: list[pa.Table]) -> pa.Table:
        summed = pa.concat_tables(parts).group_by("term").aggregate([("total", "sum"), ("doc", "sum")])
        return summed.select(["term", "total_sum", "doc_sum"]).rename_columns(["term", "total", "doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kept = _unpacked(letters), _unpacked(packed)
        held: list[pa.Table] = []
        for batch in batches:
            for column in slices(batch.column(0)):
                texts = Texts(column, known, least)
                hashes = texts.hashes()[texts.codes]
                for n in range(terms.low, terms.high + 1):
                    at = texts.starts(n)
                    held.append(counted(texts, at[kept[texts.buckets(hashes, at, n, buckets)]], n))
                if sum(map(len, held)) > HELD_TERMS:
                    held = [added(held)]
                    if len(held[0]) > HELD_TERMS // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from added(held).to_batches()

    return df.select(terms.folded()).mapInArrow(run, "term string, total long, doc long")


class Vocabulary:
    """The n-grams of a list of terms as numbers of words, one level for each further word, so that they are found without strings."""

    def __init__(self, terms: list[str], high: int):
        parts = [term.split(" ") for term in terms]
        self.size, self.words = len(terms), sorted({word for part in parts for word in part})
        number = {word: i for i, word in enumerate(self.words)}
        numbers = [tuple(number[word] for word in part) for part in parts]
        self.levels = []  # keys of prefixes (prefix before, then word) in order, and the place in ``terms`` of each that is a term
        before: dict[tuple, int] = {(): 0}
        for k in range(1, high + 1):
            prefixes = sorted({n[:k] for n in numbers if len(n) >= k}, key=lambda p: (before[p[:-1]], p[-1]))
            keys = np.array([before[p[:-1]] * len(self.words) + p[-1] for p in prefixes], np.int64)
            before = {p: i for i, p in enumerate(prefixes)}
            slots = np.full(len(prefixes), -1, np.int64)
            for place, n in enumerate(numbers):
                if len(n) == k:
                    slots[before[n]] = place
            self.levels.append((keys, slots))

    def counted(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of texts, places of terms, and how often the term is in the text; by text, then by place."""
        known = pc.fill_null(pc.index_in(texts.words, value_set=pa.array(self.words, pa.string())), -1).to_numpy().astype(np.int64)
        word, found = known[texts.codes], []
        at = np.flatnonzero(word >= 0)
        prefix = np.zeros(len(at), np.int64)
        for k, (keys, slots) in enumerate(self.levels):
            if k:
                inside = at + k < len(word)
                at, prefix = at[inside], prefix[inside]
                same = (texts.text[at + k] == texts.text[at]) & (word[at + k] >= 0)
                at, prefix = at[same], prefix[same]
            if not len(keys):
                break
            wanted = prefix * len(self.words) + word[at + k]
            spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[spot] == wanted
            at, prefix = at[hit], spot[hit]
            slot = slots[prefix]
            found.append(texts.text[at[slot >= 0]] * self.size + slot[slot >= 0])
        pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        most = max(1, self.size)
        return pairs[first] // most, pairs[first] % most, np.diff(first, append=len(pairs))


def matched(spark: SparkSession, terms: WordTerms, vocabulary: list[str], sublinear: bool = False) -> Column:
    """How often each term of ``vocabulary`` is in a text, as one sparse vector; ``sublinear`` takes one plus the logarithm of it."""
    letters, least = _letters(spark), 1 if terms.plain else 2
    within = [term if terms.low <= term.count(" ") + 1 <= terms.high else "" for term in vocabulary]  # no word is empty, so this is never found

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, found = _unpacked(letters), Vocabulary(within, terms.high)
        for column in columns:
            sizes, places, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for part in slices(column):
                text, place, count = found.counted(Texts(part, known, least))
                sizes.append(np.bincount(text, minlength=len(part)))
                places.append(place)
                counts.append(count)
            ends = np.zeros(len(column) + 1, np.int32)
            np.cumsum(np.concatenate(sizes), out=ends[1:])
            values = np.concatenate(counts).astype(np.float64)
            yield pa.StructArray.from_arrays([
                pa.array(np.zeros(len(column), np.int8)), pa.array(np.full(len(column), len(within), np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(1 + np.log(values) if sublinear else values)),
            ], ["type", "size", "indices", "values"])

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, VectorUDT())(terms.folded())
