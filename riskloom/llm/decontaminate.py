"""Benchmark decontamination by template windows.

Texts and benchmark items become token sequences in which numbers, names and units are typed placeholders.
Windows of ``SIZE`` tokens are joined by hash. For each alignment of a document with an item the values in the
placeholders are compared: a re-parameterised copy maps each value of the item to one value of the document.
Documents whose consistent alignments cover enough windows of an item are contaminated by it.

A capitalised word that begins a text, line or sentence may be a name or not. So each text has two templates, one in
which such words stay literal and one in which they are names; each is joined with its like and checked on its own.
Windows that begin at the same word of an item count once, in whichever template they are met.

A template of fewer words than placeholders says too little. Where an item's window is such, the literal words that begin
there are looked for instead, and so are all literal windows of an item that has words enough but, as names of several
words are one token, too few tokens. Coverage is the largest of three shares: of the windows of either template, and of all.

One edit breaks ``SIZE`` windows. So an item is found, too, where its matched windows together hold ``WORD_COVERAGE`` of its
words: a phrase may be missing from a copy, or stand in it anew.

A line without small letters says nothing about names: its words are literal. An item of fewer than ``SHORTEST`` words is
searched for as it is, and found where a text has it as a sentence or line of its own.

A fixed-size bit table of the benchmark's hashes, the same at every scale, keeps windows without a partner
out of the shuffle; the join decides.

Defined results: null and empty texts and items match nothing, and so do items without words; repeated items each match; repeated documents give the same rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import arrays
from riskloom.session import staged

SIZE = 8
SHORTEST = 5
COVERAGE = 0.5
WORD_COVERAGE = 0.75
FILTER_BITS = 24

# --- Fixed values: units behind a number. ---
UNITS = (
    "mm", "cm", "dm", "m", "km", "inch", "inches", "ft", "foot", "feet", "yd", "yard", "yards", "mile", "miles", "mg", "g", "kg", "ton",
    "tons", "tonnes", "gram", "grams", "kilogram", "kilograms", "oz", "ounce", "ounces", "lb", "lbs", "pound", "pounds", "ml", "cl", "dl",
    "l", "litre", "litres", "liter", "liters", "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "meter", "meters", "metre", "metres", "kilometer",
    "kilometers", "kilometre", "kilometres", "percent", "dollar", "dollars", "cent", "cents", "euro", "euros", "degree", "degrees",
    "mph", "kmh", "km/h", "m/s", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "a", "j", "kj", "cal", "kcal", "n", "pa", "k", "c", "f",
)

WORD, NUMBER, NAME, UNIT = range(4)
# Forms of a text: its template, the one in which capitalised openers are names too, and its words as they are.
PLAIN, OPENERS, LITERAL = range(3)
SALT = arrays.mix(np.arange(3))
MARKS = {NUMBER: np.uint64(0x1111111111111111), NAME: np.uint64(0x2222222222222222), UNIT: np.uint64(0x3333333333333333)}
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
IN_NUMBER = DIGIT.copy()
IN_NUMBER[list(b".,:/%-")] = True
ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[list(b".!?:;\"")] = True


def _lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin letters of two bytes (À to Þ)."""
    low = arrays.LOWER[data]
    if len(low) > 1:
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        low[latin] += 32
    return low


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return arrays.stretch_hashes(arrays.prefix_sums(data), np.array([0]), np.array([len(data)]))[0]


def _small_letters(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Number of small letters of each word: ASCII, and Latin letters of two bytes (ß to ÿ)."""
    small = (data >= 97) & (data <= 122)
    small[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x9F) & (data[1:] != 0xB7)
    counted = np.concatenate([[0], np.cumsum(small)])
    return counted[last] - counted[first]


UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))


def _typed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bare words of the texts: hash, document, and whether each is a number, a unit, capitalised, and an opener."""
    starts, ends, _ = arrays.words(data, offsets)
    bare = ~PUNCTUATION[data]
    spot = np.arange(len(data))
    if len(data):
        following = np.minimum.accumulate(np.where(bare, spot, len(data))[::-1])[::-1]
        previous = np.maximum.accumulate(np.where(bare, spot, -1))
        first, last = following[starts], previous[ends - 1] + 1
    else:
        first, last = starts, ends
    some = first < last
    raw_end = ends[some]
    first, last, word = first[some], last[some], starts[some]
    doc = np.searchsorted(offsets, word, "right") - 1
    low = _lowered(data)
    value = arrays.stretch_hashes(arrays.prefix_sums(low), first, last)
    n = len(first)
    number, unit, capital, opening = (np.zeros(n, bool) for _ in range(4))
    if n:
        within = np.concatenate([[0], np.cumsum(IN_NUMBER[data])])
        number = DIGIT[data[first]] & (within[last] - within[first] == last - first)
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        opening[0] = True
        opening[1:] = (doc[1:] != doc[:-1]) | (lines[word[1:]] != lines[word[:-1]]) | ENDS_SENTENCE[data[raw_end[:-1] - 1]]
        capital = low[first] != data[first]
        capital |= (data[first] == 0xC3) & (low[np.minimum(first + 1, len(data) - 1)] != data[np.minimum(first + 1, len(data) - 1)])
        line = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (lines[word[1:]] != lines[word[:-1]])]))
        capital &= np.bincount(line, _small_letters(data, first, last))[line] > 0
        unit[1:] = number[:-1] & (doc[1:] == doc[:-1])
        at = np.minimum(np.searchsorted(UNIT_HASHES, value), len(UNIT_HASHES) - 1)
        unit &= UNIT_HASHES[at] == value
    return value, doc, number, unit, capital, opening


def _form(typed: tuple[np.ndarray, ...], n_docs: int, form: int) -> tuple[np.ndarray, ...]:
    """Tokens of a form: their hashes, kinds, value hashes, the bounds of documents among them, and their first words."""
    value, doc, number, unit, capital, opening = typed
    n = len(value)
    kind = np.zeros(n, np.int8)
    if form != LITERAL:
        kind[capital if form == OPENERS else capital & ~opening] = NAME
        kind[number] = NUMBER
        kind[unit] = UNIT
    keep = np.arange(n)
    if n:
        joined = np.zeros(n, bool)
        joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (doc[1:] == doc[:-1]) & ~opening[1:]
        keep = np.flatnonzero(~joined)
        order = np.arange(n) - np.repeat(keep, np.diff(np.append(keep, n)))  # place within a name of several words
        value = np.add.reduceat(arrays.mix(value + order.astype(np.uint64)), keep)
    kind, kept = kind[keep], doc[keep]
    token = value.copy()
    for k, mark in MARKS.items():
        token[kind == k] = mark
    every = np.arange(n_docs + 1)
    return token, kind, value, np.searchsorted(kept, every), keep - np.searchsorted(doc, every)[kept]


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens (hashes), their kinds, the hashes of their values, and the bounds of documents among them.

    Punctuation around words is ignored. A capitalised word is a name unless it begins a text, line or sentence;
    neighbouring names are one.
    """
    return _form(_typed(data, offsets), len(offsets) - 1, PLAIN)[:4]


def _poor(kind: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether a window of fewer words than placeholders begins at a token; ``own`` gives each document's window size."""
    doc = arrays.doc_numbers(bounds)
    size = own[doc]
    at = np.arange(len(kind))
    fixed = np.concatenate([[0], np.cumsum(kind == WORD)])
    return (at + size <= bounds[doc + 1]) & (2 * (fixed[np.minimum(at + size, len(kind))] - fixed[at]) < size)


def windows(data: np.ndarray, offsets: np.ndarray, sizes: dict[int, tuple[int, ...]] | None, wanted: np.ndarray | None = None):
    """The (form, size, document, position, first word, next word, hash, slot values) of all windows of which half the tokens are words.

    ``sizes`` gives the sizes of each form, or None for items, which may be shorter than ``SIZE``. Items have literal windows
    only where a window of the plain template has too few words, and all of them where that has too few tokens.
    Windows of fewer than ``SHORTEST`` words are literal, whole items or whole sentences.
    """
    typed = _typed(data, offsets)
    n_words = np.bincount(typed[1], minlength=len(offsets) - 1)
    begin = np.concatenate([[0], np.cumsum(n_words)])  # first word of each document
    edge = np.concatenate([typed[5], [True]])  # words that open a sentence or line, and the end
    edge[begin[:-1][n_words > 0]] = True
    literal = np.zeros(len(typed[1]), bool)  # words of items with which literal windows begin
    for form in (PLAIN, OPENERS, LITERAL) if sizes is None else sizes:
        token, kind, value, bounds, word = _form(typed, len(offsets) - 1, form)
        own = np.minimum(np.diff(bounds), SIZE)
        if sizes is None and form == PLAIN:
            poor = np.flatnonzero(_poor(kind, bounds, own))
            literal[begin[np.searchsorted(bounds, poor, "right") - 1] + word[poor]] = True
            literal |= np.repeat(own < SHORTEST, n_words)
        slot = np.where(kind == WORD, np.uint64(0), value | np.uint64(1))
        fixed = np.concatenate([[0], np.cumsum(kind == WORD)])
        least = 1 if form == LITERAL else SHORTEST
        for size in sorted(set(own[own >= least].tolist())) if sizes is None else sizes[form]:
            hashes = arrays.window_hashes(token, size) ^ np.uint64(size) ^ SALT[form]
            at = np.arange(len(hashes))
            good = 2 * (fixed[at + size] - fixed[at]) >= size
            if wanted is not None:
                good &= wanted[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            at = at[good]
            doc = np.searchsorted(bounds, at, "right") - 1
            inside = at + size <= bounds[doc + 1]
            if sizes is None:
                inside &= own[doc] == size
            at, doc = at[inside], doc[inside]
            if sizes is None and form == LITERAL:
                at, doc = at[literal[at]], doc[literal[at]]
            if sizes is not None and size < SHORTEST:
                alone = edge[at] & edge[at + size]  # literal tokens are words
                at, doc = at[alone], doc[alone]
            upto = np.where(at + size < bounds[doc + 1], word[np.minimum(at + size, len(word) - 1)], n_words[doc])
            yield form, size, doc, at - bounds[doc], word[at], upto, hashes[at], slot[at[:, None] + np.arange(size)[None, :]]


WINDOW = "id long, form int, size int, pos int, word int, upto int, hash long, slots array<long>"


def _window_rows(source: DataFrame, sizes: dict[int, tuple[int, ...]] | None, wanted=None) -> DataFrame:
    """Windows of the texts of ``source`` (id, text). ``sizes`` gives the sizes of each form, or None for items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if wanted is None else np.unpackbits(np.frombuffer(wanted.value, np.uint8)).astype(bool)
        for batch in arrays.slices(batches, "text"):
            data, offsets = arrays.text_bytes(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for form, size, doc, pos, word, upto, hashes, slots in windows(data, offsets, sizes, table):
                flat = pa.array(slots.astype(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, slots.size + 1, size, dtype=np.int32)), flat)
                fixed = [pa.array(np.full(len(doc), x, np.int32)) for x in (form, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[doc], pa.int64()), *fixed, *[pa.array(x.astype(np.int32)) for x in (pos, word, upto)], pa.array(hashes.astype(np.int64)), lists],
                    ["id", "form", "size", "pos", "word", "upto", "hash", "slots"],
                )

    return source.mapInArrow(run, WINDOW)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, word_coverage: float = WORD_COVERAGE) -> DataFrame:
    """doc_id, item_id, n_windows matched, item_windows, coverage, word_coverage, n_slots and n_changed of each contaminated pair.

    The windows are those of one template or all, whichever gives the largest share. ``n_slots`` and ``n_changed``
    are those of the alignment with most windows; ``n_changed`` counts the values that differ, all consistently: 0 for a
    verbatim copy.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").filter("id is not null and text is not null")
    item_rows = staged(_window_rows(items, None).dropDuplicates(["id", "form", "size", "pos"]), "benchmark-windows")
    # First words of each item's windows, and the words in them; as many as the item has words at most.
    of_form = [F.collect_set(F.when(F.col("form") == form, F.col("word"))) for form in (PLAIN, OPENERS)]
    words_of = item_rows.select(F.col("id").alias("item_id"), F.explode(F.sequence("word", F.col("upto") - 1)).alias("w"))
    n_words = words_of.groupBy("item_id").agg(F.count_distinct("w").alias("item_words"))
    totals = item_rows.groupBy(F.col("id").alias("item_id")).agg(F.array(*of_form, F.collect_set("word")).alias("counted")).join(n_words, "item_id")
    pairs_of_sizes = [(r.form, r["size"]) for r in item_rows.select("form", "size").distinct().collect()]  # at most SIZE for each form
    sizes = {form: tuple(size for f, size in pairs_of_sizes if f == form) for form in sorted({f for f, _ in pairs_of_sizes})}
    table = np.zeros(1 << FILTER_BITS, bool)
    top = F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("top")
    for part in item_rows.select(top).distinct().toLocalIterator():  # at most 2**FILTER_BITS numbers
        table[part.top] = True
    wanted = spark.sparkContext.broadcast(np.packbits(table).tobytes())  # fixed size
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).filter("id is not null")
    doc_rows = _window_rows(texts, sizes, wanted)
    matched = doc_rows.select(F.col("id").alias("doc_id"), "hash", F.col("pos").alias("doc_pos"), F.col("slots").alias("doc_slots")).join(
        item_rows.select(F.col("id").alias("item_id"), "form", "hash", "pos", "word", "upto", "slots"), "hash"
    ).withColumn("shift", F.col("doc_pos") - F.col("pos"))
    matched = staged(matched.drop("hash", "doc_pos", "pos").distinct(), "benchmark-matches")
    alignment = ["doc_id", "item_id", "form", "shift"]
    slots = matched.select(*alignment, F.explode(F.arrays_zip("slots", "doc_slots")).alias("s")).filter("s.slots != 0").groupBy(*alignment, F.col("s.slots").alias("slot")).agg(
        F.min("s.doc_slots").alias("low"), F.max("s.doc_slots").alias("high")
    )
    checked = slots.groupBy(*alignment).agg(
        F.count("*").alias("n_slots"), F.sum((F.col("low") != F.col("high")).cast("long")).alias("clashes"),
        F.sum((F.col("low") != F.col("slot")).cast("long")).alias("n_changed"),
    )
    spans = matched.groupBy(*alignment).agg(F.collect_set(F.struct("word", "upto")).alias("spans"))  # bounded by the item's length
    consistent = spans.join(checked, alignment, "left").filter("coalesce(clashes, 0) = 0")
    rank = F.struct(
        F.size("spans").alias("n"), (-F.coalesce("n_changed", F.lit(0))).cast("long").alias("unchanged"), (-F.col("form")).alias("form"),
        F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
    )
    # Spans are exploded before they are put together, so a text that repeats an item holds each span once.
    met = consistent.withColumn("rank", rank).select("doc_id", "item_id", "rank", F.explode("spans").alias("span")).groupBy("doc_id", "item_id").agg(
        F.collect_set("span").alias("spans"), F.max("rank").alias("largest")
    ).join(totals, "item_id").withColumn("words", F.array_distinct("spans.word"))

    def share(counted):
        n, of = F.size(F.array_intersect("words", counted)).cast("long"), F.size(counted).cast("long")
        return F.struct(F.when(of > 0, n / of).otherwise(0.0).alias("coverage"), n.alias("n_windows"), of.alias("item_windows"))

    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.word, s.upto - 1)))))
    pairs = met.withColumn("best", F.array_max(F.transform("counted", share))).withColumn("word_coverage", covered / F.col("item_words"))
    return pairs.filter((F.col("best.coverage") >= coverage) | (F.col("word_coverage") >= word_coverage)).select(
        "doc_id", "item_id", "best.n_windows", "best.item_windows", "best.coverage", "word_coverage", "largest.n_slots", (-F.col("largest.unchanged")).alias("n_changed")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that no benchmark item contaminates, unchanged."""
    # In a written table, so that Spark knows its size and broadcasts it if it is small.
    found = staged(leaks(docs, benchmark, coverage).select(F.col("doc_id").alias("_leaked")).distinct(), "leaked")
    return docs.join(found, F.col("doc_id").cast("long") == F.col("_leaked"), "left_anti")
