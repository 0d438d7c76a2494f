"""Tokens, n-grams, vocabularies and weights of texts.

Work on one text stays in its row: tokens, n-grams, term counts, weights and the norm are array
expressions, so the only shuffle is the one that counts terms over the corpus, and that one
carries partial sums. The vocabulary is bounded by ``max_features``, so it travels as a literal.
"""

from __future__ import annotations

import json
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, HashingTF, NGram, Normalizer, OneHotEncoder, RegexTokenizer, SQLTransformer, StringIndexer,
    VectorAssembler, VectorSizeHint,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.patterns import let
from riskloom.operators import grams
from riskloom.operators.grams import CharTerms, WordTerms
from riskloom.session import staged

WORD_2 = r"(?U)\b\w\w+\b"
WORD_1 = r"(?U)\b\w+\b"


def _accent_table() -> tuple[str, str]:
    """Latin letters that decompose into one base character, and combining marks to delete."""
    letters = [chr(c) for block in ((0xC0, 0x250), (0x1E00, 0x1F00)) for c in range(*block)]
    marked, bases = [], []
    for letter in letters:
        kept = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
        if len(kept) == 1 and kept[0] != letter:
            marked.append(letter)
            bases.append(kept[0])
    return "".join(marked) + "".join(map(chr, range(0x300, 0x370))), "".join(bases)


ACCENTED, PLAIN = _accent_table()


def strip_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def _runs(text: Column, pattern: str, ascii_pattern: str) -> Column:
    """Matches of a word pattern in a lower-case text. In ASCII texts a class of letters finds the same words, several times as fast."""
    found = F.regexp_extract_all(text, F.lit(ascii_pattern), F.lit(0))
    return F.when(F.octet_length(text) == F.length(text), found).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def words(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return _runs(F.lower(text), WORD_2, "[a-z0-9_]{2,}")


def plain_words(text: Column) -> Column:
    """Lower-case words of one or more characters, accents removed."""
    return _runs(strip_accents(F.lower(text)), WORD_1, "[a-z0-9_]+")


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """N-grams of ``low`` to ``high`` words, shorter ones first."""
    def grams(words: Column, n: int) -> Column:
        if n == 1:
            return words
        # Shifted copies of the words are joined pairwise: no lookup by place for each word of each n-gram.
        joined = F.slice(words, 1, F.size(words) - (n - 1))
        for k in range(1, n):
            joined = F.zip_with(joined, F.slice(words, k + 1, F.size(words) - (n - 1)), lambda gram, word: F.concat(gram, F.lit(" "), word))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(tokens, lambda words: F.concat(*[grams(words, n) for n in range(low, high + 1)]))


def char_ngrams(text: Column | str, low: int, high: int) -> Column | CharTerms:
    """Overlapping character n-grams of the lower-case text, runs of white space as one blank.

    A look-ahead group yields all n-grams of one length in a single pass over the text. The name of a column gives what
    ``term_statistics`` counts without a string for each n-gram.
    """
    if isinstance(text, str):
        return CharTerms(text, low, high)

    def grams(squeezed: Column, n: int) -> Column:
        return F.regexp_extract_all(squeezed, F.lit(r"(?s)(?![\uDC00-\uDFFF])(?=(.{%d}))" % n), F.lit(1))

    squeezed = F.regexp_replace(F.lower(text), r"(?U)\s\s+", " ")
    return let(squeezed, lambda t: F.concat(*[grams(t, n) for n in range(low, high + 1)]))


def boundary_ngrams(text: Column | str, low: int, high: int) -> Column | CharTerms:
    """Character n-grams inside blank-padded words; a word shorter than n gives itself once. A name is taken as in ``char_ngrams``."""
    if isinstance(text, str):
        return CharTerms(text, low, high, inside=True)
    padded = F.transform(
        F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\S+"), F.lit(0)), lambda word: F.concat(F.lit(" "), word, F.lit(" "))
    )

    def grams(word: Column) -> Column:
        size = F.length(word)
        whole = F.when(size <= low, F.array(word)).otherwise(F.array().cast("array<string>"))
        sliced = [
            F.when(
                (size > n) | ((size == n) & F.lit(n > low)),
                F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(word, i, F.lit(n))),
            ).otherwise(F.array().cast("array<string>"))
            for n in range(low, high + 1)
        ]
        return F.concat(whole, *sliced)

    return F.flatten(F.transform(padded, grams))


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of a term array: the terms are sorted and cut into runs."""
    def runs(ordered: Column) -> Column:
        new = lambda i: (i == 0) | (F.get(ordered, i) != F.coalesce(F.get(ordered, i - 1), F.lit("")))
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), new)
        return let(starts, lambda found: F.transform(found, lambda start, k: entry(ordered, found, start, k)))

    def entry(ordered: Column, found: Column, start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(found, k + 1), F.size(ordered))
        return F.struct(F.get(ordered, start).alias("term"), (end - start).cast("bigint").alias("tf"))

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return let(F.sort_array(terms), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(empty))


# Terms of texts that a task counts at a time, in a few arrays of eight bytes each.
COUNTED_TERMS = 1 << 22


def term_statistics(df: DataFrame, terms: str | CharTerms) -> DataFrame:
    """(term, total_count, doc_count) over the corpus. Each task counts the terms of some texts at a time, so a term is a row once for these.

    ``terms`` names a column of terms, or tells the character n-grams of a text.
    """
    if isinstance(terms, CharTerms):
        return _statistics(grams.char_statistics(df, terms))
    most = COUNTED_TERMS

    def counted(column: pa.ListArray) -> pa.RecordBatch:
        encoded = column.flatten().dictionary_encode(null_encoding="encode")
        codes, size = encoded.indices.to_numpy().astype(np.int64), max(1, len(encoded.dictionary))
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        pairs = np.sort(np.repeat(np.arange(len(sizes)), sizes) * size + codes)
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        total, doc = (np.bincount(c, minlength=size)[: len(encoded.dictionary)] for c in (codes, pairs[new] % size))
        return pa.RecordBatch.from_arrays([encoded.dictionary, pa.array(total, pa.int64()), pa.array(doc, pa.int64())], ["term", "total", "doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(), dtype=np.int64)
            at = 0
            while at < len(column):  # one text at least
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
                yield counted(column.slice(at, upto - at))
                at = upto

    return _statistics(df.select(terms).mapInArrow(run, "term string, total long, doc long"))


def _occurrences(df: DataFrame, terms: str) -> DataFrame:
    """(term, total, doc), a text's terms once as they are and once each: 1 in total for each term of a text, 1 in doc for each different one."""
    both = F.array(
        F.struct(F.col(terms).alias("terms"), F.lit(1).alias("total"), F.lit(0).alias("doc")),
        F.struct(F.array_distinct(terms).alias("terms"), F.lit(0).alias("total"), F.lit(1).alias("doc")),
    )
    return df.select(F.inline(both)).select(F.explode("terms").alias("term"), "total", "doc")


def _statistics(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy("term").agg(F.sum("total").alias("total_count"), F.sum("doc").alias("doc_count"))


# A task sends at most so many bucket totals for each term asked for, however many terms it meets.
BUCKETS_PER_TERM = 64
FIRST_BUCKETS_PER_TERM = 4


def vocabulary(df: DataFrame, terms: str | WordTerms, max_features: int, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """The ``max_features`` most frequent terms, by total count and then by term. ``terms`` names a column of terms, or tells the n-grams of a text.

    Terms are counted by the bucket of their hash first. No term is more frequent than its bucket, so the exact counts of the terms in the
    heaviest buckets show how frequent a term must be, and only buckets that reach this can hold others: mostly none, and then the
    second pass was the last. The result is exact in any case.
    """
    buckets = 1 << max(10, (BUCKETS_PER_TERM * max_features - 1).bit_length())
    place = F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket")
    if isinstance(terms, WordTerms):
        heavy = grams.bucket_totals(df, terms, buckets)
    else:
        heavy = df.select(F.explode(terms).alias("term")).groupBy(place).agg(F.count(F.lit(1)).alias("n"))
    heavy = staged(heavy, "term-buckets")  # at most ``buckets`` rows
    most = df.agg(F.count(F.lit(1))).scalar() if max_df < 1.0 else None

    def exact(chosen: DataFrame) -> DataFrame:
        # The set of chosen buckets has at most ``buckets`` numbers, so it is sent to all tasks.
        if isinstance(terms, WordTerms):
            kept = grams.statistics(df, terms, buckets, np.array([row["bucket"] for row in chosen.select("bucket").collect()], np.int64))
        else:
            kept = _occurrences(df, terms).withColumn("bucket", place).join(F.broadcast(chosen.select("bucket")), "bucket", "left_semi")
        stats = _statistics(kept)
        if min_df > 1:
            stats = stats.filter(F.col("doc_count") >= min_df)
        if max_df < 1.0:
            stats = stats.filter(F.col("doc_count") <= F.lit(max_df) * most)
        return stats.orderBy(F.desc("total_count"), "term").limit(max_features)

    first = heavy.orderBy(F.desc("n"), "bucket").limit(max(1, int(FIRST_BUCKETS_PER_TERM * max_features)))
    found = staged(exact(first), "vocabulary")
    least = found.agg(F.count(F.lit(1)).alias("n"), F.min("total_count").alias("least")).first()
    needed = least["least"] if least["n"] == max_features else 1
    if heavy.filter(F.col("n") >= needed).count() <= first.count():
        return found.orderBy(F.desc("total_count"), "term")
    return exact(heavy.filter(F.col("n") >= needed))


class TfidfModel:
    """Vocabulary with its idf values, applied row by row."""

    def __init__(self, terms: list[str], idf: list[float], sublinear: bool):
        self.terms, self.idf, self.sublinear = terms, idf, sublinear

    def _counts(self, df: DataFrame, terms: str | WordTerms, name: str, sublinear: bool = False) -> DataFrame:
        """Add how often each term is in a text, as one sparse vector."""
        if isinstance(terms, WordTerms):
            return df.withColumn(name, grams.matched(df.sparkSession, terms, self.terms, sublinear))
        return CountVectorizerModel.from_vocabulary(self.terms, terms, name).transform(df)

    def _parts(self, df: DataFrame, terms: str | WordTerms) -> DataFrame:
        sparse = self._counts(df, terms, "_tf").withColumn("_tf", F.unwrap_udt("_tf"))
        idf = F.from_json(F.lit(json.dumps(self.idf)), "array<double>")
        scaled = lambda tf: 1 + F.log(tf) if self.sublinear else tf
        raw = F.transform(F.col("_tf.values"), lambda tf, k: scaled(tf) * F.get(idf, F.get(F.col("_tf.indices"), k)))
        weighted = sparse.withColumn("_w", raw)
        # The norm is bound before the weights are divided: in the lambda it would be summed again for each of them.
        norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda total, w: total + w * w))
        return weighted.withColumn("_w", let(norm, lambda bound: F.transform("_w", lambda w: w / bound)))

    def long(self, df: DataFrame, terms: str | WordTerms, key: str) -> DataFrame:
        """(key, term, tf, weight), one row per term of the vocabulary that a text holds."""
        names = F.from_json(F.lit(json.dumps(self.terms)), "array<string>")
        parts = self._parts(df, terms)
        entry = F.explode(F.arrays_zip(F.col("_tf.indices").alias("i"), F.col("_tf.values").alias("tf"), F.col("_w").alias("w")))
        return parts.select(key, entry.alias("e")).select(
            key, F.get(names, F.col("e.i")).alias("term"), F.col("e.tf").cast("bigint").alias("tf"), F.col("e.w").alias("weight")
        )

    def stages(self, terms: str, name: str) -> list:
        """The weights without the logarithm of ``sublinear``, as stages that a pipeline can hold and save."""
        counts, weighted = f"{name}_counts", f"{name}_weighted"
        return [
            CountVectorizerModel.from_vocabulary(self.terms, terms, counts),
            ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol=counts, outputCol=weighted),
            Normalizer(p=2.0, inputCol=weighted, outputCol=name),
        ]

    def vectors(self, df: DataFrame, terms: str | WordTerms, name: str) -> DataFrame:
        """Add the weights as one sparse vector."""
        if isinstance(terms, WordTerms):
            counts = f"{name}_counts"
            df = self._counts(df, terms, counts, self.sublinear)
            for stage in self.stages("", name)[1:]:
                df = stage.transform(df)
            return df.drop(counts, f"{name}_weighted")
        if not self.sublinear:
            for stage in self.stages(terms, name):
                df = stage.transform(df)
            return df.drop(f"{name}_counts", f"{name}_weighted")
        parts = self._parts(df, terms)
        body = F.to_json(
            F.struct(
                F.struct(
                    F.lit(0).alias("type"), F.lit(len(self.terms)).alias("size"),
                    F.col("_tf.indices").alias("indices"), F.col("_w").alias("values"),
                ).alias("v")
            )
        )
        vector = F.from_json(body, T.StructType([T.StructField("v", VectorUDT())]))["v"]
        return VectorSizeHint(inputCol=name, size=len(self.terms)).transform(parts.withColumn(name, vector).drop("_tf", "_w"))


def fit_tfidf(df: DataFrame, terms: str | WordTerms, max_features: int, min_df: int = 1, max_df: float = 1.0, sublinear: bool = False) -> TfidfModel:
    """Choose the vocabulary and its ``ln((1+n)/(1+df)) + 1``. Brings back ``max_features`` rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    chosen = vocabulary(df, terms, max_features, min_df, max_df)
    rows = chosen.select("term", (F.log((1 + n) / (1 + F.col("doc_count"))) + 1).alias("idf")).collect()
    ordered = sorted(rows, key=lambda row: row["term"])
    return TfidfModel([row["term"] for row in ordered], [row["idf"] for row in ordered], sublinear)


# --- stages for a persistent pipeline --------------------------------------------------------
def hashing_stages(text: str, output: str, buckets: int = 2**18, ngrams: tuple[int, int] = (1, 2)) -> list:
    """Words and word n-grams hashed into buckets, no sign flip, unit length."""
    tokens = f"{output}_tokens"
    stages = [RegexTokenizer(inputCol=text, outputCol=tokens, pattern=WORD_2, gaps=False, toLowercase=True)]
    blocks = [tokens] if ngrams[0] == 1 else []
    for n in range(max(2, ngrams[0]), ngrams[1] + 1):
        blocks.append(f"{output}_n{n}")
        stages.append(NGram(n=n, inputCol=tokens, outputCol=blocks[-1]))
    stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(blocks)}) AS {output}_terms FROM __THIS__"))
    stages.append(HashingTF(numFeatures=buckets, inputCol=f"{output}_terms", outputCol=f"{output}_tf"))
    stages.append(Normalizer(p=2.0, inputCol=f"{output}_tf", outputCol=output))
    return stages


def category_stages(columns: list[str], suffix: str = "_onehot") -> list:
    """One-hot of category columns; a category not seen in training becomes all zeros."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=columns, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=[c + suffix for c in columns], dropLast=True),
    ]


class PopulationScaler(Estimator):
    """Divides each slot by its population standard deviation; constant slots stay. The fitted stage can be saved."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.input, self.output = inputCol, outputCol

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        found = dataset.agg(Summarizer.metrics("variance", "count").summary(F.col(self.input)).alias("s")).select("s.variance", "s.count").first()
        n = found["count"]
        deviation = [math.sqrt(max(v, 0.0) * (n - 1) / n) if n else 0.0 for v in found["variance"]]
        return ElementwiseProduct(scalingVec=Vectors.dense([1 / d if d else 1.0 for d in deviation]), inputCol=self.input, outputCol=self.output)


def numeric_stages(columns: list[str], output: str) -> list:
    """Numbers divided by their population standard deviation, not centred."""
    return [VectorAssembler(inputCols=columns, outputCol=f"{output}_raw"), PopulationScaler(f"{output}_raw", output)]


def scaled_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same scaling as columns, with the population standard deviation."""
    spread = df.agg(*[F.nullif(F.stddev_pop(c), F.lit(0.0)).alias(c) for c in columns])
    return df.withColumns({f"{c}_scaled": F.col(c) / F.coalesce(spread.select(c).scalar(), F.lit(1.0)) for c in columns})


def feature_pipeline(
    buckets: int = 2**18, categories: tuple[str, ...] = ("language", "source"), numbers: tuple[str, ...] = ("code_length", "line_count"), blocks: tuple[str, ...] = ()
) -> Pipeline:
    """Hashed text, ``blocks`` of columns counted in the code (``stages.BLOCKS``), categories and numbers assembled into ``features``.

    The assembler names every slot in the column's metadata. With 2^18 hash buckets that is tens
    of megabytes in each plan, and the slots of a hash mean nothing, so the names are left behind.
    """
    from riskloom.operators import stages

    counted = stages.block_columns(blocks)
    return Pipeline(
        stages=[
            *hashing_stages("raw_code", "hashed", buckets),
            *([stages.CodeColumns("raw_code", list(blocks))] if blocks else []),
            *category_stages(list(categories)),
            *numeric_stages(list(numbers), "numbers"),
            VectorAssembler(inputCols=["hashed", *counted, *[c + "_onehot" for c in categories], "numbers"], outputCol="assembled"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(['assembled', *counted])}), coalesce(assembled, assembled) AS features FROM __THIS__"),
        ]
    )


def term_pipeline(
    max_features: int = 3000, ngrams: tuple[int, int] = (1, 2), min_df: int = 1, max_df: float = 1.0, sublinear: bool = False, plain: bool = False,
    blocks: tuple[str, ...] = ("structure", "language"), text: str = "raw_code",
) -> Pipeline:
    """Weights of the most frequent n-grams and ``blocks`` of columns counted in the code, assembled into ``features``. The fitted pipeline can be saved."""
    from riskloom.operators import stages

    return Pipeline(stages=[
        stages.TermWeighting(text, "_tfidf", max_features, min_df, max_df, sublinear, ngrams, plain), *_assembling(blocks, text)])


def _assembling(blocks: tuple[str, ...], text: str) -> list:
    from riskloom.operators import stages

    counted = stages.block_columns(blocks)
    return [
        stages.CodeColumns(text, list(blocks)), VectorAssembler(inputCols=["_tfidf", *counted], outputCol="features"),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(['_tfidf', *counted])}) FROM __THIS__"),
    ]


class SyntacticFeatures:
    """N-gram weights and columns counted in the code as one ``features`` vector, with the names of its slots. ``model`` can be saved."""

    def __init__(self, model: PipelineModel):
        from riskloom.operators import stages

        self.model = model
        self.weights = next(s for s in model.stages if isinstance(s, stages.TermWeights))
        self.blocks = next(s for s in model.stages if isinstance(s, stages.CodeColumns)).getOrDefault("blocks")

    @classmethod
    def fit(cls, df: DataFrame, *args, **options) -> SyntacticFeatures:
        """Arguments as ``term_pipeline`` takes them."""
        return cls(term_pipeline(*args, **options).fit(df))

    @property
    def names(self) -> list[str]:
        from riskloom.operators import stages

        return [*(f"tfidf__{term}" for term in self.weights.getOrDefault("terms")), *stages.block_columns(self.blocks)]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)
