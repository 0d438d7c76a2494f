"""Pipeline stages of this library that can be saved beside Spark's own: word n-grams, their weights, and columns counted in code."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.operators import features, vectorise

STRUCTURE = ("ast_node_count", "ast_max_depth", "ast_pointer_ops", "ast_function_calls", "ast_loops", "ast_if_statements")
SECURITY = (*(f"sec_{name}" for name in fixed.FAMILIES), "sec_safe_patterns", "sec_safety_ratio")
LANGUAGES = (*(f"lang_{name}" for name in fixed.ONE_HOT_LANGUAGES), "lang_other")
SIGNALS = (
    *(f"dangerous_{p[0]}" for p in fixed.DANGEROUS), *(f"sanitizer_{p[0]}" for p in fixed.SANITIZERS), "dangerous_total", "sanitizer_total", "net_risk",
    "lines_of_code", "token_count", "import_count",
)
# Blocks of columns that code gives: their names, and the operator that adds them.
BLOCKS = {
    "structure": (STRUCTURE, features.structure),
    "security": (SECURITY, lambda df, code: features.safe_signals(features.family_counts(df, code), code)),
    "signals": (SIGNALS, features.security_signals),
    "language": (LANGUAGES, features.language_one_hot),
}


def block_columns(blocks: tuple[str, ...]) -> list[str]:
    """Names of the columns of some blocks, in their order."""
    return [name for block in blocks for name in BLOCKS[block][0]]


class _Shared(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose settings are all parameters, so that its metadata holds the whole of it."""

    def __init__(self, **params):
        super().__init__()
        self._set(**{name: value for name, value in params.items() if value is not None})


class CodeColumns(_Shared):
    """Adds the columns of ``blocks``, counted in the code of ``inputCol``."""

    blocks = Param(Params._dummy(), "blocks", "names of the blocks of columns", TypeConverters.toListString)

    def __init__(self, inputCol: str | None = None, blocks: list[str] | None = None):
        super().__init__(inputCol=inputCol, blocks=blocks)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for block in self.getOrDefault("blocks"):
            dataset = BLOCKS[block][1](dataset, self.getInputCol())
        return dataset


class WordGrams(_Shared):
    """Words of a text and their n-grams; ``plain`` takes words of one character too and removes accents."""

    low = Param(Params._dummy(), "low", "least number of words", TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "largest number of words", TypeConverters.toInt)
    plain = Param(Params._dummy(), "plain", "without accents", TypeConverters.toBoolean)

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, low: int | None = None, high: int | None = None, plain: bool | None = None):
        super().__init__(inputCol=inputCol, outputCol=outputCol, low=low, high=high, plain=plain)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = (vectorise.plain_words if self.getOrDefault("plain") else vectorise.words)(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), vectorise.word_ngrams(found, self.getOrDefault("low"), self.getOrDefault("high")))


class TermWeights(_Shared, Model):
    """Weights of a fixed vocabulary as one vector of unit length; ``sublinear`` takes one plus the logarithm of a count.

    With ``low`` and ``high`` the input is a text, whose word n-grams of these lengths are the terms; else it is a column of terms.
    """

    terms = Param(Params._dummy(), "terms", "the vocabulary", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "a factor for each term", TypeConverters.toListFloat)
    sublinear = Param(Params._dummy(), "sublinear", "whether counts grow by their logarithm", TypeConverters.toBoolean)
    low = Param(Params._dummy(), "low", "least number of words", TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "largest number of words", TypeConverters.toInt)
    plain = Param(Params._dummy(), "plain", "without accents", TypeConverters.toBoolean)

    def __init__(
        self, inputCol: str | None = None, outputCol: str | None = None, terms: list[str] | None = None, idf: list[float] | None = None, sublinear: bool | None = None,
        low: int | None = None, high: int | None = None, plain: bool | None = None,
    ):
        super().__init__(inputCol=inputCol, outputCol=outputCol, terms=terms, idf=idf, sublinear=sublinear, low=low, high=high, plain=plain)

    @property
    def model(self) -> vectorise.TfidfModel:
        return vectorise.TfidfModel(self.getOrDefault("terms"), self.getOrDefault("idf"), self.getOrDefault("sublinear"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self.getInputCol()
        if self.isSet("low"):
            source = vectorise.WordTerms(source, self.getOrDefault("low"), self.getOrDefault("high"), self.getOrDefault("plain"))
        return self.model.vectors(dataset, source, self.getOutputCol())


class TermWeighting(Estimator, HasInputCol, HasOutputCol):
    """Chooses the most frequent terms of the corpus and their weights; with ``ngrams``, among the word n-grams of these lengths of a text."""

    def __init__(
        self, inputCol: str, outputCol: str, max_features: int, min_df: int = 1, max_df: float = 1.0, sublinear: bool = False,
        ngrams: tuple[int, int] | None = None, plain: bool = False,
    ):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.limits, self.ngrams, self.plain = (max_features, min_df, max_df, sublinear), ngrams, plain

    def _fit(self, dataset: DataFrame) -> TermWeights:
        source = self.getInputCol()
        terms, words = (vectorise.WordTerms(source, *self.ngrams, self.plain), (*self.ngrams, self.plain)) if self.ngrams else (source, ())
        found = vectorise.fit_tfidf(dataset.select(source), terms, *self.limits)
        return TermWeights(source, self.getOutputCol(), found.terms, found.idf, found.sublinear, *words)
