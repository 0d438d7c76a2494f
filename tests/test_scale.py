"""Steps whose cost must not grow faster than the input, by their plans and files."""

import os

from pyspark.sql import functions as F

from checks import models, sources
from riskloom.operators import vectorise


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_norm_is_summed_once_for_each_text(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "doc_id long, g array<string>")
    model = vectorise.TfidfModel(["a", "b"], [1.0, 2.0], False)
    rows = model.long(df, "g", "doc_id")
    assert "/ sqrt(" not in optimized(rows)  # a sum within the lambda that divides
    assert {r.term: round(r.weight, 6) for r in rows.collect()} == {"a": round(0.5**0.5, 6), "b": round(0.5**0.5, 6)}


def test_word_ngrams_of_short_texts(spark):
    rows = spark.createDataFrame([(0, []), (1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c", "d"]), (4, None)], "i int, w array<string>")
    assert "concat_ws" not in optimized(rows.select(vectorise.word_ngrams(F.col("w"), 1, 3)))
    found = {r.i: r.g for r in rows.select("i", vectorise.word_ngrams(F.col("w"), 1, 3).alias("g")).collect()}
    assert found == {0: [], 1: ["a"], 2: ["a", "b", "a b"], 3: ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"], 4: None}


def test_words_of_ascii_texts_are_those_of_all_texts(spark):
    texts = ["", "a", "ab_1 x yz", "A-b'cd\tE9\x0bfg\x1c", "École à la_Ä ok", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select(vectorise.words(F.col("t")).alias("a"), F.regexp_extract_all(F.lower("t"), F.lit(vectorise.WORD_2), F.lit(0)).alias("b"))
    assert all(r.a == r.b for r in both.collect())


def test_pairs_of_all_sources_share_files(spark, sf):
    path = sources._pair_arrays(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    blocks = docs.select(F.floor(F.col("doc_id") / 50)).distinct().count()
    assert len([f for f in os.listdir(path) if f.endswith(".txt")]) == blocks


def test_reasons_are_compared_within_rows(spark, sf):
    """Rows for slots were broadcast, as Spark takes them for as small as their table."""
    df = models.CASES["evl_12_model_reasons"][0](spark, sf)
    assert "generate" not in optimized(df)
    assert df.first().other_reasons == 0
