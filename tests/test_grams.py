"""Words and n-grams in Arrow batches: those of the column expressions, without a string for each."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import text
from riskloom import fixed_values as fixed
from riskloom.functions.patterns import count
from riskloom.operators import features, grams, stages, vectorise

ODD = [
    "", None, "a", "ab", "é", "ée", "x é y", "aé bé", "École à la_Ä OK ok ok", "İstanbul ISTANBUL", "éa ́ á", "日本 語 語語", "😀 a😀b \U0001d7d8\U0001d7d9 \U0001d7d8",
    "one two\tthree\none two three", "ab" * 5000, "tail ab", "ab", " ab‍cd ef", "١٢ ３４ ⅷ ª² x_ _ __", "A-b'cd\tE9\x0bfg\x1c", "one two three one two three",
]


def rows(spark):
    return spark.createDataFrame([(t,) for t in ODD * 3], "t string").coalesce(2)


@pytest.mark.parametrize("size", [1, 1 << 23])
@pytest.mark.parametrize("plain", [False, True])
def test_vocabulary_of_texts_is_that_of_their_terms(spark, monkeypatch, size, plain):
    monkeypatch.setattr(grams, "SLICE_BYTES", size)
    monkeypatch.setattr(vectorise, "BUCKETS_PER_TERM", 1)
    df = rows(spark)
    words = (vectorise.plain_words if plain else vectorise.words)(F.col("t"))
    found = [r.g or [] for r in df.select(vectorise.word_ngrams(words, 1, 3).alias("g")).collect()]
    totals, spread = Counter(g for d in found for g in d), Counter(g for d in found for g in set(d))
    for most, low, high in ((10, 1, 1.0), (1000, 1, 1.0), (20, 4, 0.1)):
        fits = [g for g in totals if spread[g] >= low and spread[g] <= high * len(found)]
        expected = sorted(fits, key=lambda g: (-totals[g], g.encode()))[:most]
        got = vectorise.vocabulary(df, vectorise.WordTerms("t", 1, 3, plain), most, low, high).collect()
        assert [(r.term, r.total_count, r.doc_count) for r in got] == [(g, totals[g], spread[g]) for g in expected]
    for none in (df.limit(0), df.filter("t is null"), df.filter("t = ''")):
        assert vectorise.vocabulary(none, vectorise.WordTerms("t", 1, 2), 5).collect() == []


def test_vocabulary_makes_no_string_for_each_ngram(spark, sf, monkeypatch):
    seen = []
    kept = vectorise.staged
    monkeypatch.setattr(vectorise, "staged", lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df, name))
    text.txt_06(spark, sf)
    assert len(seen) == 2 and not [p for p in seen if "Generate" in p or "zip_with" in p or "regexp_extract" in p]


@pytest.mark.parametrize("size", [1, 1 << 23])
@pytest.mark.parametrize("sublinear", [False, True])
def test_vectors_of_texts_are_those_of_their_terms(spark, monkeypatch, size, sublinear):
    monkeypatch.setattr(grams, "SLICE_BYTES", size)
    df = rows(spark).withColumn("t", F.coalesce("t", F.lit(""))).withColumn("g", vectorise.word_ngrams(vectorise.words(F.col("t")), 1, 3))
    terms = sorted(["ab", "one", "one two three", "two three", "three one", "ok ok", "école", "語語", "absent", "absent one", "one absent"])
    model = vectorise.TfidfModel(terms, [1 + i / 7 for i in range(len(terms))], sublinear)
    words = vectorise.WordTerms("t", 1, 3)
    both = model.vectors(model.vectors(df, words, "a"), "g", "b").collect()
    assert all(r.a.size == r.b.size == len(terms) and list(r.a.indices) == list(r.b.indices) for r in both) and any(len(r.a.indices) > 3 for r in both)
    assert all(abs(x - y) < 1e-12 for r in both for x, y in zip(r.a.values, r.b.values))
    keyed = df.withColumn("k", F.monotonically_increasing_id()).localCheckpoint()
    assert sorted(map(tuple, model.long(keyed, words, "k").collect())) == sorted(map(tuple, model.long(keyed, "g", "k").collect()))


def test_weights_of_texts_can_be_saved(spark, tmp_path):
    df = spark.createDataFrame([("one two",), ("two x",), (None,)], "t string")
    model = stages.TermWeighting("t", "v", 3, ngrams=(1, 2), plain=True).fit(df)
    model.write().save(str(tmp_path / "m"))
    read = stages.TermWeights.load(str(tmp_path / "m"))
    assert read.getOrDefault("terms") == ["one", "one two", "two"]
    found = read.transform(df)
    assert "regexp_extract" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [list(r.v.indices) for r in found.collect()] == [[0, 1, 2], [2], []]


def test_structure_counts_are_those_of_the_patterns(spark):
    texts = [*ODD, "f(", "f (x(y", "((", "é\u3000(", "a\x1c(", "a\x85 (b)(", "_(1(", ") (", "a\n\t(", "x\x1fy\u2028z", "😀(a😀(\u0301(", "("]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    code = F.col("t")
    pairs = df.select(features.call_count(code).alias("a"), count(code, fixed.CALL_PATTERN).alias("b"), features.nonblank_runs(code).alias("c"), count(code, rf"[^{fixed.SPACE}]+").alias("d"))
    assert all((r.a, r.c) == (r.b, r.d) for r in pairs.collect())


@pytest.mark.parametrize("size", [1, 60, 1 << 22])
@pytest.mark.parametrize("wide", [False, True])
def test_character_ngrams_are_those_of_the_columns(spark, monkeypatch, size, wide):
    monkeypatch.setattr(grams, "CHAR_BYTES", size)
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 3000))) * 2 if wide else ""
    odd = [*ODD, "a  b\n\nc \n d", "  x  y　 z ", "a", "I", "\n", "  ", "q\x85\x85r s", "\U0001d7d8", f"{many} {many[5:50]}"]
    df = spark.createDataFrame([(t,) for t in odd * 2], "t string").coalesce(2)
    for make, spans in ((vectorise.char_ngrams, [(3, 6), (1, 2)]), (vectorise.boundary_ngrams, [(3, 5), (2, 2), (4, 6), (5, 5)])):
        for low, high in spans:
            found = [r.g or [] for r in df.select(make(F.col("t"), low, high).alias("g")).collect()]
            totals, spread = Counter(g for d in found for g in d), Counter(g for d in found for g in set(d))
            got = vectorise.term_statistics(df, make("t", low, high)).collect()
            assert {r.term: (r.total_count, r.doc_count) for r in got} == {g: (totals[g], spread[g]) for g in totals} and len(got) == len(totals)
            assert vectorise.term_statistics(df.limit(0), make("t", low, high)).collect() == []


def test_character_ngrams_make_no_string_for_each(spark, sf):
    plan = text.txt_04(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert not [p for p in ("regexp_extract", "substring", "flatten", "Generate") if p in plan]
