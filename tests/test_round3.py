"""What the findings of round 3 asked for: no step is done twice, and fits read few parts."""

import json

from pyspark.sql import functions as F

from checks import text
from riskloom.operators import modelling, vectorise
from riskloom.plans import prepare


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_profile_reads_the_written_records(spark, tmp_path):
    lines = [json.dumps({"func": f"int f{i}() {{ return {i}; }} // padding of the text", "target": i % 2}) for i in range(20)]
    (tmp_path / "lines.jsonl").write_text("\n".join([*lines, "{broken"]))
    corpus = prepare.clean_corpus(spark, {"codexglue": str(tmp_path)})
    row = corpus.sources.first()
    assert (row["input_records"], row["usable_records"], row["errors"]) == (20, 20, 1)
    assert "parquet" in plan(corpus.sources) and "regexp" not in plan(corpus.sources)
    assert corpus.table.count() == 20


def test_filter_does_not_make_the_ngrams_again(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four"), (2, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = text.txt_03(spark, str(tmp_path))
    assert not [line for line in plan(found).splitlines() if "Filter" in line and "zip_with" in line]
    assert [(r["doc_id"], r["grams"], r["lowest"], r["highest"]) for r in found.collect()] == [(1, 9, "four", "two three four")]


def test_fits_read_few_parts_of_many_pieces(spark):
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes",)}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        rows = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(300)
        table = modelling.fit_table(rows, "parts")
        pieces = spark.read.parquet(table.inputFiles()[0].rsplit("/", 1)[0]).rdd.getNumPartitions()
        parts = table.rdd.getNumPartitions()
        assert pieces > 300 and parts == max(4 * spark.sparkContext.defaultParallelism, -(-pieces // 8))
        assert table.distinct().count() == 40000
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_terms_are_counted_before_they_become_rows(spark, monkeypatch):
    monkeypatch.setattr(vectorise, "COUNTED_TERMS", 6)
    rows = [(["a", "b", "a", None],), ([],), (None,), (["b"] * 9 + ["ü€"],), (["a"],), ([None, None, "😀"],)]
    df = spark.createDataFrame(rows, "g array<string>").coalesce(1)
    found = vectorise.term_statistics(df, "g")
    assert "Generate" not in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == {("a", 3, 2), ("b", 10, 2), ("ü€", 1, 1), ("😀", 1, 1), (None, 3, 2)}
    assert vectorise.term_statistics(df.filter("false"), "g").count() == 0
