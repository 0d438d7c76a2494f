import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import normalise as n
from riskloom.operators import modelling
from riskloom.operators.weighting import balanced_weights
from riskloom.plans.scan import scan
from riskloom.schemas import ARRIVING_FILE
from riskloom.session import shared_dir
from riskloom.streaming import scan as stream


def files_of(spark, rows, schema="filename string, code string"):
    path = shared_dir(spark, "arriving")
    spark.createDataFrame(rows, schema).repartition(4, "filename").write.json(path)
    return path


def test_model_scores_a_stream_as_it_scores_a_batch(spark):
    rows = [(f"f{i}", f"int item number {i} " + ("strcpy(a, b);" if i % 3 == 0 else "return a;")) for i in range(60)]
    code = F.col("raw_code")
    batch = spark.createDataFrame(rows, ARRIVING_FILE).withColumnRenamed("code", "raw_code")
    labelled = batch.withColumns({
        "is_vulnerable": F.contains(code, F.lit("strcpy")).cast("int"), "language": n.detect_web_language(code), "source": F.lit("manual"),
        "code_length": n.char_length(code), "line_count": n.nonblank_lines(code)})
    model = modelling.fit(modelling.model_pipeline(modelling.logistic(maxIter=5), 2**8), balanced_weights(labelled))
    details = stream.scan_stream(stream.arriving(spark, files_of(spark, rows), files_per_trigger=1), model)
    wanted = ["filename", "is_vulnerable", "risk_probability", "risk_level", "cwe_ids"]
    out = shared_dir(spark, "details")
    stream.write_details(details.select(*wanted), out, shared_dir(spark, "offsets"), available_now=True).awaitTermination()
    streamed = spark.read.parquet(out).orderBy("filename").collect()
    assert streamed == scan(batch, model).select(*wanted).orderBy("filename").collect() and len(streamed) == 60


def test_repeats_are_dropped_across_batches(spark):
    rows = [(f"f{i}", "hot content" if i % 3 == 0 else f"content {i % 20}") for i in range(200)]
    fresh = stream.drop_seen(stream.arriving(spark, files_of(spark, rows), files_per_trigger=1))
    out = shared_dir(spark, "fresh")
    stream.write_details(fresh, out, shared_dir(spark, "offsets"), available_now=True).awaitTermination()
    assert sorted(r.code for r in spark.read.parquet(out).collect()) == sorted({code for _, code in rows})


def test_repeats_with_an_arrival_time(spark):
    schema = T.StructType([*ARRIVING_FILE.fields, T.StructField("at", T.TimestampType())])
    rows = [(f"f{i}", f"content {i % 7}", "2024-01-01 00:00:00") for i in range(40)]
    path = files_of(spark, rows, "filename string, code string, at string")
    fresh = stream.drop_seen(stream.arriving(spark, path, schema), arrival="at")
    out = shared_dir(spark, "fresh")
    stream.write_details(fresh, out, shared_dir(spark, "offsets"), available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 7


def test_readers_never_see_half_a_summary(spark):
    """A reader that polls while batches replace each other finds growing, complete summaries."""
    rows = [(f"f{i}", f"int item {i} " + ("strcpy(a, b);" if i % 3 == 0 else "return a;"), i / 80) for i in range(80)]
    schema = T.StructType([*ARRIVING_FILE.fields, T.StructField("probability", T.DoubleType())])
    path = files_of(spark, rows, "filename string, code string, probability double")
    summary = stream.running_summary(stream.scan_stream(stream.arriving(spark, path, schema, files_per_trigger=1)))
    out, seen = shared_dir(spark, "summary"), []
    with pytest.raises(ValueError):
        stream.read_summary(spark, out)
    query = stream.write_summary(summary, out, shared_dir(spark, "offsets"), available_now=True)
    while query.isActive:
        try:
            seen.append(sum(r.files for r in stream.read_summary(spark, out, summary.schema).collect()))
        except ValueError:
            assert not seen
    query.awaitTermination()
    seen.append(sum(r.files for r in stream.read_summary(spark, out).collect()))
    assert seen == sorted(seen) and seen[0] > 0 and seen[-1] == 80


def test_a_batch_that_fails_midway_leaves_the_last_summary(spark):
    out = shared_dir(spark, "summary")
    for number in range(6):
        spark.range(number + 1).write.mode("overwrite").parquet(f"{out}/data/{number:019d}")
        if number < 5:
            spark.createDataFrame([(number,)], "batch long").write.parquet(f"{out}/manifest/{number:019d}")
    assert stream.read_summary(spark, out).count() == 5
