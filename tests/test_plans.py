"""Properties of the physical plans, and of the helpers that shape them."""

import pytest
from pyspark.sql import functions as F

from checks import views
from riskloom.functions import normalise as n
from riskloom.operators import dedup, evaluate, features, rules, sampling
from riskloom.plans.prepare import clean_records
from riskloom.session import settled, shared_dir


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_cleaning_is_computed_once(spark, sf):
    labels = views.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"))
    cleaned = clean_records(views.documents(spark, sf).join(labels, "doc_id"))
    assert plan(cleaned, "optimizedPlan").count("\\b(vulnerable|safe)") == 1


def test_unused_text_is_not_read(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tree = plan(docs.select("source", "lang").groupBy("source").count())
    assert "text" not in tree.split("ReadSchema")[1]


@pytest.mark.parametrize("build", [
    lambda c: features.family_counts(features.security_signals(c)), lambda c: rules.code_findings(c), lambda c: rules.match_rules(c),
    lambda c: sampling.group_split(c.withColumn("g", n.effective_group(F.col("group_id"), n.content_key(F.col("raw_code")))), "g", 0.25),
    lambda c: sampling.folds(c, "doc_id"), lambda c: c.filter(n.sample_ok(F.col("raw_code"))),
])
def test_row_work_needs_no_shuffle(spark, sf, build):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("raw_code"), F.lit("").alias("group_id"))
    tree = plan(build(docs))
    assert "Exchange" not in tree and "Python" not in tree


def test_no_pairs_of_rows(spark, sf, small):
    for df in (sampling.first_rows(small, ["source"], "doc_id", 5), sampling.first_rows(small, [], "doc_id", 5), evaluate.roc_auc(small),
               evaluate.threshold_sweep(small), sampling.stratified_split(small, "doc_id", 0.2), dedup.restrict_to(small, small)):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_texts_do_not_move_for_a_cap(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("text", "raw_code")
    tree = plan(sampling.first_rows(docs, ["source"], "doc_id", 5))
    assert "hashpartitioning" not in tree and "BroadcastHashJoin" in tree


def test_settled_keeps_rows_and_columns(spark):
    df = settled(spark.range(5), {"x": F.col("id") * 2})
    assert df.columns == ["id", "x"] and df.filter("x > 4").count() == 2


def test_shared_folder_follows_the_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    paths = [shared_dir(spark, "x"), shared_dir(spark, "x")]
    assert len(set(paths)) == 2
    assert all(path.startswith(named or "/tmp/run-") for path in paths)
