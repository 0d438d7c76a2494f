import pytest
from pyspark.sql import functions as F

from riskloom.functions import normalise as n
from riskloom.operators import dedup, sampling, weighting
from riskloom.plans.train import split_corpus


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows of which half belong to one source and a third have one content."""
    i = F.col("id")
    return spark.range(3000).select(
        i.alias("doc_id"), F.when(i % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), i % 7)).alias("source"),
        F.when(i % 3 == 0, F.lit("same text " * 5)).otherwise(F.concat(F.lit("text number "), i % 1700)).alias("raw_code"),
        (i % 11 == 0).cast("int").alias("is_vulnerable"), F.lit(0).alias("source_rank"), F.lit("p").alias("path"),
    ).withColumns({"code_hash": F.sha2("raw_code", 256), "row_pos": F.col("doc_id"), "group_id": F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("g"), F.col("doc_id") % 40)).otherwise(F.lit("")),
                   "language": F.lit("c")})


def test_first_rows_matches_brute_force(skewed):
    for keys, limit in ((["source"], 100), (["source", "is_vulnerable"], 17), ([], 250)):
        got = {r.doc_id for r in sampling.first_rows(skewed, keys, "doc_id", limit).select("doc_id").collect()}
        rows = sorted((tuple(r[k] for k in keys), r.doc_id) for r in skewed.select("doc_id", *keys).collect())
        expected, seen = set(), {}
        for key, doc in rows:
            seen[key] = seen.get(key, 0) + 1
            if seen[key] <= limit:
                expected.add(doc)
        assert got == expected


def test_first_rows_of_one_giant_file_among_small_ones(spark):
    small = spark.range(5000).select(F.format_string("f%05d", "id").alias("path"), F.lit(0).cast("decimal(38,0)").alias("row_pos"))
    giant = spark.range(20_000).select(F.lit("f02500x").alias("path"), F.col("id").cast("decimal(38,0)").alias("row_pos"))
    both = small.unionByName(giant).withColumn("k", F.lit("all"))
    kept = sampling.first_rows(both, ["k"], ["path", "row_pos"], 12_345)
    counts = {r.giant: r.n for r in kept.groupBy((F.col("path") == "f02500x").alias("giant")).agg(F.count("*").alias("n")).collect()}
    assert counts == {True: 12_345 - 2501, False: 2501}
    assert kept.filter("path = 'f02500x'").agg(F.max("row_pos")).first()[0] == 12_345 - 2501 - 1


def test_cap_keeps_whole_raw_records(skewed):
    pairs = skewed.withColumn("record", F.floor(F.col("doc_id") / 2))
    kept = sampling.first_rows(pairs.filter("source = 'hot' or source <> 'hot'"), [], "record", 101)
    assert kept.count() == 102


def test_stratified_shares(skewed):
    marked = sampling.stratified_split(skewed, "doc_id", 0.25)
    for row in marked.groupBy("is_vulnerable").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert row.t == round(row.n * 0.25)
    three = sampling.three_way_split(skewed, "doc_id")
    assert three.count() == 3000 and {r.split for r in three.select("split").distinct().collect()} == {"train", "valid", "test"}


@pytest.mark.parametrize("exact", [True, False])
def test_groups_stay_on_one_side(skewed, exact):
    grouped = skewed.withColumn("g", n.effective_group(F.col("group_id"), F.col("code_hash")))
    marked = sampling.group_split(grouped, "g", 0.25, exact=exact)
    sides = marked.groupBy("g").agg(F.count_distinct("is_test").alias("sides"), F.first("is_test").alias("t"))
    assert sides.filter("sides > 1").count() == 0
    if exact:
        total, tested = sides.count(), sides.filter("t").count()
        assert tested == -(-total // 4)


def test_no_leak_after_split(skewed):
    parts = split_corpus(skewed)
    assert parts.train.join(parts.test.select("code_hash"), "code_hash", "left_semi").count() == 0
    assert parts.fit.join(parts.valid.select("_group"), "_group", "left_semi").count() == 0
    assert parts.fit.count() + parts.valid.count() == parts.train.count()


def test_keep_first_does_not_depend_on_partitions(skewed):
    expected = {}
    for r in skewed.orderBy("doc_id").select("doc_id", "code_hash").collect():
        expected.setdefault(r.code_hash, r.doc_id)
    for parts in (1, 7):
        kept = dedup.keep_first(skewed.repartition(parts))
        assert {r.code_hash: r.doc_id for r in kept.select("code_hash", "doc_id").collect()} == expected
        assert dedup.keep_first(kept).count() == len(expected)


def test_undersample_is_balanced(skewed):
    counts = {r.is_vulnerable: r["count"] for r in sampling.balanced_undersample(skewed, "doc_id").groupBy("is_vulnerable").count().collect()}
    assert counts[0] == counts[1] == skewed.filter("is_vulnerable = 1").count()


def test_weights_have_mean_one(skewed):
    scored = skewed.withColumn("probability", F.pmod(F.col("doc_id") * 7919, F.lit(1000)) / 1000)
    for weighted in (weighting.focal_weights(scored), weighting.effective_number_weights(scored), weighting.balanced_weights(scored)):
        assert weighted.agg(F.avg("weight")).first()[0] == pytest.approx(1.0)
    one_class = skewed.filter("is_vulnerable = 0")
    assert weighting.effective_number_weights(one_class).agg(F.avg("weight")).first()[0] == pytest.approx(1.0)


def test_folds_are_repeatable(skewed):
    a = sampling.folds(skewed, "doc_id", 5).select("doc_id", "fold").collect()
    b = sampling.folds(skewed.repartition(3), "doc_id", 5).select("doc_id", "fold").collect()
    assert sorted(a) == sorted(b) and {r.fold for r in a} == {0, 1, 2, 3, 4}
