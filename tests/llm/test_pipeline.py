"""The pipeline against its stages written plainly, on the small table."""

import re

import corpus_pipeline
from riskloom.llm import packing, quality, secrets, tokens
from riskloom.llm.queries import ORACLE, QUERIES, tokenizer
from riskloom.session import staged


def test_ten_operators_are_registered():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]


def test_stages_and_run(spark, sf):
    from test_jaccard import brute

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    alone = {i for i, _, c in brute([(i, rows[i]) for i in sorted(good)]) if i == c}
    plain = lambda t: re.sub(r"[^\w]+", " ", t.lower()).strip()
    leaks = [plain(r.text) for r in benchmark.collect()]
    clean = {i for i in alone if not any(t in plain(rows[i]) for t in leaks)}

    at, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        at = staged(stage(spark, at, sf), f"test-{name.replace('_', '-')}")
        seen.append(at)
        if name != "best_fit_packing":
            assert at.columns == docs.columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert ids[0] == good and ids[1] == alone and ids[2] == ids[3] == ids[4] == clean
    assert {r.doc_id: r.text for r in seen[3].collect()} == {i: secrets.redact(rows[i]) for i in clean}
    n = {r.doc_id: r.n for r in seen[4].groupBy("doc_id").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    encoder = tokens.Encoder(tokenizer(), False)
    assert n == {i: len(encoder.encode([secrets.redact(rows[i])])[0]) // 4 + 1 for i in clean}
    loads = seen[4].groupBy("bin_id", "bin_size").agg({"n_tokens": "sum"}).collect()
    assert all(r[2] <= r.bin_size and r.bin_size in packing.SIZES for r in loads)
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, seen[4].collect()))
