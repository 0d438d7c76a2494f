import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskloom.functions import normalise as n
from riskloom.operators import evaluate, modelling
from riskloom.operators.vectorise import SyntacticFeatures
from riskloom.operators.weighting import balanced_weights
from riskloom.plans.train import train
from riskloom.session import shared_dir
from riskloom.sources import sinks


@pytest.fixture(scope="module")
def planted(spark):
    """Texts whose label shows in one word, for most of them."""
    i = F.col("id")
    bad = (i % 4 == 0) & (i % 36 != 0)
    df = spark.range(400).select(
        i.alias("doc_id"),
        F.concat(F.lit("int work number "), i, F.when(bad, F.lit(" strcpy(a, b); unsafe copy")).otherwise(F.lit(" memset bounded copy")), F.lit(" end of text")).alias("raw_code"),
        (i % 4 == 0).cast("int").alias("is_vulnerable"), F.when(i % 2 == 0, F.lit("c")).otherwise(F.lit("java")).alias("language"),
        F.when(i % 10 == 0, F.lit("owasp2025")).otherwise(F.concat(F.lit("s"), i % 3)).alias("source"), F.lit("").alias("group_id"))
    code = F.col("raw_code")
    return df.withColumns({"code_hash": n.content_key(code), "code_length": n.char_length(code), "line_count": n.nonblank_lines(code)}).cache()


def test_training_job(spark, planted):
    result = train(planted, modelling.model_pipeline(modelling.logistic(maxIter=20), 2**10))
    row = result.report.first()
    assert row.roc_auc > 0.8 and 0.05 <= result.threshold <= 0.95 and row.meets_target == (row.accuracy >= 0.8)
    assert sum(map(sum, row.confusion_matrix)) == row.test_records and row.fit_records + row.validation_records == row.train_records < row.total_clean_records
    assert 0 <= row.validation_f1 <= 1 and row.model == "LogisticRegression" and {r["class"] for r in result.classes.collect()} >= {"0", "1"}
    assert result.by_language.count() == 2 and result.by_source.filter("source = 'owasp2025'").count() == 0
    path = shared_dir(spark, "model")
    sinks.save_model(result.model, path)
    before = modelling.score(result.model, planted).select("doc_id", "probability").orderBy("doc_id").collect()
    assert before == modelling.score(sinks.load_model(path), planted).select("doc_id", "probability").orderBy("doc_id").collect()


def test_unseen_category_is_scored(planted):
    model = modelling.fit(modelling.model_pipeline(modelling.logistic(maxIter=5), 2**10), balanced_weights(planted))
    assert modelling.score(model, planted.withColumn("source", F.lit("never seen"))).filter("probability is null").count() == 0


def test_every_classifier_learns_the_signal(spark, planted):
    features = SyntacticFeatures.fit(planted, 50, min_df=2)
    rows = balanced_weights(features.transform(planted)).withColumn("is_valid", F.col("doc_id") % 5 == 0).cache()
    assert len(features.names) == rows.first().features.size
    for classifier in (
        modelling.logistic(maxIter=10), modelling.forest(numTrees=5, maxDepth=4), modelling.boosted(maxIter=3, maxDepth=3),
        modelling.linear_svc(maxIter=10), modelling.boosted_early_stop(maxIter=3, maxDepth=3),
    ):
        scored = modelling.score(Pipeline(stages=[classifier]).fit(rows), rows)
        assert evaluate.roc_auc(scored).first()[0] > 0.8
    logistic = Pipeline(stages=[modelling.logistic(maxIter=10)])
    # A small gamma: the rows whose planted label is wrong would carry most of the weight otherwise.
    two = modelling.two_stage_fit(logistic, logistic, rows.drop("weight", "is_valid"), gamma=0.5)
    assert evaluate.roc_auc(modelling.score(two, rows)).first()[0] > 0.8


def test_parameter_draws_are_repeatable():
    grid = {"a": [1, 2, 3], "b": [4, 5]}
    draws = modelling.parameter_draws(grid, 4)
    assert draws == modelling.parameter_draws(grid, 4) and len({tuple(d.items()) for d in draws}) == 4
    assert len(modelling.parameter_draws(grid, 10)) == 6


def test_vector_reasons_against_numpy(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from riskloom.operators import explain

    matrix = np.array([[3.0, 0.0, 1.0, 0.0], [0.0, 2.0, 0.0, 5.0], [1.0, 1.0, 1.0, 1.0], [0.0, 0.0, 0.0, 0.0]])
    weights, names = np.array([1.0, -2.0, 0.5, 0.25]), ["tfidf__a", "b", "ast__ast_c", "d"]
    df = spark.createDataFrame([(i, Vectors.dense(row)) for i, row in enumerate(matrix)], ["i", "features"])
    got = [r.reasons for r in explain.vector_reasons(df, names, weights).orderBy("i").collect()]
    shown = ["a", "b", "ast_c", "d"]
    for row, reasons in zip(matrix, got):
        gain = weights * (row - matrix.mean(axis=0))
        expected = [shown[k] for k in np.argsort(-gain, kind="stable")[:3] if gain[k] > 0]
        assert reasons == (expected or [explain.NO_REASON])


def test_vector_reasons_on_many_slots(spark):
    """Sparse rows of 2^18 slots, most of whose best reasons are absent slots."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from riskloom.operators import explain

    rng, size = np.random.default_rng(1), 2**18
    weights, means = np.round(rng.normal(size=size), 3), np.round(rng.exponential(size=size) * 0.01, 4)
    names = [f"slot{i}" for i in range(size)]
    best = np.argsort(weights * means, kind="stable")[:400]
    rows = []
    for i in range(30):
        slots = np.unique(np.concatenate([best[: i * 13], rng.integers(0, size, 20)]))
        rows.append((i, slots, rng.exponential(size=len(slots)) * 0.02))
    df = spark.createDataFrame([(i, Vectors.sparse(size, s.tolist(), x.tolist())) for i, s, x in rows], ["i", "features"])
    got = {r.i: r.reasons for r in explain.vector_reasons(df, names, weights, means).collect()}
    for i, slots, x in rows:
        value = np.zeros(size)
        value[slots] = x
        gain = weights * (value - means)
        assert got[i] == [names[k] for k in sorted(np.argsort(-gain)[:50], key=lambda k: (-gain[k], names[k]))[:3]]


def test_pipeline_with_code_blocks_is_saved(spark, planted):
    pipeline = modelling.model_pipeline(modelling.logistic(maxIter=5), 2**8, blocks=("security", "structure", "signals", "language"))
    model = modelling.fit(pipeline, balanced_weights(planted))
    path = shared_dir(spark, "model")
    sinks.save_model(model, path)
    before = modelling.score(model, planted).select("doc_id", "probability").orderBy("doc_id").collect()
    assert before == modelling.score(sinks.load_model(path), planted).select("doc_id", "probability").orderBy("doc_id").collect()
    assert not any(c.startswith(("sec_", "ast_")) for c in model.transform(planted).columns)


def counted(monkeypatch):
    """Names of the tables that model fits write, and how often feature stages are fitted."""
    from riskloom.operators import vectorise

    written, fits = [], []
    keep, fit = modelling.staged, vectorise.PopulationScaler._fit
    monkeypatch.setattr(modelling, "staged", lambda df, name: (written.append(name), keep(df, name))[1])
    monkeypatch.setattr(vectorise.PopulationScaler, "_fit", lambda self, df: (fits.append(1), fit(self, df))[1])
    return written, fits


def test_a_search_fits_features_once_for_each_fold(planted, monkeypatch):
    written, fits = counted(monkeypatch)
    rows = balanced_weights(planted)
    grid = {"regParam": [1e-4, 1e-2, 1.0], "elasticNetParam": [0.0, 0.5]}
    pipeline = modelling.model_pipeline(modelling.logistic(maxIter=5), 2**8)
    search = modelling.random_search(pipeline, rows, grid, "doc_id", draws=6, k=3)
    assert written.count("fold-vectors") == 3 and len(fits) == 4 and written.count("vectors") == 1  # three folds and the final fit
    assert len(search.avgMetrics) == 6 and max(search.avgMetrics) > 0.8
    assert search.params == modelling.parameter_draws(grid, 6)[search.avgMetrics.index(max(search.avgMetrics))]
    assert modelling.score(search.bestModel, planted).count() == 400


def test_folds_are_shared_and_agree_with_whole_fits(planted, monkeypatch):
    from riskloom.operators.sampling import folds

    rows = balanced_weights(planted)
    pipeline = modelling.model_pipeline(modelling.logistic(maxIter=5), 2**8)
    plain = {}
    for i in range(3):
        marked = folds(rows, "doc_id", 3, 42)
        model = modelling.fit(pipeline, marked.filter(F.col("fold") != i))
        plain[i] = evaluate.metrics(modelling.score(model, marked.filter(F.col("fold") == i)), None).first().f1
    written, fits = counted(monkeypatch)
    cache = modelling.fold_vectors(pipeline, rows, "doc_id", 3)
    assert len(fits) == 3 and written.count("fold-vectors") == 3
    assert {r.fold: r.f1 for r in modelling.cross_validated_f1(pipeline, rows, "doc_id", 3, cache=cache).collect()} == pytest.approx(plain)
    modelling.random_search(pipeline, rows, {"regParam": [1e-3]}, "doc_id", k=3, cache=cache)
    assert written.count("fold-vectors") == 3


def test_comparison_fits_features_once(planted, monkeypatch):
    written, fits = counted(monkeypatch)
    train_rows, test_rows = planted.filter("doc_id % 4 > 0 OR doc_id % 8 = 0"), planted.filter("doc_id % 8 = 4")
    models = {name: modelling.model_pipeline(modelling.logistic(maxIter=3, regParam=r), 2**8) for name, r in (("a", 1e-4), ("b", 1e-2))}
    rows = modelling.compare_models(models, train_rows, test_rows).collect()
    assert len(rows) == 6 and len(fits) == 1 and written.count("vectors") == 2  # one table of training rows, one of test rows


def test_whole_course_of_a_trainer(spark, planted):
    from riskloom.operators.vectorise import term_pipeline
    from riskloom.plans.train import train_classifier

    path = shared_dir(spark, "course")
    grid = {"numTrees": [3, 5], "maxDepth": [4]}
    result = train_classifier(planted, modelling.forest(), "doc_id", term_pipeline(60, min_df=2), True, grid, model_path=f"{path}/model", report_path=f"{path}/report")
    row = result.report.first()
    assert result.params in [{"numTrees": 3, "maxDepth": 4}, {"numTrees": 5, "maxDepth": 4}]
    assert row.roc_auc > 0.8 and row.cross_validation_f1_mean > 0.5 and sum(map(sum, row.confusion_matrix)) == 100
    best = result.importances.first()
    assert best.importance > 0 and not best.feature.startswith("_") and result.importances.count() > 30
    assert spark.read.json(f"{path}/report").first().roc_auc == row.roc_auc
    assert modelling.score(sinks.load_model(f"{path}/model"), planted).count() == 400


def test_missing_model(spark, planted):
    from riskloom.plans.scan import change_verdict

    files = planted.select(F.concat(F.lit("src/f"), "doc_id", F.lit(".c")).alias("path"), "raw_code")
    assert change_verdict(files, "/nonexistent/model", allow_missing_model=True).first()[:] == ("UNKNOWN", 0.0, "No model at /nonexistent/model.")
    with pytest.raises(FileNotFoundError):
        change_verdict(files, "/nonexistent/model")
    path = shared_dir(spark, "model")
    sinks.save_model(modelling.fit(modelling.model_pipeline(modelling.logistic(maxIter=5), 2**8), balanced_weights(planted)), path)
    assert change_verdict(files, path).first().status == "VULNERABLE"
