"""Metrics, curves, thresholds, losses and explanations."""

from pyspark.sql import functions as F

from checks import views as v
from checks.sets import SIGNAL_COEFFICIENTS, SIGNAL_SQL
from riskloom import fixed_values as fixed
from riskloom.operators import dedup, evaluate, explain, features

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


CELLS = """CAST(count_if(is_vulnerable = 0 AND prediction = 0) AS BIGINT) AS tn, CAST(count_if(is_vulnerable = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count_if(is_vulnerable = 1 AND prediction = 0) AS BIGINT) AS fn, CAST(count_if(is_vulnerable = 1 AND prediction = 1) AS BIGINT) AS tp"""


def _metrics(digits):
    return f"""round(coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0)::DOUBLE, 0), {digits}) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), {digits}) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), {digits}) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), {digits}) AS f1"""


CONFUSION = f"{v.LABELLED}, c AS (SELECT {CELLS} FROM labelled)"


@case("evl_01_confusion", f"WITH {CONFUSION} SELECT * FROM c")
def evl_01(spark, sf):
    return evaluate.confusion(v.labelled(spark, sf))


@case("evl_02_metrics", f"WITH {CONFUSION} SELECT {_metrics(4)} FROM c")
def evl_02(spark, sf):
    return evaluate.metrics(v.labelled(spark, sf)).select("accuracy", "precision", "recall", "f1")


# Every positive is compared with every negative: slow, and independent of any ranking.
@case("evl_03_roc_auc", f"""WITH {v.LABELLED} SELECT round(avg(CASE WHEN p.probability > n.probability THEN 1.0 WHEN p.probability = n.probability THEN 0.5 ELSE 0.0 END), 6) AS roc_auc
FROM labelled p, labelled n WHERE p.is_vulnerable = 1 AND n.is_vulnerable = 0""")
def evl_03(spark, sf):
    return evaluate.roc_auc(v.labelled(spark, sf), digits=6)


CURVE = f"""{v.LABELLED}, s AS (SELECT probability AS threshold, count_if(is_vulnerable = 1) AS pos, count_if(is_vulnerable = 0) AS neg FROM labelled GROUP BY 1),
k AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC)::DOUBLE AS tp, sum(neg) OVER (ORDER BY threshold DESC)::DOUBLE AS fp, sum(pos) OVER ()::DOUBLE AS n1, sum(neg) OVER ()::DOUBLE AS n0 FROM s)"""


@case("evl_04_roc_curve", f"WITH {CURVE} SELECT threshold, round(fp / n0, 6) AS fpr, round(tp / n1, 6) AS tpr FROM k")
def evl_04(spark, sf):
    return evaluate.roc_curve(v.labelled(spark, sf)).select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@case("evl_05_precision_recall_curve", f"WITH {CURVE} SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / n1, 6) AS recall FROM k")
def evl_05(spark, sf):
    rows = evaluate.precision_recall_curve(v.labelled(spark, sf))
    return rows.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@case("evl_06_class_report", f"""WITH {CONFUSION}, r AS (
  SELECT '0' AS class, tn / (tn + fn)::DOUBLE AS p, tn / (tn + fp)::DOUBLE AS r, 2 * tn / (2 * tn + fn + fp)::DOUBLE AS f, tn + fp AS support, tn + fp + fn + tp AS n, (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS a FROM c
  UNION ALL SELECT '1', tp / (tp + fp)::DOUBLE, tp / (tp + fn)::DOUBLE, 2 * tp / (2 * tp + fp + fn)::DOUBLE, tp + fn, tn + fp + fn + tp, (tn + tp) / (tn + fp + fn + tp)::DOUBLE FROM c)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM r
UNION ALL SELECT 'accuracy', round(max(a), 6), round(max(a), 6), round(max(a), 6), max(n) FROM r
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), max(n) FROM r
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), max(n) FROM r""")
def evl_06(spark, sf):
    return evaluate.class_report(v.labelled(spark, sf), digits=6)


def _segment(name):
    return f"""SELECT '{name}' AS kind, {name} AS segment, tn + fp + fn + tp AS records, {_metrics(6)} FROM (SELECT {name}, {CELLS} FROM labelled GROUP BY 1)"""


@case("evl_07_segment_metrics", f"WITH {v.LABELLED} {_segment('language')} UNION ALL {_segment('source')}")
def evl_07(spark, sf):
    rows = v.labelled(spark, sf)
    parts = [evaluate.segment_metrics(rows, s, 6).withColumnRenamed(s, "segment").withColumn("kind", F.lit(s)) for s in ("language", "source")]
    return parts[0].unionByName(parts[1])


THRESHOLDS = ", ".join(f"{t!r}::DOUBLE" for t in fixed.THRESHOLDS)
SWEEP = f"""{v.LABELLED}, t AS (SELECT CAST(i - 1 AS INTEGER) AS step, [{THRESHOLDS}][i] AS threshold FROM range(1, 92) r(i)),
c AS (SELECT step, threshold, count_if(probability < threshold AND is_vulnerable = 0) AS tn, count_if(probability >= threshold AND is_vulnerable = 0) AS fp,
  count_if(probability < threshold AND is_vulnerable = 1) AS fn, count_if(probability >= threshold AND is_vulnerable = 1) AS tp FROM t, labelled GROUP BY ALL)"""


@case("evl_08_threshold_sweep", f"WITH {SWEEP} SELECT step, round(threshold, 4) AS threshold, {_metrics(6)} FROM c")
def evl_08(spark, sf):
    return evaluate.threshold_sweep(v.labelled(spark, sf))


@case("evl_09_best_threshold", f"WITH {SWEEP} SELECT step, round(threshold, 4) AS threshold, {_metrics(6)} FROM c ORDER BY accuracy DESC, f1 DESC, precision DESC, step LIMIT 1")
def evl_09(spark, sf):
    return evaluate.best_threshold(evaluate.threshold_sweep(v.labelled(spark, sf)))


@case("evl_10_target_check", f"WITH {CONFUSION}, m AS (SELECT {_metrics(4)} FROM c) SELECT accuracy, 0.8::DOUBLE AS minimum_accuracy, accuracy >= 0.8 AS meets_target FROM m")
def evl_10(spark, sf):
    return evaluate.target_check(evaluate.metrics(v.labelled(spark, sf))).select("accuracy", "minimum_accuracy", "meets_target")


def _signal_rows(spark, sf):
    return features.dangerous_counts(v.corpus(spark, sf).select("doc_id", "raw_code")).drop("raw_code")


@case("evl_12_top_reasons", f"""WITH {v.CORPUS}, s(term, pattern, coefficient) AS (VALUES {SIGNAL_SQL}),
x AS (SELECT doc_id, term, coefficient, CAST(len(regexp_extract_all(raw_code, pattern)) AS DOUBLE) AS value FROM corpus, s),
m AS (SELECT term, avg(value) AS mean FROM x GROUP BY 1),
r AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY round(coefficient * (value - mean), 9) DESC, term) AS rk, coefficient * (value - mean) AS c FROM x JOIN m USING (term))
SELECT doc_id, coalesce(string_agg('dangerous_' || term, ',' ORDER BY rk) FILTER (WHERE rk <= 3 AND c > 0), '{explain.NO_REASON}') AS reasons FROM r GROUP BY doc_id""")
def evl_12(spark, sf):
    names = [f"dangerous_{p[0]}" for p in fixed.DANGEROUS]
    reasons = explain.top_reasons(_signal_rows(spark, sf), names, SIGNAL_COEFFICIENTS)
    return reasons.select("doc_id", F.array_join("reasons", ",").alias("reasons"))


def _contributions(spark, sf):
    terms = F.array(*[F.struct(F.lit(p[0]).alias("term"), F.col(f"dangerous_{p[0]}").cast("double").alias("weight")) for p in fixed.DANGEROUS])
    long = _signal_rows(spark, sf).select("doc_id", F.inline(F.filter(terms, lambda t: t["weight"] > 0)))
    table = spark.createDataFrame([(p[0], c) for p, c in zip(fixed.DANGEROUS, SIGNAL_COEFFICIENTS)], "term string, coefficient double")
    return dedup.weighted_terms(long, table)


@case("win_02_top_terms", f"""WITH {v.CORPUS}, s(term, pattern, coefficient) AS (VALUES {SIGNAL_SQL}),
x AS (SELECT doc_id, term, coefficient * CAST(len(regexp_extract_all(raw_code, pattern)) AS DOUBLE) AS contribution FROM corpus JOIN s ON regexp_matches(raw_code, pattern))
SELECT doc_id, CAST(place AS INTEGER) AS place, term, contribution FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY contribution DESC, term) AS place FROM x WHERE contribution > 0) WHERE place <= 3""")
def win_02(spark, sf):
    return explain.top_terms(_contributions(spark, sf), "doc_id").select("doc_id", "place", "term", "contribution")


LOGIT = "(probability - 0.5) * 8"
LOSS = f"""{v.LABELLED}, b AS (SELECT is_vulnerable::DOUBLE AS y, {LOGIT} AS x FROM labelled), e AS (
  SELECT y, x, -(y * ln(1 / (1 + exp(-x))) + (1 - y) * ln(1 / (1 + exp(x)))) AS ce, CASE WHEN y = 1 THEN 1 / (1 + exp(-x)) ELSE 1 / (1 + exp(x)) END AS pt, CASE WHEN y = 1 THEN 0.25 ELSE 0.75 END AS a FROM b),
n AS (SELECT sum(y) AS n1, sum(1 - y) AS n0 FROM b), k AS (SELECT (1 - 0.9999::DOUBLE) / (1 - power(0.9999::DOUBLE, n1)) AS w1, (1 - 0.9999::DOUBLE) / (1 - power(0.9999::DOUBLE, n0)) AS w0 FROM n),
l AS (SELECT a * power(1 - pt, 2) * ce AS focal, CASE WHEN y = 1 THEN 10 ELSE 1 END * ce AS wce, CASE WHEN y = 1 THEN 2 * w1 ELSE 2 * w0 END / (w0 + w1) AS cw, ce FROM e, k)"""


@case("evl_13_losses", f"""WITH {LOSS} SELECT 'focal' AS kind, 'mean' AS reduction, round(avg(focal), 6) AS loss FROM l UNION ALL SELECT 'focal', 'sum', round(sum(focal), 6) FROM l
UNION ALL SELECT 'wce', 'mean', round(avg(wce), 6) FROM l UNION ALL SELECT 'wce', 'sum', round(sum(wce), 6) FROM l
UNION ALL SELECT 'cb focal', 'mean', round(avg(focal * cw), 6) FROM l UNION ALL SELECT 'cb bce', 'sum', round(sum(ce * cw), 6) FROM l""")
def evl_13(spark, sf):
    rows = v.labelled(spark, sf).withColumn("logit", (F.col("probability") - 0.5) * 8)
    wanted = [
        ("focal", "mean", {}), ("focal", "sum", {}), ("wce", "mean", {}), ("wce", "sum", {}), ("cb focal", "mean", {"inner": "focal"}), ("cb bce", "sum", {"inner": "bce"})]
    parts = [
        evaluate.loss(rows, kind.split()[0], reduction=reduction, **options).select(F.lit(kind).alias("kind"), F.lit(reduction).alias("reduction"), F.round("loss", 6).alias("loss"))
        for kind, reduction, options in wanted]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


PREVIOUS = (("accuracy", 0.56), ("f1", 0.5926), ("recall", 0.5882))


@case("evl_14_compare_runs", f"""WITH {CONFUSION}, m AS (SELECT {_metrics(4)} FROM c), x(metric, current, previous) AS (
  SELECT 'accuracy', accuracy, 0.56::DOUBLE FROM m UNION ALL SELECT 'f1', f1, 0.5926::DOUBLE FROM m UNION ALL SELECT 'recall', recall, 0.5882::DOUBLE FROM m)
SELECT metric, current, previous, round((current - previous) * 100, 2) AS delta_points FROM x""")
def evl_14(spark, sf):
    current = evaluate.metric_rows(evaluate.metrics(v.labelled(spark, sf)))
    return evaluate.compare_runs(current, spark.createDataFrame(list(PREVIOUS), "metric string, value double"))


@case("win_03_cumulative_counts", f"WITH {CURVE} SELECT threshold AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM k")
def win_03(spark, sf):
    return evaluate.cumulative_counts(evaluate.score_counts(v.labelled(spark, sf))).select("score", "tp", "fp")


@case("srt_01_sorted_segments", f"WITH {v.LABELLED}, m AS ({_segment('source')}) SELECT segment, f1, accuracy FROM m ORDER BY f1 DESC, accuracy DESC, segment LIMIT 5")
def srt_01(spark, sf):
    rows = evaluate.segment_metrics(v.labelled(spark, sf), "source", 6).withColumnRenamed("source", "segment")
    return rows.orderBy(F.desc("f1"), F.desc("accuracy"), "segment").limit(5).select("segment", "f1", "accuracy")
