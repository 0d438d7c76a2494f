"""Caps, samples, splits, folds, weights, and the orders they rest on."""

from pyspark.sql import functions as F

from checks import views as v
from riskloom.functions import normalise as n
from riskloom.operators import sampling, weighting

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


H = "sha256('42|' || doc_id)"


@case("spl_01_first_per_source", """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk FROM documents) WHERE rk <= 20""")
def spl_01(spark, sf):
    return sampling.first_rows(v.documents(spark, sf), ["source"], "doc_id", 20).select("doc_id", "source")


@case("spl_02_class_balanced_cap", f"""WITH {v.LABELLED} SELECT doc_id, language, is_vulnerable FROM (
  SELECT *, row_number() OVER (PARTITION BY language, is_vulnerable ORDER BY doc_id) AS rk FROM labelled) WHERE rk <= 15""")
def spl_02(spark, sf):
    return sampling.class_balanced_cap(v.labelled(spark, sf), 30, "doc_id", keys=["language"]).select("doc_id", "language", "is_vulnerable")


@case("spl_03_balanced_undersample", f"""WITH {v.LABELLED}, r AS (SELECT doc_id, is_vulnerable, row_number() OVER (PARTITION BY is_vulnerable ORDER BY {H}) AS rk FROM labelled)
SELECT doc_id, is_vulnerable FROM r WHERE rk <= least(500, (SELECT count_if(is_vulnerable = 1) FROM labelled), (SELECT count_if(is_vulnerable = 0) FROM labelled))""")
def spl_03(spark, sf):
    return sampling.balanced_undersample(v.labelled(spark, sf), "doc_id").select("doc_id", "is_vulnerable")


def _splits():
    parts = []
    for f in (0.25, 0.2, 0.1):
        parts.append(f"rk <= round(n * {f}) AS test_{round(f * 100)}")
    return ", ".join(parts)


@case("spl_04_stratified_split", f"""WITH {v.LABELLED}, r AS (SELECT doc_id, is_vulnerable, {H} AS h, row_number() OVER (PARTITION BY is_vulnerable ORDER BY {H}) AS rk, count(*) OVER (PARTITION BY is_vulnerable) AS n FROM labelled)
SELECT doc_id, {_splits()}, CASE WHEN rk <= round(n * 0.1) THEN 'test' WHEN rk <= round(n * 0.1) + round(n * 0.1) THEN 'valid' ELSE 'train' END AS split,
  substr(h, 1, 8) < '40000000' AS test_by_hash FROM r""")
def spl_04(spark, sf):
    rows = sampling.stratified_flags(v.labelled(spark, sf), "doc_id", {"test_25": 0.25, "test_20": 0.2, "test_10": 0.1})
    rows = sampling.three_way_split(rows, "doc_id")
    rows = sampling.stratified_split(rows, "doc_id", 0.25, exact=False, flag="test_by_hash")
    return rows.select("doc_id", "test_25", "test_20", "test_10", "split", "test_by_hash")


GROUPED = f"""{v.DOCUMENTS}, g AS (SELECT doc_id, CASE WHEN length(group_id) > 0 THEN group_id ELSE sha256(raw_code) END AS group_key FROM docs),
k AS (SELECT group_key, row_number() OVER (ORDER BY sha256('42|' || group_key)) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT group_key FROM g))"""


@case("spl_05_group_split", f"""WITH {GROUPED} SELECT doc_id, group_key, rk <= ceil(n * 0.25) AS is_test, substr(sha256('42|' || group_key), 1, 8) < '40000000' AS by_threshold FROM g JOIN k USING (group_key)""")
def spl_05(spark, sf):
    rows = v.documents(spark, sf).select("doc_id", n.effective_group(F.col("group_id"), n.content_key(F.col("raw_code"))).alias("group_key"))
    rows = sampling.group_split(rows, "group_key", 0.25, exact=True)
    return sampling.group_split(rows, "group_key", 0.25, flag="by_threshold")


@case("spl_06_folds", f"SELECT doc_id, CAST(('0x' || substr({H}, 1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM documents")
def spl_06(spark, sf):
    return sampling.folds(v.documents(spark, sf), "doc_id", 5).select("doc_id", "fold")


@case("spl_07_fraction", f"SELECT doc_id FROM documents WHERE substr({H}, 1, 8) < '1999999a'")
def spl_07(spark, sf):
    return sampling.fraction(v.documents(spark, sf), "doc_id", 0.1).select("doc_id")


@case("spl_08_preview", f"SELECT doc_id, source, substr(text, 1, 300) AS preview FROM documents ORDER BY {H} LIMIT 3")
def spl_08(spark, sf):
    return sampling.preview(v.documents(spark, sf), "doc_id").select("doc_id", "source", "preview")


W = f"""WITH {v.LABELLED}, c AS (SELECT count_if(is_vulnerable = 0)::DOUBLE AS n0, count_if(is_vulnerable = 1)::DOUBLE AS n1 FROM labelled)"""


@case("wgt_01_balanced_weights", f"{W} SELECT doc_id, round((n0 + n1) / (2 * CASE WHEN is_vulnerable = 1 THEN n1 ELSE n0 END), 6) AS weight, round(n0 / n1, 6) AS ratio FROM labelled, c")
def wgt_01(spark, sf):
    rows = v.labelled(spark, sf)
    ratio = weighting.balanced_summary(rows).select("ratio").scalar()
    return weighting.balanced_weights(rows).select("doc_id", F.round("weight", 6).alias("weight"), F.round(ratio, 6).alias("ratio"))


@case("wgt_02_focal_weights", f"""WITH {v.LABELLED}, p AS (SELECT doc_id, is_vulnerable AS y, least(greatest(CASE WHEN is_vulnerable = 1 THEN probability ELSE 1 - probability END, 1e-7), 1 - 1e-7) AS pt FROM labelled),
w AS (SELECT doc_id, CASE WHEN y = 1 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END * power(1 - pt, 2) AS w FROM p)
SELECT doc_id, round(w / (SELECT avg(w) FROM w), 6) AS weight FROM w""")
def wgt_02(spark, sf):
    return weighting.focal_weights(v.labelled(spark, sf)).select("doc_id", F.round("weight", 6).alias("weight"))


@case("wgt_03_effective_number_weights", f"""{W}, e AS (SELECT n0, n1, (1 - 0.9999::DOUBLE) / (1 - power(0.9999::DOUBLE, n0)) AS w0, (1 - 0.9999::DOUBLE) / (1 - power(0.9999::DOUBLE, n1)) AS w1 FROM c)
SELECT doc_id, round(CASE WHEN is_vulnerable = 1 THEN w1 ELSE w0 END * (n0 + n1) / (w0 * n0 + w1 * n1), 6) AS weight FROM labelled, e""")
def wgt_03(spark, sf):
    return weighting.effective_number_weights(v.labelled(spark, sf)).select("doc_id", F.round("weight", 6).alias("weight"))


@case("wgt_04_fixed_weights", f"WITH {v.LABELLED} SELECT doc_id, CASE WHEN is_vulnerable = 1 THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM labelled")
def wgt_04(spark, sf):
    return weighting.fixed_weights(v.labelled(spark, sf)).select("doc_id", "weight")


@case("win_01_first_n_per_class", f"""WITH {v.LABELLED} SELECT doc_id, is_vulnerable FROM (
  SELECT *, row_number() OVER (PARTITION BY source, is_vulnerable ORDER BY doc_id) AS rk FROM labelled) WHERE rk <= 5""")
def win_01(spark, sf):
    return sampling.first_rows(v.labelled(spark, sf), ["source", "is_vulnerable"], "doc_id", 5).select("doc_id", "is_vulnerable")


@case("srt_02_shuffled", f"SELECT doc_id, {H} AS position FROM documents")
def srt_02(spark, sf):
    return sampling.shuffled(v.documents(spark, sf), "doc_id").select("doc_id", sampling.hash_order(F.col("doc_id")).alias("position"))
