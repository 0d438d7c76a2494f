"""Profiles and summaries."""

from pyspark.sql import functions as F

from checks import views as v
from checks.filters import JUNK
from checks.normalise import LEVEL, PAGES_CORPUS, _texts
from checks.rules import PR_SQL
from riskloom.functions import normalise as n
from riskloom.operators import features, profile, rules
from riskloom.plans.prepare import cleaned_columns, usable
from riskloom.plans.scan import change_verdict, scan

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _raw(spark, sf):
    labels = v.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"))
    return v.messy(spark, sf).join(labels, "doc_id", "left")


USABLE = "(length(raw_code) BETWEEN 30 AND 200000 AND coalesce(is_vulnerable IN (0, 1), false))"
BROKEN = "doc_id % 19 = 0"


@case("agg_01_source_profile", f"""WITH {v.CLEAN} SELECT source, CAST(count_if(NOT {BROKEN}) AS BIGINT) AS input_records, CAST(count_if(NOT {BROKEN} AND {USABLE}) AS BIGINT) AS usable_records,
  CAST(count_if(NOT {BROKEN} AND {USABLE} AND is_vulnerable = 0) AS BIGINT) AS label_0, CAST(count_if(NOT {BROKEN} AND {USABLE} AND is_vulnerable = 1) AS BIGINT) AS label_1,
  CAST(count_if({BROKEN}) AS BIGINT) AS errors FROM prepared GROUP BY source""")
def agg_01(spark, sf):
    return profile.source_profile(cleaned_columns(_raw(spark, sf)), usable(), F.col("doc_id") % 19 == 0)


@case("agg_02_combined_profile", f"""WITH {v.LABELLED} SELECT 'label' AS dimension, CAST(is_vulnerable AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS row_count FROM labelled GROUP BY 2
UNION ALL SELECT 'source', source, CAST(count(*) AS BIGINT) FROM labelled GROUP BY 2""")
def agg_02(spark, sf):
    return profile.combined_profile(v.labelled(spark, sf))


@case("agg_03_class_shares", f"""WITH {v.LABELLED} SELECT is_vulnerable, CAST(count(*) AS BIGINT) AS row_count, round(count(*) / (SELECT count(*) FROM labelled)::DOUBLE, 6) AS share FROM labelled GROUP BY 1""")
def agg_03(spark, sf):
    return profile.class_shares(v.labelled(spark, sf))


def _cross(segment):
    return f"""WITH {v.LABELLED} SELECT {segment} AS segment, '{segment}' AS kind, CAST(count_if(is_vulnerable = 0) AS BIGINT) AS label_0, CAST(count_if(is_vulnerable = 1) AS BIGINT) AS label_1 FROM labelled GROUP BY 1"""


@case("agg_04_cross_tab", f"SELECT * FROM ({_cross('source')}) UNION ALL SELECT * FROM ({_cross('language')})")
def agg_04(spark, sf):
    rows = v.labelled(spark, sf)
    parts = [profile.cross_tab(rows, s).select(F.col(s).alias("segment"), F.lit(s).alias("kind"), "label_0", "label_1") for s in ("source", "language")]
    return parts[0].unionByName(parts[1])


@case("agg_05_length_statistics", """SELECT CAST(min(n) AS BIGINT) AS min_length, CAST(max(n) AS BIGINT) AS max_length, round(avg(n), 6) AS mean_length,
  quantile_cont(n, 0.25)::DOUBLE AS p25, quantile_cont(n, 0.5)::DOUBLE AS median_length, quantile_cont(n, 0.75)::DOUBLE AS p75 FROM (SELECT length(text) AS n FROM documents)""")
def agg_05(spark, sf):
    return profile.length_statistics(v.documents(spark, sf).withColumn("code_length", n.char_length(F.col("raw_code"))))


@case("agg_06_field_presence", f"""WITH {v.DOCUMENTS}, j AS (SELECT d.*, l.toxic, l.quality FROM docs d LEFT JOIN labels l USING (doc_id))
SELECT unnest(['raw_code', 'language', 'toxic', 'quality']) AS field, unnest([count(raw_code), count(language), count(toxic), count(quality)]) AS present FROM j""")
def agg_06(spark, sf):
    joined = v.documents(spark, sf).join(v.table(spark, sf, "labels"), "doc_id", "left")
    return profile.field_presence(joined, ["raw_code", "language", "toxic", "quality"])


@case("agg_07_majority_baseline", f"""WITH {v.LABELLED}, c AS (SELECT is_vulnerable AS y, count(*) AS n FROM labelled GROUP BY 1)
SELECT (SELECT y FROM c ORDER BY n DESC, y LIMIT 1) AS majority_label, round(max(n) / sum(n)::DOUBLE, 6) AS baseline_accuracy FROM c""")
def agg_07(spark, sf):
    return profile.majority_baseline(v.labelled(spark, sf))


@case("agg_08_scan_summary", f"""WITH {v.CORPUS}, s AS (SELECT probability >= 0.5 AS bad, {LEVEL.format(p='probability')} AS l FROM corpus)
SELECT CAST(count(*) AS BIGINT) AS total_files, CAST(count_if(l = 'HIGH') AS BIGINT) AS high, CAST(count_if(l = 'MEDIUM') AS BIGINT) AS medium, CAST(count_if(l = 'LOW') AS BIGINT) AS low,
  CAST(count_if(bad) AS BIGINT) AS vulnerable_files, CAST(count_if(NOT bad) AS BIGINT) AS safe_files, round(count_if(bad) / count(*)::DOUBLE, 4) AS vulnerability_rate,
  round(100 * count_if(bad) / count(*)::DOUBLE, 1) AS vulnerable_percent FROM s""")
def agg_08(spark, sf):
    return profile.scan_summary(scan(v.scored(spark, sf)))


@case("agg_09_scan_verdict", f"""{PR_SQL} SELECT CASE WHEN count_if(status = 'VULNERABLE') > 0 THEN 'VULNERABLE' ELSE 'SAFE' END AS status, round(max(probability), 4) AS probability,
  count_if(status = 'VULNERABLE') || ' of ' || count(*) || ' analysed files are vulnerable.' AS details FROM judged
UNION ALL SELECT 'UNKNOWN', 0.0, 'No model at /nonexistent/model.'""")
def agg_09(spark, sf):
    found = rules.code_findings(v.scored(spark, sf)).withColumn("suspicious_patterns", features.suspicious_names(F.col("raw_code")))
    judged = profile.scan_verdict(rules.decide_pr(found, threshold=0.9))
    return judged.unionByName(change_verdict(v.corpus(spark, sf), "/nonexistent/model", allow_missing_model=True))


@case("agg_10_class_counts_by_category", f"WITH {v.LABELLED} SELECT source AS owasp_category, is_vulnerable, CAST(count(*) AS BIGINT) AS row_count FROM labelled GROUP BY ALL")
def agg_10(spark, sf):
    return profile.class_counts_by(v.labelled(spark, sf).withColumnRenamed("source", "owasp_category"), "owasp_category")


@case("agg_11_kept_by_source", f"""WITH {PAGES_CORPUS} SELECT kind AS source, CAST(count(*) AS BIGINT) AS seen,
  CAST(count_if(length(raw_code) BETWEEN 50 AND 50000 AND NOT {JUNK}) AS BIGINT) AS kept FROM texts GROUP BY 1""")
def agg_11(spark, sf):
    return profile.kept_by_source(_texts(spark, sf).withColumnRenamed("kind", "source"), n.sample_ok(F.col("raw_code")))
