"""Predicates."""

from pyspark.sql import functions as F

from checks import views as v
from checks.normalise import PAGES_CORPUS, _texts
from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.operators import rules
from riskloom.plans.prepare import cleaned_columns, usable

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


@case("flt_01_clean_length", f"WITH {v.MESSY} SELECT doc_id FROM messy WHERE length({v.sql_clean('raw_code')}) BETWEEN 30 AND 200000")
def flt_01(spark, sf):
    cleaned = v.messy(spark, sf).withColumn("raw_code", n.clean_code(F.col("raw_code")))
    return cleaned.filter(n.clean_length_ok(F.col("raw_code"))).select("doc_id")


@case("flt_02_raw_length", "SELECT doc_id FROM documents WHERE length(text) BETWEEN 50 AND 50000")
def flt_02(spark, sf):
    return v.documents(spark, sf).filter(n.raw_length_ok(F.col("raw_code"))).select("doc_id")


JUNK = "(regexp_matches(raw_code, '(?i)404.*Not Found') OR regexp_matches(raw_code, '(?i)<!DOCTYPE html') OR regexp_matches(raw_code, '(?i)<html'))"


@case("flt_03_junk", f"""WITH {PAGES_CORPUS} SELECT kind, id, {JUNK} AS junk,
  length(raw_code) BETWEEN 50 AND 50000 AND NOT {JUNK} AS kept, length(raw_code) BETWEEN 50 AND 50000 AS kept_with_junk FROM texts""")
def flt_03(spark, sf):
    code = F.col("raw_code")
    return _texts(spark, sf).select(
        "kind", "id", n.is_junk(code).alias("junk"), n.sample_ok(code).alias("kept"), n.sample_ok(code, filter_junk=False).alias("kept_with_junk"))


LABEL_TEXT = v.sql_pick(v.LABEL_TEXTS, "doc_id")


@case("flt_04_label_known", f"""SELECT doc_id, CAST(CASE WHEN t IN ('1','true','yes','vulnerable','unsafe','buggy') THEN 1 ELSE 0 END AS INTEGER) AS is_vulnerable
FROM (SELECT doc_id, lower(trim({LABEL_TEXT})) AS t FROM documents)
WHERE t IN ('1','true','yes','vulnerable','unsafe','buggy','0','false','no','safe','fixed','clean')""")
def flt_04(spark, sf):
    df = v.documents(spark, sf).withColumn("is_vulnerable", n.label_from_text(v.pick(v.LABEL_TEXTS, F.col("doc_id"))))
    return df.filter(F.col("is_vulnerable").isNotNull()).select("doc_id", "is_vulnerable")


@case("flt_05_drop_incomplete", """SELECT d.doc_id, l.toxic AS is_vulnerable FROM documents d JOIN labels l USING (doc_id)
WHERE l.toxic IS NOT NULL AND NOT (d.doc_id % 11 = 0)""")
def flt_05(spark, sf):
    labels = v.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"))
    df = v.documents(spark, sf).join(labels, "doc_id", "left").withColumn("raw_code", F.when(F.col("doc_id") % 11 != 0, F.col("raw_code")))
    return df.na.drop(subset=["raw_code", "is_vulnerable"]).select("doc_id", "is_vulnerable")


SUFFIX = r"lower(regexp_extract(path, '[^/](\.[^/.]+)$', 1))"
ALLOWED = "(" + ", ".join(f"'{s}'" for s in fixed.SOURCE_SUFFIXES) + ")"


@case("flt_06_source_file", f"WITH {v.DOCUMENTS} SELECT doc_id, path FROM docs WHERE {SUFFIX} IN {ALLOWED}")
def flt_06(spark, sf):
    return v.documents(spark, sf).filter(n.is_source_file(F.col("path"))).select("doc_id", "path")


@case("flt_07_path_scope", f"""WITH {v.DOCUMENTS} SELECT doc_id,
  NOT list_has_any(string_split(path, '/')[:-2], ['.git', 'node_modules', '.venv', '__pycache__', 'venv', 'build', 'dist', '.tox']) AS scanned,
  string_split(path, '/')[1] NOT IN ('app','scripts','tests','.github','notebooks','docs','data','models','reports') AS in_pr,
  string_split(path, '/')[1] NOT IN ('app','scripts','tests','.github','notebooks','docs','data','models','reports') AND starts_with(path, 'examples/') AS in_examples FROM docs""")
def flt_07(spark, sf):
    path = F.col("path")
    return v.documents(spark, sf).select(
        "doc_id", (~n.in_excluded_dir(path)).alias("scanned"), n.in_pr_scope(path).alias("in_pr"), n.in_pr_scope(path, "examples/").alias("in_examples"))


@case("flt_08_non_blank", f"""WITH b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN chr(9) || chr(10) || '  ' ELSE text END AS raw_code FROM documents)
SELECT doc_id FROM b WHERE {v.sql_strip('raw_code')} <> ''""")
def flt_08(spark, sf):
    df = v.documents(spark, sf).withColumn("raw_code", F.when(F.col("doc_id") % 7 == 0, F.lit("\t\n  ")).otherwise(F.col("raw_code")))
    return df.filter(~n.is_blank(F.col("raw_code"))).select("doc_id")


@case("flt_09_minimum_length", "SELECT doc_id, length(text) > 10 AS over_10, length(text) > 20 AS over_20 FROM documents")
def flt_09(spark, sf):
    from riskloom.sources.text_lines import longer_than
    return v.documents(spark, sf).select(
        "doc_id", longer_than(F.col("raw_code"), 10).alias("over_10"), longer_than(F.col("raw_code"), 20).alias("over_20"))


@case("flt_10_real_or_synthetic", """SELECT doc_id, s AS source, s IN ('owasp2025') AS synthetic
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'owasp2025' ELSE source END AS s FROM documents)""")
def flt_10(spark, sf):
    df = v.documents(spark, sf).withColumn("source", F.when(F.col("doc_id") % 5 == 0, F.lit("owasp2025")).otherwise(F.col("source")))
    return df.select("doc_id", "source", n.is_synthetic(F.col("source")).alias("synthetic"))


ANY_RULE = " OR ".join(v.sql_hit("raw_code", p) for _, patterns in fixed.CWE_RULES.values() for _, p, _ in patterns)
ANY_SIGNAL = " OR ".join(v.sql_hit("raw_code", p) for _, p, _ in fixed.DANGEROUS)


@case("flt_11_vulnerable_only", f"WITH {v.CORPUS} SELECT doc_id, probability FROM corpus WHERE {ANY_RULE} OR {ANY_SIGNAL} OR probability >= 0.5")
def flt_11(spark, sf):
    from riskloom.operators import features
    found = rules.code_findings(v.scored(spark, sf)).withColumn("suspicious_patterns", features.suspicious_names(F.col("raw_code")))
    return rules.decide_pr(found).filter(F.col("status") == "VULNERABLE").select("doc_id", "probability")
