"""Rule catalogues and decisions."""

from pyspark.sql import functions as F

from checks import views as v
from checks.features import sql_names
from checks.normalise import ADVICE_SQL, FINDING_SQL, LEVEL, MITIGATION_SQL
from riskloom import fixed_values as fixed
from riskloom.operators import features, rules, validation

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _family_case(number, family):
    cwe, patterns = fixed.CWE_RULES[family]
    sql = f"""WITH {v.CORPUS}, t AS (SELECT doc_id, {sql_names(patterns)} AS r FROM corpus)
SELECT doc_id, array_to_string(r, ',') AS rule_names, CAST(len(r) AS BIGINT) AS hits, CASE WHEN len(r) > 0 THEN '{cwe}' END AS cwe_id FROM t"""

    def build(spark, sf):
        rows = rules.family_flags(v.corpus(spark, sf).select("doc_id", "raw_code"), family)
        return rows.select("doc_id", F.array_join("rule_names", ",").alias("rule_names"), "hits", "cwe_id")

    CASES[f"rul_{number:02d}_{family}"] = (build, sql)


for place, name in enumerate(fixed.CWE_RULES, 1):
    _family_case(place, name)

CWE_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {' OR '.join(v.sql_hit('raw_code', p) for _, p, _ in patterns)} THEN '{cwe}' END" for cwe, patterns in fixed.CWE_RULES.values()
) + "], lambda x: x IS NOT NULL)"
TEXT_LISTS = ("vulnerability_types", "cwe_ids", "recommendations")


def _joined(df, *names, sep="; "):
    return df.withColumns({name: F.array_join(name, sep) for name in names})


@case("rul_07_code_findings", f"""WITH {v.CORPUS} SELECT doc_id, array_to_string({FINDING_SQL}, '; ') AS vulnerability_types,
  array_to_string({CWE_SQL}, '; ') AS cwe_ids, array_to_string({MITIGATION_SQL}, '; ') AS recommendations FROM corpus""")
def rul_07(spark, sf):
    return _joined(rules.code_findings(v.corpus(spark, sf).select("doc_id", "raw_code")), *TEXT_LISTS).drop("raw_code")


def _typed_metrics(spark, sf):
    rows = v.metric_rows(spark, sf)
    return rows.withColumns({name: F.col(name).try_cast("double" if name == "test_coverage" else "bigint") for name in fixed.METRIC_FIELDS})


M = rules.METRIC_FINDINGS


@case("rul_08_metric_findings", f"""WITH {v.METRICS}, t AS (SELECT l_orderkey, l_linenumber, CAST(unsafe_patterns AS BIGINT) AS u, CAST(security_hotspots AS BIGINT) AS h,
    TRY_CAST(CASE WHEN cyclomatic_complexity = '3.5' THEN NULL ELSE cyclomatic_complexity END AS BIGINT) AS c, CAST(deprecated_functions AS BIGINT) AS d, CAST(test_coverage AS DOUBLE) AS k FROM metrics)
SELECT l_orderkey, l_linenumber,
  array_to_string(list_filter([CASE WHEN u > 0 THEN 'unsafe calls: ' || u END, CASE WHEN h > 0 THEN 'hotspots: ' || h END,
    CASE WHEN c > 10 THEN 'branches: ' || c END, CASE WHEN d > 0 THEN 'outdated calls: ' || d END,
    CASE WHEN k < 50 THEN 'coverage: ' || format('{{:.1f}}', k) || '%' END], lambda x: x IS NOT NULL), '; ') AS vulnerability_types,
  array_to_string(list_filter([CASE WHEN u > 0 THEN 'CWE-676' END, CASE WHEN h > 0 THEN 'CWE-119' END, CASE WHEN c > 10 THEN 'CWE-1075' END, CASE WHEN d > 0 THEN 'CWE-1104' END,
    CASE WHEN k < 50 THEN 'CWE-1223' END], lambda x: x IS NOT NULL), '; ') AS cwe_ids,
  array_to_string(list_filter([CASE WHEN u > 0 THEN {v.q(M[0][2])} END, CASE WHEN h > 0 THEN {v.q(M[1][2])} END, CASE WHEN c > 10 THEN {v.q(M[2][2])} END,
    CASE WHEN d > 0 THEN {v.q(M[3][2])} END, CASE WHEN k < 50 THEN {v.q(M[4][2])} END], lambda x: x IS NOT NULL), '; ') AS recommendations FROM t""")
def rul_08(spark, sf):
    found = rules.metric_findings(_typed_metrics(spark, sf).withColumn("cyclomatic_complexity", F.col("cyclomatic_complexity")))
    return _joined(found, *TEXT_LISTS).select("l_orderkey", "l_linenumber", *TEXT_LISTS)


REASON = "Model score driven by: no explanation available"


@case("rul_09_decide", f"""WITH {v.CORPUS}, t AS (SELECT doc_id, probability AS p, {LEVEL.format(p='probability')} AS level, {FINDING_SQL} AS types, {CWE_SQL} AS cwes, {MITIGATION_SQL} AS fixes FROM corpus)
SELECT doc_id, p >= 0.5 AS is_vulnerable, round(p, 4) AS risk_probability, level AS risk_level,
  array_to_string(CASE WHEN p >= 0.5 THEN list_concat(['{REASON}'], types) ELSE types END, '; ') AS vulnerability_types,
  array_to_string(CASE WHEN p >= 0.5 AND len(cwes) = 0 THEN ['CWE-Unknown'] ELSE cwes END, '; ') AS cwe_ids,
  {ADVICE_SQL.format(level='level')} || CASE WHEN len(fixes) > 0 THEN chr(10) || 'Proposed mitigations:' || chr(10) ||
  list_aggregate(list_transform(fixes, lambda x: '- ' || x), 'string_agg', chr(10)) ELSE '' END AS recommendation FROM t""")
def rul_09(spark, sf):
    decided = rules.decide(rules.code_findings(v.scored(spark, sf)))
    return _joined(decided, "vulnerability_types", "cwe_ids").select(
        "doc_id", "is_vulnerable", "risk_probability", "risk_level", "vulnerability_types", "cwe_ids", "recommendation")


PR_SQL = f"""WITH {v.CORPUS}, t AS (SELECT doc_id, path, probability AS p, {FINDING_SQL} AS types, {CWE_SQL} AS cwes, {sql_names(fixed.DANGEROUS)} AS s FROM corpus),
judged AS (SELECT doc_id, path, round(p, 4) AS probability, CASE WHEN len(types) > 0 OR len(cwes) > 0 OR len(s) > 0 OR round(p, 4) >= 0.9 THEN 'VULNERABLE' ELSE 'SAFE' END AS status FROM t)"""


@case("rul_10_decide_pr", f"""{PR_SQL} SELECT doc_id, probability, status, CASE WHEN status = 'SAFE' THEN 'LOW' ELSE {LEVEL.format(p='probability')} END AS risk_level FROM judged""")
def rul_10(spark, sf):
    found = rules.code_findings(v.scored(spark, sf)).withColumn("suspicious_patterns", features.suspicious_names(F.col("raw_code")))
    return rules.decide_pr(found, threshold=0.9).select("doc_id", "probability", "status", "risk_level")


@case("rul_11_precheck", rf"""WITH {v.CORPUS}, t AS (SELECT doc_id, list_filter([
    CASE WHEN regexp_matches(raw_code, '\bgets\s*\(') THEN 'gets() is forbidden' END, CASE WHEN regexp_matches(raw_code, '\bstrcpy\s*\(') THEN 'strcpy() is forbidden' END,
    CASE WHEN regexp_matches(raw_code, '\beval\s*\(') THEN 'eval() is forbidden' END], lambda x: x IS NOT NULL) AS i FROM corpus)
SELECT doc_id, array_to_string(i, '; ') AS issues, len(i) = 0 AS passed FROM t""")
def rul_11(spark, sf):
    return _joined(rules.precheck(v.corpus(spark, sf).select("doc_id", "raw_code")), "issues").drop("raw_code")


@case("rul_12_ci_findings", rf"""WITH {v.CORPUS}, t AS (SELECT doc_id, regexp_matches(raw_code, '\bgets\s*\(') AS g, regexp_matches(raw_code, '\beval\s*\(') AS e FROM corpus)
SELECT doc_id, array_to_string(list_filter([CASE WHEN g THEN 'buffer_overflow' END, CASE WHEN e THEN 'injection' END], lambda x: x IS NOT NULL), '; ') AS vulnerabilities,
  array_to_string(list_filter([CASE WHEN g THEN {v.q(rules.REMEDIATION['buffer_overflow'])} END, CASE WHEN e THEN {v.q(rules.REMEDIATION['injection'])} END], lambda x: x IS NOT NULL), '; ') AS mitigation FROM t""")
def rul_12(spark, sf):
    return _joined(rules.ci_findings(v.corpus(spark, sf).select("doc_id", "raw_code")), "vulnerabilities", "mitigation").drop("raw_code")


def _violation_sql():
    parts = []
    for f in fixed.METRIC_FIELDS:
        numeric = f"coalesce(regexp_full_match({f}, '-?[0-9]+(\\.[0-9]+)?'), false)"
        parts.append(f"CASE WHEN {f} IS NULL OR NOT ({numeric} OR {f} = 'NaN') THEN '{f}: not numeric' END")
        parts.append(f"CASE WHEN {f} = 'NaN' THEN '{f}: not finite' END")
        parts.append(f"CASE WHEN {numeric} AND TRY_CAST({f} AS DOUBLE) < 0 THEN '{f}: negative' END")
        if f != "test_coverage":
            parts.append(f"CASE WHEN {numeric} AND contains({f}, '.') THEN '{f}: not an integer' END")
    parts.append("CASE WHEN TRY_CAST(test_coverage AS DOUBLE) > 100 THEN 'test_coverage: above 100' END")
    parts.append("CASE WHEN lines_of_code = '0' THEN 'lines_of_code: zero' END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


@case("rul_13_validate_metrics", f"WITH {v.METRICS} SELECT l_orderkey, l_linenumber, array_to_string({_violation_sql()}, '; ') AS violations FROM metrics")
def rul_13(spark, sf):
    return _joined(validation.validate_metrics(v.metric_rows(spark, sf)), "violations").select("l_orderkey", "l_linenumber", "violations")


@case("rul_14_training_report", """SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(sum(CASE WHEN l.toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows,
  CAST(sum(CASE WHEN l.toxic NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS bad_labels, CAST(count(DISTINCT l.toxic) AS BIGINT) AS classes, 'null values' AS verdict
FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT CAST(count(*) AS BIGINT), 0, 0, CAST(count(DISTINCT toxic) AS BIGINT), 'ok' FROM documents JOIN labels USING (doc_id)""")
def rul_14(spark, sf):
    labels = v.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"))
    every = validation.training_report(v.documents(spark, sf).join(labels, "doc_id", "left"))
    return every.unionByName(validation.training_report(v.labelled(spark, sf)))
