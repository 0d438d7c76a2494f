"""Scalar normalisation."""

from pyspark.sql import functions as F

from checks import views as v
from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.functions import risk
from riskloom.operators import rules
from riskloom.operators.dedup import keep_first
from riskloom.operators.profile import cross_tab
from riskloom.plans.prepare import clean_records

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _rows(spark, sf):
    return v.corpus(spark, sf)


# Several code fields of which the first ones may be null or blank, by document number.
FIELD_SQL = f"""WITH {v.DOCUMENTS}, fields AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN raw_code WHEN 1 THEN '  ' || chr(10) WHEN 2 THEN '' END AS a,
         CASE doc_id % 3 WHEN 0 THEN 'b' || raw_code WHEN 1 THEN chr(9) END AS b, raw_code AS c FROM docs)"""


def _fields(spark, sf):
    d = F.col("doc_id")
    return v.documents(spark, sf).select(
        "doc_id",
        F.when(d % 4 == 0, F.col("raw_code")).when(d % 4 == 1, F.lit("  \n")).when(d % 4 == 2, F.lit("")).alias("a"),
        F.when(d % 3 == 0, F.concat(F.lit("b"), "raw_code")).when(d % 3 == 1, F.lit("\t")).alias("b"),
        F.col("raw_code").alias("c"),
    )


@case("prj_01_first_nonblank", f"""{FIELD_SQL}
SELECT doc_id, sha256(CASE WHEN {v.sql_strip("coalesce(a, '')")} <> '' THEN a WHEN {v.sql_strip("coalesce(b, '')")} <> '' THEN b ELSE c END) AS code_hash FROM fields""")
def prj_01(spark, sf):
    return _fields(spark, sf).select("doc_id", n.content_key(n.first_nonblank(F.col("a"), F.col("b"), F.col("c"))).alias("code_hash"))


LABEL_SQL = f"""SELECT doc_id, {v.sql_pick(v.LABEL_TEXTS, 'doc_id')} AS a, {v.sql_pick(v.LABEL_TEXTS, 'doc_id // 3')} AS b FROM documents"""


def _labels(spark, sf):
    d = F.col("doc_id")
    return v.table(spark, sf, "documents").select(
        "doc_id", v.pick(v.LABEL_TEXTS, d).alias("a"), v.pick(v.LABEL_TEXTS, F.floor(d / 3)).alias("b"))


@case("prj_02_first_present_label", f"SELECT doc_id, coalesce(a, b) AS label FROM ({LABEL_SQL})")
def prj_02(spark, sf):
    return _labels(spark, sf).select("doc_id", n.first_present(F.col("a"), F.col("b")).alias("label"))


@case("prj_03_label_normalise", f"""
SELECT doc_id, CAST(CASE WHEN lower(trim(a)) IN ('1','true','yes','vulnerable','unsafe','buggy') THEN 1
                    WHEN lower(trim(a)) IN ('0','false','no','safe','fixed','clean') THEN 0 END AS INTEGER) AS label,
       CAST(CASE WHEN (doc_id % 4) IN (0, 1) THEN doc_id % 4 END AS INTEGER) AS int_label,
       CAST(doc_id % 2 AS INTEGER) AS bool_label FROM ({LABEL_SQL})""")
def prj_03(spark, sf):
    typed = _labels(spark, sf).withColumns({"i": F.col("doc_id") % 4, "f": F.col("doc_id") % 2 == 1})
    return typed.select(
        "doc_id", n.label_from_text(F.col("a")).alias("label"),
        n.label_of(F.col("i"), typed.schema["i"].dataType).alias("int_label"), n.label_of(F.col("f"), typed.schema["f"].dataType).alias("bool_label"))


@case("prj_04_clean_code", f"""WITH {v.MESSY}
SELECT doc_id, sha256({v.sql_clean('raw_code')}) AS code_hash, CAST(length({v.sql_clean('raw_code')}) AS BIGINT) AS code_length FROM messy""")
def prj_04(spark, sf):
    cleaned = v.messy(spark, sf).withColumn("raw_code", n.clean_code(F.col("raw_code")))
    return cleaned.select("doc_id", n.content_key(F.col("raw_code")).alias("code_hash"), n.char_length(F.col("raw_code")).alias("code_length"))


def sql_first(code, probes):
    return "CASE " + " ".join(f"WHEN {v.sql_hit(code, p)} THEN '{name}'" for name, p, _ in probes) + " ELSE 'unknown' END"


ALIAS_CASES = " ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in fixed.LANGUAGE_ALIASES.items())


@case("prj_05_language_normalise", f"""WITH {v.CORPUS}, spelled AS (
  SELECT doc_id, raw_code, {v.sql_pick(v.LANGUAGE_TEXTS, 'doc_id')} AS spelling FROM corpus)
SELECT doc_id, CASE {ALIAS_CASES} ELSE {sql_first('raw_code', fixed.LANGUAGE_PROBES)} END AS language
FROM (SELECT *, replace(replace(replace(lower(trim(coalesce(spelling, ''))), 'c++', 'cpp'), 'c/cpp', 'cpp'), 'c_cpp', 'cpp') AS t FROM spelled)""")
def prj_05(spark, sf):
    return _rows(spark, sf).select("doc_id", n.normalise_language(v.pick(v.LANGUAGE_TEXTS, F.col("doc_id")), F.col("raw_code")).alias("language"))


@case("prj_06_detect_language", f"WITH {v.CORPUS} SELECT doc_id, {sql_first('raw_code', fixed.LANGUAGE_PROBES)} AS language FROM corpus")
def prj_06(spark, sf):
    return _rows(spark, sf).select("doc_id", n.detect_language(F.col("raw_code")).alias("language"))


PAGES_CORPUS = f"""{v.CORPUS}, texts AS (
  SELECT 'doc' AS kind, doc_id AS id, raw_code FROM corpus UNION ALL SELECT 'page', page_id, html FROM pages)"""


def _texts(spark, sf):
    docs = v.corpus(spark, sf).select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "raw_code")
    pages = v.table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("raw_code"))
    return docs.unionByName(pages)


@case("prj_07_detect_web_language", f"WITH {PAGES_CORPUS} SELECT kind, id, {sql_first('raw_code', fixed.WEB_LANGUAGE_PROBES)} AS language FROM texts")
def prj_07(spark, sf):
    return _texts(spark, sf).select("kind", "id", n.detect_web_language(F.col("raw_code")).alias("language"))


def sql_scored(code, scores):
    """Score columns, then the first language that holds the maximum."""
    parts = {k: " + ".join(f"CAST({v.sql_hit(code, p)} AS INTEGER)" for _, p, _ in rows) for k, rows in scores.items()}
    columns = ", ".join(f"{e} AS s_{k}" for k, e in parts.items())
    best = "greatest(" + ", ".join(f"s_{k}" for k in parts) + ")"
    chain = " ".join(f"WHEN s_{k} = {best} THEN '{k}'" for k in parts)
    return columns, f"CASE WHEN {best} = 0 THEN 'unknown' {chain} END"


COLS8, BEST8 = sql_scored("raw_code", fixed.LANGUAGE_SCORES_8)
COLS6, BEST6 = sql_scored("raw_code", fixed.LANGUAGE_SCORES_6)


@case("prj_08_detect_language_scored", f"WITH {v.CORPUS} SELECT doc_id, {BEST8} AS language FROM (SELECT doc_id, {COLS8} FROM corpus)")
def prj_08(spark, sf):
    return _rows(spark, sf).select("doc_id", n.detect_language_scored(F.col("raw_code")).alias("language"))


@case("prj_09_detect_language_six", f"WITH {v.CORPUS} SELECT doc_id, {BEST6} AS language FROM (SELECT doc_id, {COLS6} FROM corpus)")
def prj_09(spark, sf):
    return _rows(spark, sf).select("doc_id", n.detect_language_scored(F.col("raw_code"), fixed.LANGUAGE_SCORES_6).alias("language"))


@case("prj_10_language_name", f"""SELECT doc_id, CASE
  WHEN contains(t, 'c++') OR contains(t, 'cxx') OR contains(t, 'cpp') THEN 'cpp' WHEN contains(t, 'java') THEN 'java'
  WHEN contains(t, 'python') OR t = 'py' THEN 'python' WHEN contains(t, 'javascript') OR t = 'js' THEN 'javascript'
  WHEN contains(t, 'php') THEN 'php' WHEN contains(t, 'ruby') OR t = 'rb' THEN 'ruby' WHEN contains(t, 'go') THEN 'go'
  WHEN t = 'c' THEN 'c' ELSE 'unknown' END AS language
FROM (SELECT doc_id, trim(lower({v.sql_pick(v.LANGUAGE_TEXTS, 'doc_id')})) AS t FROM documents)""")
def prj_10(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", n.language_name(v.pick(v.LANGUAGE_TEXTS, F.col("doc_id"))).alias("language"))


@case("prj_11_language_from_path", rf"""WITH {v.CORPUS}
SELECT doc_id, CASE WHEN s IN ('.c', '.h') THEN 'c' WHEN s IN ('.cc', '.cpp', '.cxx', '.hpp') THEN 'cpp'
  WHEN s = '.java' OR regexp_matches(raw_code, '\bpublic\s+class\b') THEN 'java' WHEN s = '.py' THEN 'python'
  WHEN s IN ('.js', '.ts') THEN substr(s, 2) WHEN s = '.go' THEN 'go' WHEN s = '.rs' THEN 'rust' ELSE 'unknown' END AS language
FROM (SELECT *, lower(regexp_extract(path, '[^/](\.[^/.]+)$', 1)) AS s FROM corpus)""")
def prj_11(spark, sf):
    return _rows(spark, sf).select("doc_id", n.language_from_path(F.col("path"), F.col("raw_code")).alias("language"))


@case("prj_12_content_key", "SELECT doc_id, sha256(text) AS code_hash FROM documents")
def prj_12(spark, sf):
    return v.documents(spark, sf).select("doc_id", n.content_key(F.col("raw_code")).alias("code_hash"))


@case("prj_13_char_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS code_length FROM documents")
def prj_13(spark, sf):
    return v.documents(spark, sf).select("doc_id", n.char_length(F.col("raw_code")).alias("code_length"))


@case("prj_14_nonblank_lines", f"WITH {v.MESSY} SELECT doc_id, {v.sql_lines('raw_code')} AS line_count FROM messy")
def prj_14(spark, sf):
    return v.messy(spark, sf).select("doc_id", n.nonblank_lines(F.col("raw_code")).alias("line_count"))


@case("prj_15_raw_lines", f"WITH {v.MESSY} SELECT doc_id, CAST(len(string_split(raw_code, chr(10))) AS BIGINT) AS code_lines FROM messy")
def prj_15(spark, sf):
    return v.messy(spark, sf).select("doc_id", n.raw_lines(F.col("raw_code")).alias("code_lines"))


@case("prj_16_group_id", """SELECT doc_id,
  coalesce(CASE WHEN doc_id % 3 = 0 THEN 'cve-' || doc_id END, CASE WHEN doc_id % 3 = 1 THEN 'commit-' || doc_id END, CAST(doc_id AS VARCHAR)) AS group_id,
  coalesce(CASE WHEN doc_id % 3 = 0 THEN 'cve-' || doc_id END, '') || ':' || source || ':' || lang || ':' || doc_id AS function_group FROM documents""")
def prj_16(spark, sf):
    d, text = F.col("doc_id"), F.col("doc_id").cast("string")
    cve = F.when(d % 3 == 0, F.concat(F.lit("cve-"), text))
    commit = F.when(d % 3 == 1, F.concat(F.lit("commit-"), text))
    return v.table(spark, sf, "documents").select(
        "doc_id", n.first_present(cve, commit, text).alias("group_id"), n.composed_group(cve, F.col("source"), F.col("lang"), text).alias("function_group"))


@case("prj_17_effective_group", f"WITH {v.DOCUMENTS} SELECT doc_id, CASE WHEN length(group_id) > 0 THEN group_id ELSE sha256(raw_code) END AS group_key FROM docs")
def prj_17(spark, sf):
    return v.documents(spark, sf).select("doc_id", n.effective_group(F.col("group_id"), n.content_key(F.col("raw_code"))).alias("group_key"))


@case("prj_18_scoring_row", f"""WITH {v.CORPUS} SELECT doc_id, sha256(raw_code) AS code_hash, {sql_first('raw_code', fixed.WEB_LANGUAGE_PROBES)} AS language,
  'manual' AS source, CAST(length(raw_code) AS BIGINT) AS code_length, {v.sql_lines('raw_code')} AS line_count FROM corpus""")
def prj_18(spark, sf):
    rows = _rows(spark, sf).select("doc_id", *n.scoring_row(F.col("raw_code")))
    return rows.withColumn("code_hash", n.content_key(F.col("raw_code"))).drop("raw_code")


LEVEL = "CASE WHEN {p} < 0 OR {p} > 1 THEN NULL WHEN {p} < 0.4 THEN 'LOW' WHEN {p} < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END"


@case("prj_19_risk_level", f"""WITH s AS (SELECT doc_id, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE AS p, ((doc_id * 7919) % 1300) / 1000.0::DOUBLE - 0.1 AS wide FROM documents)
SELECT doc_id, {LEVEL.format(p='p')} AS risk_level, {LEVEL.format(p='wide')} AS audited_level FROM s""")
def prj_19(spark, sf):
    wide = ((F.col("doc_id") * 7919) % 1300) / 1000.0 - 0.1
    return v.table(spark, sf, "documents").select(
        "doc_id", risk.risk_level(v.probability()).alias("risk_level"), risk.risk_level(wide, strict=False).alias("audited_level"))


ADVICE_SQL = "CASE {level} " + " ".join(f"WHEN '{k}' THEN {v.q(t)}" for k, t in risk.ADVICE.items()) + " END"


@case("prj_20_base_advice", f"""SELECT doc_id, {ADVICE_SQL.format(level='risk_level')} AS recommendation
FROM (SELECT doc_id, {LEVEL.format(p='((doc_id * 7919) % 1000) / 1000.0::DOUBLE')} AS risk_level FROM documents)""")
def prj_20(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", risk.base_advice(risk.risk_level(v.probability())).alias("recommendation"))


MITIGATION_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {' OR '.join(v.sql_hit('raw_code', p) for _, p, _ in patterns)} THEN {v.q(rules.MITIGATIONS[family])} END"
    for family, (_, patterns) in fixed.CWE_RULES.items()) + "], lambda x: x IS NOT NULL)"


@case("prj_21_advice_text", f"""WITH {v.CORPUS}, m AS (SELECT doc_id, {LEVEL.format(p='probability')} AS level, {MITIGATION_SQL} AS fixes FROM corpus)
SELECT doc_id, {ADVICE_SQL.format(level='level')} || CASE WHEN len(fixes) > 0 THEN chr(10) || 'Proposed mitigations:' || chr(10) ||
  list_aggregate(list_transform(fixes, lambda x: '- ' || x), 'string_agg', chr(10)) ELSE '' END AS recommendation FROM m""")
def prj_21(spark, sf):
    found = rules.code_findings(v.scored(spark, sf))
    return found.select("doc_id", risk.advice_text(risk.risk_level(F.col("probability")), F.col("recommendations")).alias("recommendation"))


@case("prj_22_round_probability", "SELECT doc_id, round(((doc_id * 7919) % 1000) / 1000.0::DOUBLE / 7, 4) AS risk_probability FROM documents")
def prj_22(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", risk.reported_probability(v.probability() / 7).alias("risk_probability"))


FINDING_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {v.sql_hit('raw_code', p)} THEN {v.q(rules.FINDINGS[family, name])} END"
    for family, (_, patterns) in fixed.CWE_RULES.items() for name, p, _ in patterns) + "], lambda x: x IS NOT NULL)"


@case("prj_23_report_line", f"""WITH {v.CORPUS}, m AS (
  SELECT doc_id, path, probability AS p, {LEVEL.format(p='probability')} AS level, {FINDING_SQL} AS types, {MITIGATION_SQL} AS fixes FROM corpus)
SELECT doc_id, list_aggregate(list_concat(list_concat([path || ' — ' || format('{{:.1f}}', p * 100) || '% (' || level || ')'],
  list_transform(types, lambda x: '   type: ' || substr(x, 1, 100))), list_transform(fixes[1:1], lambda x: '   fix: ' || substr(x, 1, 120))), 'string_agg', chr(10)) AS line FROM m""")
def prj_23(spark, sf):
    found = rules.code_findings(v.scored(spark, sf))
    line = risk.report_line(
        F.col("path"), F.col("probability"), risk.risk_level(F.col("probability")), F.col("vulnerability_types"), F.col("recommendations"))
    return found.select("doc_id", line.alias("line"))


@case("prj_24_feature_label", """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'word_' || doc_id WHEN 1 THEN 'ast_depth_' || doc_id ELSE 'lang_' || lang END AS feature FROM documents""")
def prj_24(spark, sf):
    d = F.col("doc_id")
    raw = F.when(d % 3 == 0, F.concat(F.lit("tfidf__word_"), d)).when(d % 3 == 1, F.concat(F.lit("ast__ast_depth_"), d)).otherwise(F.concat(F.lit("lang_"), "lang"))
    return v.table(spark, sf, "documents").select("doc_id", risk.feature_label(raw).alias("feature"))


@case("prj_25_logit_decision", """SELECT doc_id, round(1 / (1 + exp(-x)), 6) AS probability, 1 / (1 + exp(-x)) > 0.5 AS positive
FROM (SELECT doc_id, (((doc_id * 7919) % 1000) / 1000.0::DOUBLE - 0.5) * 8 AS x FROM documents)""")
def prj_25(spark, sf):
    p = risk.sigmoid((v.probability() - 0.5) * 8)
    return v.table(spark, sf, "documents").select("doc_id", F.round(p, 6).alias("probability"), (p > 0.5).alias("positive"))


@case("flagship_clean_profile", f"""WITH {v.CLEAN}, kept AS (SELECT code_hash, min_by(source, doc_id) AS source, min_by(is_vulnerable, doc_id) AS y FROM clean GROUP BY code_hash)
SELECT source, CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS label_0, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS label_1 FROM kept GROUP BY source""")
def flagship(spark, sf):
    """Clean, hash, filter, deduplicate, then count by source and label."""
    labels = v.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"))
    raw = v.messy(spark, sf).join(labels, "doc_id", "left")
    keyed = clean_records(raw).select("code_hash", "source", "is_vulnerable", "doc_id")
    return cross_tab(keep_first(keyed, order=["doc_id"]), "source")
