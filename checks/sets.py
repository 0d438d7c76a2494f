"""Union, deduplication, leakage removal and joins."""

from pyspark.sql import functions as F

from checks import views as v
from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.operators import dedup, features, rules, validation

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _three_sources(spark, sf):
    """Documents, pages and conversation turns as three sources with a file position."""
    docs = v.table(spark, sf, "documents").select(F.col("text").alias("raw_code"), F.col("doc_id").alias("row_pos"), "lang")
    pages = v.table(spark, sf, "pages").select(F.col("html").alias("raw_code"), F.col("page_id").alias("row_pos"), "url")
    turns = v.table(spark, sf, "conversations").select(F.col("text").alias("raw_code"), (F.col("conv_id") * 100 + F.col("turn")).alias("row_pos"))
    return {"documents": docs, "pages": pages, "turns": turns}


UNION = """u AS (
  SELECT 'documents' AS source, 0 AS source_rank, text AS raw_code, doc_id AS row_pos FROM documents
  UNION ALL SELECT 'pages', 1, html, page_id FROM pages UNION ALL SELECT 'turns', 2, text, conv_id * 100 + turn FROM conversations)"""
JUNK = "regexp_matches(raw_code, '(?i)404.*Not Found|<!DOCTYPE html|<html')"


@case("set_01_combined_corpus", f"""WITH {UNION}, c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY row_pos) AS rk FROM u)
SELECT source, source_rank, row_pos, sha256(raw_code) AS code_hash, rk <= 300 AS capped
FROM c WHERE length(raw_code) BETWEEN 50 AND 50000 AND NOT {JUNK}""")
def set_01(spark, sf):
    """The whole combined corpus, and which of its rows a cap of 300 per source keeps."""
    frames = _three_sources(spark, sf)
    whole = dedup.combined_corpus(frames)
    capped = dedup.combined_corpus(frames, limit_per_source=300).select("source", "row_pos", F.lit(True).alias("capped"))
    joined = whole.join(capped, ["source", "row_pos"], "left")
    return joined.select(
        "source", "source_rank", "row_pos", n.content_key(F.col("raw_code")).alias("code_hash"), F.coalesce("capped", F.lit(False)).alias("capped"))


@case("set_02_keep_first", f"""WITH {UNION} SELECT code_hash, source, row_pos FROM (
  SELECT sha256(raw_code) AS code_hash, source, row_pos, row_number() OVER (PARTITION BY raw_code ORDER BY source_rank DESC, row_pos) AS rk FROM u) WHERE rk = 1""")
def set_02(spark, sf):
    """Sources in reverse order, so that the winner of a repeated text is not the first one read."""
    rows = dedup.union_sources(_three_sources(spark, sf))
    keyed = rows.select(n.content_key(F.col("raw_code")).alias("code_hash"), "source", (2 - F.col("source_rank")).alias("source_rank"), "row_pos")
    return dedup.keep_first(keyed, order=["source_rank", "row_pos"]).select("code_hash", "source", "row_pos")


@case("set_03_drop_leaked", """SELECT doc_id FROM documents d WHERE d.source < 'src5' AND NOT EXISTS (SELECT 1 FROM documents t WHERE NOT (t.source < 'src5') AND t.text = d.text)""")
def set_03(spark, sf):
    docs = v.documents(spark, sf).select("doc_id", "source", n.content_key(F.col("raw_code")).alias("code_hash"))
    train = F.col("source") < "src5"
    return dedup.drop_leaked(docs.filter(train), docs.filter(~train)).select("doc_id")


@case("set_04_final_training_set", """SELECT code_hash, origin FROM (
  SELECT sha256(text) AS code_hash, CASE WHEN source < 'src5' THEN 'real' ELSE 'synthetic' END AS origin,
         row_number() OVER (PARTITION BY text ORDER BY CASE WHEN source < 'src5' THEN 0 ELSE 1 END, doc_id) AS rk FROM documents) WHERE rk = 1""")
def set_04(spark, sf):
    docs = v.documents(spark, sf).select("doc_id", "source", n.content_key(F.col("raw_code")).alias("code_hash"))
    real = F.col("source") < "src5"
    union = dedup.final_training_set(
        docs.filter(real).withColumn("origin", F.lit("real")), docs.filter(~real).withColumn("origin", F.lit("synthetic")), order=["doc_id"])
    return union.select("code_hash", "origin")


@case("set_05_dedup_audit", "SELECT CAST(count(*) AS BIGINT) AS before_dedup, CAST(count(DISTINCT text) AS BIGINT) AS after_dedup FROM documents")
def set_05(spark, sf):
    return dedup.dedup_audit(v.documents(spark, sf).withColumn("code_hash", n.content_key(F.col("raw_code"))))


@case("set_06_field_sets", """SELECT event_id, CASE event_type WHEN 'click' THEN 'unknown_metric' ELSE '' END AS unexpected,
  array_to_string(list_sort(list_filter(['lines_of_code', 'cyclomatic_complexity', 'nesting_depth', 'dependency_count', 'deprecated_functions', 'unsafe_patterns',
    'security_hotspots', 'test_coverage', 'recent_commits', 'past_vulnerabilities'],
    lambda f: NOT (user_id % 2 = 0 AND f IN ('lines_of_code', 'test_coverage')) AND NOT (user_id % 2 = 1 AND f = 'nesting_depth'))), ',') AS missing FROM events""")
def set_06(spark, sf):
    names = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("lines_of_code"), F.lit("test_coverage"))).otherwise(F.array(F.lit("nesting_depth")))
    keys = F.when(F.col("event_type") == "click", F.concat(names, F.array(F.lit("unknown_metric")))).otherwise(names)
    missing, unexpected = validation.field_sets(keys)
    return v.table(spark, sf, "events").select("event_id", F.array_join(missing, ",").alias("missing"), F.array_join(unexpected, ",").alias("unexpected"))


RULE_ROWS = ", ".join(
    f"({v.q(family)}, {order}, {v.q(name)}, {v.q(pattern)}, {v.q(cwe)}, {v.q(rules.MITIGATIONS[family])})"
    for family, (cwe, patterns) in fixed.CWE_RULES.items() for order, (name, pattern, _) in enumerate(patterns, 1))
RULES = f"rules(rule_family, rule_order, rule_name, pattern, cwe_id, mitigation) AS (VALUES {RULE_ROWS})"


@case("jn_01_match_rules", f"""WITH {v.CORPUS}, {RULES} SELECT doc_id, rule_family, CAST(rule_order AS INTEGER) AS rule_order, rule_name
FROM corpus JOIN rules ON regexp_matches(raw_code, pattern)""")
def jn_01(spark, sf):
    return rules.match_rules(v.corpus(spark, sf)).drop("finding")


@case("jn_02_attach_weakness", f"""WITH {v.CORPUS}, {RULES} SELECT DISTINCT doc_id, rule_family, cwe_id, mitigation FROM corpus JOIN rules ON regexp_matches(raw_code, pattern)""")
def jn_02(spark, sf):
    return rules.attach_weakness(rules.match_families(v.corpus(spark, sf))).select("doc_id", "rule_family", "cwe_id", "mitigation")


SIGNAL_ROWS = ", ".join(f"({v.q(name)}, {v.q(p)})" for name, p, _ in fixed.DANGEROUS)


@case("jn_03_attach_remediation", f"""WITH {v.CORPUS}, f AS (
  SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'buffer_overflow' WHEN 1 THEN 'injection' ELSE source END AS pattern_name FROM corpus)
SELECT doc_id, pattern_name, CASE pattern_name WHEN 'buffer_overflow' THEN {v.q(rules.REMEDIATION['buffer_overflow'])} WHEN 'injection' THEN {v.q(rules.REMEDIATION['injection'])}
  ELSE {v.q(rules.REMEDIATION_DEFAULT)} END AS remediation FROM f""")
def jn_03(spark, sf):
    d = F.col("doc_id")
    name = F.when(d % 3 == 0, F.lit("buffer_overflow")).when(d % 3 == 1, F.lit("injection")).otherwise(F.col("source"))
    return rules.attach_remediation(v.documents(spark, sf).select("doc_id", name.alias("pattern_name")))


@case("jn_04_restrict_to", f"WITH {v.DOCUMENTS} SELECT doc_id, path FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def jn_04(spark, sf):
    wanted = v.labelled(spark, sf).filter("quality = 1").select("path")
    return dedup.restrict_to(v.documents(spark, sf), wanted.unionByName(wanted)).select("doc_id", "path")


@case("jn_05_with_labels", f"WITH {v.LABELLED} SELECT doc_id, probability, is_vulnerable, language, source FROM labelled")
def jn_05(spark, sf):
    predictions = v.documents(spark, sf).select("doc_id", v.probability().alias("probability"))
    docs = v.documents(spark, sf).select("doc_id", "language", "source")
    truth = v.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable")).join(docs, "doc_id")
    return dedup.with_labels(predictions, truth).select("doc_id", "probability", "is_vulnerable", "language", "source")


SIGNAL_COEFFICIENTS = [((i * 37) % 11 - 5) / 4.0 for i in range(len(fixed.DANGEROUS))]
SIGNAL_SQL = ", ".join(
    f"({v.q(name)}, {v.q(p)}, {c}::DOUBLE)" for (name, p, _), c in zip(fixed.DANGEROUS, SIGNAL_COEFFICIENTS))


@case("jn_06_weighted_terms", f"""WITH {v.CORPUS}, s(term, pattern, coefficient) AS (VALUES {SIGNAL_SQL})
SELECT doc_id, term, weight, weight * coefficient AS contribution FROM (
  SELECT doc_id, term, coefficient, CAST(len(regexp_extract_all(raw_code, pattern)) AS DOUBLE) AS weight FROM corpus JOIN s ON regexp_matches(raw_code, pattern))""")
def jn_06(spark, sf):
    counted = features.dangerous_counts(v.corpus(spark, sf).select("doc_id", "raw_code"))
    terms = F.array(*[F.struct(F.lit(p[0]).alias("term"), F.col(f"dangerous_{p[0]}").cast("double").alias("weight")) for p in fixed.DANGEROUS])
    long = counted.select("doc_id", F.inline(F.filter(terms, lambda t: t["weight"] > 0)))
    table = spark.createDataFrame([(p[0], c) for p, c in zip(fixed.DANGEROUS, SIGNAL_COEFFICIENTS)], "term string, coefficient double")
    return dedup.weighted_terms(long, table).select("doc_id", "term", "weight", "contribution")
