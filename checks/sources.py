"""Sources and sinks: whole tables are written in each raw format by Spark, then read back."""

import gzip
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks import text as text_checks
from checks import views as v
from riskloom import fixed_values as fixed
from riskloom import schemas
from riskloom.functions import normalise as n
from riskloom.operators import dedup, modelling, profile, validation, vectorise
from riskloom.plans import prepare
from riskloom.session import shared_dir
from riskloom.sources import files, nested, sinks, tables, text_lines

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _write_lines(df, *objects):
    """Write one JSON line per object; null objects give no line."""
    path = shared_dir(df.sparkSession, "lines")
    lines = F.explode(F.array_compact(F.array(*objects)))
    df.select(lines.alias("value")).write.text(path)
    return path


def _json(**fields):
    return F.to_json(F.struct(*[col.alias(name) for name, col in fields.items()]))


def doc():
    return F.col("doc_id")


def text():
    return F.col("raw_code")


LABEL = "CAST((doc_id // 4) % 2 AS INTEGER)"  # of the documents' lines


def _label_text(value):
    """A label as JSON writes it: a whole number, a boolean, a decimal or a text, in turn."""
    truth = F.when(value == 1, F.lit("true")).otherwise(F.lit("false"))
    whole = value.cast("string")
    form = F.floor(doc() / 8) % 4
    return F.when(form == 0, whole).when(form == 1, truth).when(form == 2, F.concat(whole, F.lit(".0"))).otherwise(F.concat(F.lit('"'), whole, F.lit('"')))


def _labelled(record, value):
    """A record with its label written in place of a mark."""
    return F.replace(record, F.lit('"<label>"'), _label_text(value))


def _doc_lines(spark, sf):
    """Documents as JSON lines with changing field names and label forms, blank lines and broken lines between them."""
    docs = v.documents(spark, sf)
    mark = F.lit("<label>")
    record = (
        F.when(doc() % 4 == 0, _json(func=text(), target=mark, id=doc().cast("string"), project=F.col("source"), commit_id=F.concat(F.lit("c"), doc())))
        .when(doc() % 4 == 1, _json(functionSource=text(), label=mark, id=doc().cast("string"), func=F.lit("")))
        .when(doc() % 4 == 2, _json(code=text(), target=mark, label=F.lit(0), id=doc().cast("string")))
        .otherwise(_json(raw_code=text(), is_vulnerable=mark, id=doc().cast("string"), owasp_category=F.col("source"), language=F.col("language")))
    )
    record = _labelled(record, F.floor(doc() / 4) % 2)
    return _write_lines(docs, record, F.when(doc() % 10 == 7, F.lit("   ")), F.when(doc() % 10 == 3, F.concat(F.lit('{"func": "broken '), doc().cast("string"))))


@case("src_01_json_lines", """SELECT id, n_lines, broken FROM (
  SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS h, 1 AS n_lines, 0 AS broken FROM documents
  UNION ALL SELECT NULL, NULL, CAST(count(*) AS INTEGER), CAST(count(*) AS INTEGER) FROM documents WHERE doc_id % 10 = 3)""")
def src_01(spark, sf):
    read = text_lines.json_lines(spark, _doc_lines(spark, sf))
    counted = read.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("n_lines"), F.count_if(F.col("_corrupt").isNotNull()).cast("int").alias("broken"))
    return counted


@case("src_02_func_target", f"""SELECT sha256(text) AS code_hash, {LABEL} AS is_vulnerable, CAST(doc_id AS VARCHAR) AS id, source AS project, 'c' || doc_id AS commit_id
FROM documents WHERE doc_id % 4 = 0 AND text <> ''""")
def src_02(spark, sf):
    rows = text_lines.func_target(text_lines.json_lines(spark, _doc_lines(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable", "id", "project", "commit_id")


@case("src_03_function_source", f"""SELECT sha256(text) AS code_hash, {LABEL} AS is_vulnerable, CAST(doc_id AS VARCHAR) AS id
FROM documents WHERE doc_id % 4 <> 3 AND length(text) > 20""")
def src_03(spark, sf):
    rows = text_lines.function_source(text_lines.json_lines(spark, _doc_lines(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable", "id")


@case("src_04_code_first", f"""SELECT sha256(text) AS code_hash, {LABEL} AS is_vulnerable
FROM documents WHERE doc_id % 4 <> 3 AND length(text) > 20""")
def src_04(spark, sf):
    rows = text_lines.code_first(text_lines.json_lines(spark, _doc_lines(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable")


@case("src_05_generic_fields", f"""SELECT sha256(text) AS code_hash, {LABEL} AS is_vulnerable
FROM documents WHERE length(text) > 10""")
def src_05(spark, sf):
    rows = text_lines.generic(text_lines.json_lines(spark, _doc_lines(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable")


def _pair_arrays(spark, sf):
    """Many JSON array files of at most 50 pairs each."""
    pair = F.struct(
        F.when(doc() % 5 != 0, text()).alias("func_before"), F.when(doc() % 7 != 0, F.concat(text(), F.lit("\nfixed"))).alias("func"))
    grouped = v.documents(spark, sf).groupBy(F.floor(doc() / 50)).agg(F.collect_list(pair).alias("items"))
    path = shared_dir(spark, "arrays")
    grouped.select(F.to_json("items").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@case("src_06_json_array", """SELECT CASE WHEN doc_id % 5 <> 0 THEN sha256(text) END AS before_hash, CASE WHEN doc_id % 7 <> 0 THEN sha256(text || chr(10) || 'fixed') END AS after_hash FROM documents""")
def src_06(spark, sf):
    rows = nested.json_array(spark, _pair_arrays(spark, sf))
    return rows.select(n.content_key(F.col("func_before")).alias("before_hash"), n.content_key(F.col("func")).alias("after_hash"))


@case("src_07_pairs", """SELECT sha256(text) AS code_hash, 1 AS is_vulnerable FROM documents WHERE doc_id % 5 <> 0 AND text <> ''
UNION ALL SELECT sha256(text || chr(10) || 'fixed'), 0 FROM documents WHERE doc_id % 7 <> 0""")
def src_07(spark, sf):
    lines = shared_dir(spark, "pairs")
    nested.array_to_lines(spark, _pair_arrays(spark, sf), lines)
    rows = nested.from_pairs(spark.read.schema(schemas.PAIRED).json(lines))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable")


def _cve_trees(spark, sf):
    """CVE trees of up to twenty documents: five per commit, each a file with one function list per kind."""
    docs = v.documents(spark, sf)
    changed = F.array(F.struct(
        F.when(doc() % 3 != 0, F.concat(F.lit("fn"), doc())).alias("func_name"), F.when(doc() % 2 == 0, text()).alias("func_before"), F.when(doc() % 2 == 1, text()).alias("before"),
        F.when(doc() % 4 == 0, F.concat(text(), F.lit("\nafter"))).alias("func_after"), F.when(doc() % 4 == 1, F.concat(text(), F.lit("\nplain"))).alias("func")))
    others = F.array(F.struct(F.when(doc() % 6 != 0, F.concat(F.lit("other\n"), text())).alias("func")), F.struct(F.lit("  ").alias("func")))
    item = F.struct(F.col("language"), F.col("path").alias("file_path"), changed.alias("vulnerable_functions"), others.alias("non_vulnerable_functions"))
    commits = docs.groupBy(F.floor(doc() / 20).alias("cve"), F.floor(doc() / 5).alias("commit")).agg(F.collect_list(item).alias("files"))
    commit = F.struct(
        F.when(F.col("commit") % 2 == 0, F.concat(F.lit("h"), "commit")).alias("commit_hash"),
        F.when(F.col("commit") % 3 == 0, F.concat(F.lit("i"), "commit")).alias("id"), F.col("files"))
    trees = commits.groupBy("cve").agg(F.collect_list(commit).alias("commits"))
    path = shared_dir(spark, "trees")
    trees.select(F.concat(F.lit("CVE-"), "cve").alias("cve_id"), "commits").write.json(path)
    return path


@case("src_08_cve_tree", f"""WITH {v.DOCUMENTS}, t AS (
  SELECT *, 'CVE-' || (doc_id // 20) || ':' || CASE WHEN (doc_id // 5) % 2 = 0 THEN 'h' || (doc_id // 5) WHEN (doc_id // 5) % 3 = 0 THEN 'i' || (doc_id // 5) ELSE 'CVE-' || (doc_id // 20) END
         || ':' || path || ':' AS g, CASE WHEN doc_id % 3 <> 0 THEN 'fn' || doc_id ELSE '0' END AS f FROM docs)
SELECT sha256(raw_code) AS code_hash, 1 AS is_vulnerable, g || f AS group_id, language FROM t WHERE {v.sql_strip('raw_code')} <> ''
UNION ALL SELECT sha256(raw_code || chr(10) || 'after'), 0, g || f, language FROM t WHERE doc_id % 4 = 0
UNION ALL SELECT sha256(raw_code || chr(10) || 'plain'), 0, g || f, language FROM t WHERE doc_id % 4 = 1
UNION ALL SELECT sha256('other' || chr(10) || raw_code), 0, g || 'non_vul:0', language FROM t WHERE doc_id % 6 <> 0""")
def src_08(spark, sf):
    rows = nested.from_cve_tree(spark.read.schema(schemas.CVE_TREE).json(_cve_trees(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable", "group_id", "language")


def _csv(spark, sf):
    safety = F.when(doc() % 9 == 0, F.lit(None).cast("string")).when(doc() % 3 == 0, F.lit("vulnerable")).otherwise(F.lit("safe"))
    rows = v.documents(spark, sf).select(F.when(doc() % 13 != 0, text()).alias("code"), safety.alias("safety"), "language")
    path = shared_dir(spark, "csv")
    writer = rows.write.option("header", True).option("escape", '"').option("quoteAll", False)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@case("src_09_quoted_csv", """SELECT CASE WHEN doc_id % 13 <> 0 THEN sha256(text) END AS code_hash,
  CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'vulnerable' ELSE 'safe' END AS safety, lang AS language FROM documents""")
def src_09(spark, sf):
    return tables.quoted_csv(spark, _csv(spark, sf)).select(n.content_key(F.col("code")).alias("code_hash"), "safety", "language")


@case("src_10_safety_label", """SELECT sha256(text) AS code_hash, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS is_vulnerable, lang AS language
FROM documents WHERE doc_id % 13 <> 0 AND doc_id % 9 <> 0""")
def src_10(spark, sf):
    rows = tables.safety_records(tables.quoted_csv(spark, _csv(spark, sf)))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable", "language")


@case("src_11_func_label", """SELECT sha256(text) AS code_hash, CAST(CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_vulnerable FROM documents
WHERE (doc_id % 3 IN (0, 1) OR (doc_id // 8) % 4 = 1) AND text <> ''""")
def src_11(spark, sf):
    path = _write_lines(v.documents(spark, sf), _labelled(_json(func=text(), label=F.lit("<label>")), (doc() % 3).cast("int")))
    rows = text_lines.func_label(text_lines.json_lines(spark, path))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable")


@case("src_12_passthrough", """SELECT sha256(text) AS code_hash, CAST(doc_id % 2 AS INTEGER) AS is_vulnerable, source AS owasp_category FROM documents""")
def src_12(spark, sf):
    path = _write_lines(v.documents(spark, sf), _labelled(_json(raw_code=text(), is_vulnerable=F.lit("<label>"), owasp_category=F.col("source")), (doc() % 2).cast("int")))
    rows = text_lines.passthrough(text_lines.json_lines(spark, path))
    return rows.select(n.content_key(text()).alias("code_hash"), "is_vulnerable", "owasp_category")


@case("src_13_source_tree", """SELECT sha256(text || chr(10)) AS code_hash, CAST(count(*) AS BIGINT) AS files FROM documents WHERE lang <> 'es' GROUP BY 1""")
def src_13(spark, sf):
    """One file per document; those of one language lie below an excluded directory."""
    root = shared_dir(spark, "tree")
    docs = v.documents(spark, sf)
    for folder, wanted in (("src", F.col("language") != "es"), ("build", F.col("language") == "es")):
        sinks.write_each(docs.filter(wanted).select(text()), "raw_code", f"{root}/{folder}")
    tree = files.source_tree(spark, root, (".txt",))
    return tree.groupBy(n.content_key(text()).alias("code_hash")).agg(F.count(F.lit(1)).alias("files"))


@case("src_14_changed_files", f"WITH {v.DOCUMENTS} SELECT doc_id, path FROM docs WHERE doc_id % 3 = 0 AND path NOT LIKE 'engine%'")
def src_14(spark, sf):
    docs = v.documents(spark, sf)
    line = F.when(doc() % 6 == 0, F.concat(F.lit("﻿"), "path")).otherwise(F.concat(F.lit("  "), "path", F.lit(" ")))
    listed = F.when((doc() % 3 == 0) & ~F.startswith("path", F.lit("engine")), line).otherwise(F.lit("   "))
    path = shared_dir(spark, "changed")
    docs.select(listed.alias("value")).write.text(path)
    return dedup.restrict_to(docs, files.changed_files(spark, path)).select("doc_id", "path")





def _metric_payloads(spark, sf):
    base = v.table(spark, sf, "lineitem")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    values = {name: F.col("l_partkey") % 9 for name in fixed.METRIC_FIELDS}
    values["lines_of_code"] = F.when(key % 11 != 0, F.col("l_partkey"))
    values["test_coverage"] = F.when(key % 17 != 0, (F.col("l_orderkey") % 100) / 2.0)
    values["unknown_metric"] = F.when(key % 13 == 0, F.lit(1))
    return base.select("l_orderkey", "l_linenumber", _json(**values).alias("payload"))


@case("src_15_metric_payload", """WITH k AS (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem)
SELECT l_orderkey, l_linenumber,
  array_to_string(list_filter([CASE WHEN k % 11 = 0 THEN 'lines_of_code' END, CASE WHEN k % 17 = 0 THEN 'test_coverage' END], lambda x: x IS NOT NULL), ',') AS missing_fields,
  CASE WHEN k % 13 = 0 THEN 'unknown_metric' ELSE '' END AS unexpected_fields, k % 11 <> 0 AND k % 17 <> 0 AND k % 13 <> 0 AS accepted,
  CASE WHEN k % 11 <> 0 THEN l_partkey END AS lines_of_code, CASE WHEN k % 17 <> 0 THEN (l_orderkey % 100) / 2.0::DOUBLE END AS test_coverage FROM k""")
def src_15(spark, sf):
    parsed = validation.parse_metrics(_metric_payloads(spark, sf))
    return parsed.select(
        "l_orderkey", "l_linenumber", F.array_join("missing_fields", ",").alias("missing_fields"), F.array_join("unexpected_fields", ",").alias("unexpected_fields"),
        "accepted", F.col("metrics.lines_of_code"), F.col("metrics.test_coverage"))


@case("src_16_bulk_request", """SELECT 'f' || doc_id AS filename, sha256(text) AS code_hash FROM documents WHERE doc_id % 8 <> 0""")
def src_16(spark, sf):
    item = F.struct(F.concat(F.lit("f"), doc()).alias("filename"), F.when(doc() % 8 == 0, F.lit(" \n")).otherwise(text()).alias("code"))
    requests = v.documents(spark, sf).groupBy(F.floor(doc() / 25).alias("request")).agg(F.collect_list(item).alias("files"))
    return files.request_files(requests).select("filename", n.content_key(F.col("code")).alias("code_hash"))


@case("src_17_load_health", """SELECT 'docs' AS source, CAST(count(*) + sum(CASE WHEN doc_id % 10 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS lines,
  CAST(sum(CASE WHEN doc_id % 10 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM documents""")
def src_17(spark, sf):
    paths = text_lines.readable(spark, {"docs": _doc_lines(spark, sf), "absent": "/nonexistent/folder"})
    frames = [text_lines.json_lines(spark, path).withColumn("source", F.lit(name)) for name, path in paths.items()]
    return text_lines.load_health(reduce(lambda a, b: a.unionByName(b), frames), "source")


@case("snk_01_clean_table", """SELECT source, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source""")
def snk_01(spark, sf):
    path = shared_dir(spark, "clean")
    rows = v.documents(spark, sf).withColumn("code_hash", n.content_key(text()))
    sinks.write_clean(rows, path, files_per_source=2)
    back = spark.read.parquet(path)
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"), F.sum(n.char_length(text())).alias("chars"))


@case("snk_02_report", """SELECT lang AS language, CAST(count(*) AS BIGINT) AS row_count FROM documents GROUP BY lang""")
def snk_02(spark, sf):
    path = shared_dir(spark, "report")
    sinks.write_report(v.documents(spark, sf).groupBy("language").agg(F.count(F.lit(1)).alias("row_count")), path)
    return spark.read.schema("language string, row_count long").json(path)


@case("snk_03_split_export", f"""WITH {v.LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY is_vulnerable ORDER BY sha256('42|' || doc_id)) AS rk, count(*) OVER (PARTITION BY is_vulnerable) AS n FROM labelled)
SELECT doc_id, CASE WHEN rk <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""")
def snk_03(spark, sf):
    path = shared_dir(spark, "splits")
    sinks.write_splits(v.labelled(spark, sf), path, "doc_id", 0.2)
    return spark.read.schema("doc_id long, split string").json(path)


@case("snk_04_scan_report", """WITH s AS (SELECT ((doc_id * 7919) % 1000) / 1000.0::DOUBLE AS p FROM documents)
SELECT 'corpus' AS target, CAST(count(*) AS BIGINT) AS total_files, CAST(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS vulnerable_files,
  CAST(sum(CASE WHEN p >= 0.7 THEN 1 ELSE 0 END) AS BIGINT) AS high, CAST(sum(CASE WHEN p >= 0.4 AND p < 0.7 THEN 1 ELSE 0 END) AS BIGINT) AS medium,
  CAST(sum(CASE WHEN p < 0.4 THEN 1 ELSE 0 END) AS BIGINT) AS low, CAST(count(*) AS BIGINT) AS detail_rows FROM s""")
def snk_04(spark, sf):
    from riskloom.plans.scan import scan
    path = shared_dir(spark, "scan")
    details = scan(v.scored(spark, sf)).select("path", "is_vulnerable", "risk_probability", "risk_level")
    sinks.write_scan(details, path, "corpus")
    summary = spark.read.schema("target string, total_files long, vulnerable_files long, high long, medium long, low long").json(f"{path}/summary")
    return summary.withColumn("detail_rows", spark.read.parquet(f"{path}/details").agg(F.count(F.lit(1))).scalar())


# Coefficients of a logistic model over structural and security counts, and its intercept.
SCORE_WEIGHTS = {"ast_node_count": 0.001, "ast_max_depth": -0.02, "ast_function_calls": 0.05, "ast_if_statements": 0.1, "sec_injection": 0.7, "sec_memory_mgmt": -0.3, "sec_safe_patterns": -0.4, "sec_safety_ratio": 0.9}
SCORE_BASE = -0.75
_CODE_SQL = {**text_checks.STRUCTURE_SQL, **text_checks.FAMILY_PAIRS}
MARGIN_SQL = " + ".join(f"({w}) * CAST({_CODE_SQL[name]} AS DOUBLE)" for name, w in SCORE_WEIGHTS.items())


@case("snk_05_model_roundtrip", f"""WITH {v.CORPUS} SELECT doc_id, round(1 / (1 + exp(-({SCORE_BASE} + {MARGIN_SQL}))), 9) AS probability FROM corpus""")
def snk_05(spark, sf):
    """A saved and reloaded pipeline of own and Spark stages must score every document as the closed form of its coefficients does."""
    rows = v.corpus(spark, sf)
    blocks = ("structure", "security")
    found = vectorise.SyntacticFeatures.fit(rows, 50, min_df=2, sublinear=True, blocks=blocks)
    classifier = modelling.fixed_logistic(spark, [SCORE_WEIGHTS.get(name, 0.0) for name in found.names], SCORE_BASE)
    path = shared_dir(spark, "model")
    sinks.save_model(PipelineModel([*found.model.stages, classifier]), path)
    return modelling.score(sinks.load_model(path), rows).select("doc_id", F.round("probability", 9).alias("probability"))


def _cut_archive(spark, folder, name):
    """Put a gzip file of blank lines that lacks its end among the files of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(gzip.compress(b"\n" * 5000)[:-9])
    out.close()
    return folder


def _collections(spark, sf):
    """Documents dealt out to three raw collections; labels and groups follow from the text, so that copies agree in them.

    Each collection has a gzip file that is cut off, and the arrays one that is no JSON.
    """
    docs = v.documents(spark, sf)
    size = F.length(text())
    lines = docs.filter(doc() % 3 == 0)
    record = _labelled(_json(func=text(), target=F.lit("<label>"), commit_id=F.concat(F.lit("c"), size), language=F.lit("Java")), size % 2)
    code = F.struct(F.lit("f").alias("func_name"), text().alias("func_before"), F.concat(text(), F.lit("\nafter")).alias("func_after"))
    item = F.struct(F.lit("Java").alias("language"), F.lit("p").alias("file_path"), F.array(code).alias("vulnerable_functions"))
    commit = F.struct(F.lit("h").alias("commit_hash"), F.array(item).alias("files"))
    trees = docs.filter(doc() % 3 == 1).groupBy(F.floor(doc() / 150)).agg(
        F.collect_list(F.struct(F.concat(F.lit("CVE-"), size).alias("cve_id"), F.array(commit).alias("commits"))).alias("trees"))
    arrays = shared_dir(spark, "collection")
    broken = trees.limit(1).select(F.lit('[{"cve_id": ').alias("value"))
    trees.select(F.to_json("trees").alias("value")).unionByName(broken).write.option("maxRecordsPerFile", 1).text(arrays)
    table = shared_dir(spark, "collection")
    safety = F.when(size % 2 == 1, F.lit("vulnerable")).otherwise(F.lit("safe"))
    rows = docs.filter(doc() % 3 == 2).select(text().alias("code"), safety.alias("safety"), F.lit("Java").alias("language"))
    rows.write.option("header", True).option("escape", '"').csv(table)
    found = {"codexglue": _write_lines(lines, record, F.when(doc() % 10 == 3, F.lit('{"func": '))), "megavul_java": arrays, "cvefixes_zip": table}
    for folder in found.values():
        _cut_archive(spark, folder, "zz.gz")
    return {"codexglue": found["codexglue"], "megavul_java": arrays, "absent": "/nonexistent/folder", "cvefixes_zip": table}


# A label of the JSON lines is text: decimals are none, as in the cleaner.
COLLECTED = f"""raw AS (
  SELECT 0 AS r, 'codexglue' AS source, text AS t, CASE WHEN (doc_id // 8) % 4 <> 2 THEN CAST(length(text) % 2 AS INTEGER) END AS y, 'c' || length(text) AS g FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT 1, 'megavul_java', text, 1, 'CVE-' || length(text) || ':h:p:f' FROM documents WHERE doc_id % 3 = 1
  UNION ALL SELECT 1, 'megavul_java', text || chr(10) || 'after', 0, 'CVE-' || length(text) || ':h:p:f' FROM documents WHERE doc_id % 3 = 1
  UNION ALL SELECT 2, 'cvefixes_zip', text, CAST(length(text) % 2 AS INTEGER), '' FROM documents WHERE doc_id % 3 = 2),
given AS (SELECT * FROM raw WHERE {v.sql_strip('t')} <> ''),
good AS (SELECT *, {v.sql_clean('t')} AS c FROM given),
usable AS (SELECT *, sha256(c) AS code_hash FROM good WHERE length(c) BETWEEN 30 AND 200000 AND y IN (0, 1))"""


@case("prep_clean_table", f"""WITH {COLLECTED}, first AS (SELECT code_hash, min_by({{'source': source, 'y': y, 'g': g, 'c': c}}, r) AS f FROM usable GROUP BY 1)
SELECT code_hash, f.source AS source, f.y AS is_vulnerable, f.g AS group_id, 'java' AS language, CAST(length(f.c) AS BIGINT) AS code_length, {v.sql_lines('f.c')} AS line_count FROM first""")
def prep_clean_table(spark, sf):
    """From three raw collections, one of them missing and one with a broken file, to the clean table."""
    return prepare.clean_corpus(spark, _collections(spark, sf)).table.drop("raw_code", "path")


@case("prep_clean_profile", f"""WITH {COLLECTED}, u AS (SELECT source, count(*) AS n, count_if(y = 0) AS a, count_if(y = 1) AS b FROM usable GROUP BY 1)
SELECT g.source, CAST(count(*) AS BIGINT) AS input_records, CAST(max(u.n) AS BIGINT) AS usable_records, CAST(max(u.a) AS BIGINT) AS label_0, CAST(max(u.b) AS BIGINT) AS label_1,
  CASE g.source WHEN 'codexglue' THEN (SELECT count(*) + 1 FROM documents WHERE doc_id % 3 = 0 AND doc_id % 10 = 3) WHEN 'megavul_java' THEN 2 ELSE 1 END AS errors FROM given g LEFT JOIN u USING (source) GROUP BY 1
UNION ALL SELECT 'combined', count(*), count(DISTINCT code_hash), NULL, NULL, NULL FROM usable""")
def prep_clean_profile(spark, sf):
    corpus = prepare.clean_corpus(spark, _collections(spark, sf))
    none = F.lit(None).cast("bigint")
    combined = corpus.combined.select(
        F.lit("combined").alias("source"), F.col("before_dedup").alias("input_records"), F.col("after_dedup").alias("usable_records"), none.alias("label_0"), none.alias("label_1"), none.alias("errors"))
    return corpus.sources.unionByName(combined)
