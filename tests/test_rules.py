import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.functions import patterns
from riskloom.operators import features, rules, validation
from riskloom.plans.scan import scan, scan_changes

# Own snippets with the shapes of the survey's fixture table, and the (CWE, pattern number) they must hit.
GOLDEN = {
    "strcpy(a, b); gets(c); printf(d);": [("CWE-120", 1), ("CWE-120", 3), ("CWE-134", 1)],
    'q = "SELECT a FROM t WHERE b = \'" + c; sqlite3_exec(db, q);': [("CWE-89", 1), ("CWE-89", 4)],
    "system(cmd);": [("CWE-78", 1)],
    "printf( text ) ;": [("CWE-134", 1)],
    "ObjectInputStream in = open(); in.readObject();": [("CWE-502", 1), ("CWE-502", 2)],
    "res.send(`<p>${name}</p>`)": [("CWE-79", 3)],
    "db.query(`SELECT a FROM t WHERE b = ${c}`)": [("CWE-89", 3)],
    "int add(int a, int b) { return a + b; }": [],
    "mystrcpy(a, b); printf(\"%d\", x);": [],
}


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([(i, code) for i, code in enumerate(GOLDEN)], "doc_id long, raw_code string")


def test_golden_hits(golden):
    hits = rules.attach_weakness(rules.match_rules(golden)).select("doc_id", "cwe_id", "rule_order").collect()
    for i, expected in enumerate(GOLDEN.values()):
        assert sorted((h.cwe_id, h.rule_order) for h in hits if h.doc_id == i) == sorted(expected)


def test_one_type_per_rule_one_cwe_per_family(golden):
    for i, row in enumerate(rules.code_findings(golden).orderBy("doc_id").collect()):
        expected = list(GOLDEN.values())[i]
        assert len(row.vulnerability_types) == len(expected)
        assert row.cwe_ids == list(dict.fromkeys(cwe for cwe, _ in expected))
        assert len(row.recommendations) == len(row.cwe_ids)


def test_decision(golden):
    rated = rules.code_findings(golden).withColumn("probability", F.lit(0.82))
    rows = rules.decide(rated).orderBy("doc_id").collect()
    assert {r.risk_level for r in rows} == {"HIGH"} and all(r.is_vulnerable for r in rows)
    assert rows[7].cwe_ids == ["CWE-Unknown"] and len(rows[7].vulnerability_types) == 1
    low = rules.decide(rated.withColumn("probability", F.lit(0.1))).orderBy("doc_id").collect()
    assert not any(r.is_vulnerable for r in low) and low[7].cwe_ids == [] and low[0].cwe_ids == ["CWE-120", "CWE-134"]


def test_change_scan(spark, golden):
    files = golden.withColumns({"path": F.concat(F.lit("src/f"), "doc_id", F.lit(".c")), "probability": F.lit(0.3)})
    changed = spark.createDataFrame([("src/f0.c",), ("src/f7.c",), ("src/none.c",)], "path string")
    rows = {r.path: r for r in scan_changes(files, changed).collect()}
    assert {p: r.status for p, r in rows.items()} == {"src/f0.c": "VULNERABLE", "src/f7.c": "SAFE"}
    assert rows["src/f0.c"].risk_level == "LOW" and rows["src/f0.c"].features.dangerous_call_count == 1
    assert scan(files).count() == len(GOLDEN)


def test_rule_table_matches_catalogue(spark, golden):
    table = rules.catalogue_frame(spark).select(F.concat_ws(":", "rule_family", "rule_order").alias("rule_id"), "pattern")
    by_table = {tuple(r) for r in rules.match_rule_table(golden, table, "raw_code", ["doc_id"]).collect()}
    direct = rules.match_rules(golden).select("doc_id", F.concat_ws(":", "rule_family", "rule_order")).collect()
    assert by_table == {tuple(r) for r in direct}


VALID = dict(lines_of_code=100, cyclomatic_complexity=5, nesting_depth=2, dependency_count=3, deprecated_functions=0, unsafe_patterns=1,
             security_hotspots=2, test_coverage=80.0, recent_commits=4, past_vulnerabilities=0)


@pytest.mark.parametrize("change, expected", [
    ({}, []), ({"lines_of_code": -1}, ["lines_of_code: negative"]), ({"test_coverage": 120.0}, ["test_coverage: above 100"]),
    ({"lines_of_code": "abc"}, ["lines_of_code: not numeric"]), ({"lines_of_code": "true"}, ["lines_of_code: not numeric"]),
    ({"lines_of_code": "NaN"}, ["lines_of_code: not finite"]), ({"lines_of_code": "inf"}, ["lines_of_code: not finite"]),
    ({"lines_of_code": 0}, ["lines_of_code: zero"]), ({"nesting_depth": "2.5"}, ["nesting_depth: not an integer"]),
])
def test_metric_validation(spark, change, expected):
    row = {k: str(v) for k, v in {**VALID, **change}.items()}
    df = spark.createDataFrame([tuple(row[k] for k in fixed.METRIC_FIELDS)], ", ".join(f"{k} string" for k in fixed.METRIC_FIELDS))
    assert validation.validate_metrics(df).first().violations == expected
    assert validation.validate_metrics(df, strict=True).count() == (0 if expected else 1)


def test_metric_rules(spark):
    other = dict(lines_of_code=2200, cyclomatic_complexity=39, nesting_depth=10, dependency_count=34, deprecated_functions=7, unsafe_patterns=10,
                 security_hotspots=15, test_coverage=18.5, recent_commits=65, past_vulnerabilities=5)
    df = spark.createDataFrame([tuple(d[k] for k in fixed.METRIC_FIELDS) for d in (VALID, other)],
                               ", ".join(f"{k} {'double' if k == 'test_coverage' else 'long'}" for k in fixed.METRIC_FIELDS))
    rows = rules.metric_findings(df).orderBy("lines_of_code").collect()
    assert rows[0].cwe_ids == ["CWE-676", "CWE-119"]
    assert rows[1].cwe_ids == ["CWE-676", "CWE-119", "CWE-1075", "CWE-1104", "CWE-1223"]


def test_training_table_is_refused(spark):
    frame = lambda rows: spark.createDataFrame(rows, "raw_code string, is_vulnerable int")
    assert validation.training_report(frame([("a", 0), ("b", 1)])).first().verdict == "ok"
    for rows, reason in (([("a", 0)], "one class"), ([(None, 0), ("b", 1)], "null"), ([("a", 2), ("b", 1)], "outside"), ([], "empty")):
        with pytest.raises(ValueError, match=reason):
            validation.check_training(frame(rows))
    with pytest.raises(ValueError, match="missing columns"):
        validation.check_training(spark.createDataFrame([("a",)], "raw_code string"))


def test_signals_of_a_text(spark):
    code = "import os\npassword = 'secret-value'\nos.system(cmd)\nsubprocess.run(x, shell=True)\n"
    df = spark.createDataFrame([(code, "tool.py")], "raw_code string, path string")
    row = features.file_summary(df).first().features
    assert row.suspicious_patterns == ["subprocess_shell", "os_system", "hardcoded_secret"]
    assert (row.language, row.lines_of_code, row.import_count) == ("python", 4, 1)
    assert features.security_signals(df).first().net_risk == 3
    assert df.select(n.detect_language(F.col("raw_code"))).first()[0] == "python"


@pytest.mark.parametrize("pattern, expected", [
    (r"\bstrcpy\s*\(", [["strcpy", "("]]), (r"abc?def", [["ab", "def"]]), (r"ab+cd", [["ab", "cd"]]), (r"x{0,3}word", [["word"]]), (r"(?:opt)?exec", [["exec"]]),
    (r"(?i)SELECT|insert", [["SELECT"], ["insert"]]), (r"a[\]bc]d(e|f)g", [["a", "d", "g"]]), (r"a\.b\x41cd", [["a.b", "cd"]]), (r"\p{L}+tail", [["tail"]]), (r"(open", None), (r"\Qa|b\E", None),
    (r"wo*rd{2}s", [["w", "r", "s"]]), (r"a(b|c)*?d", [["a", "d"]]), (r"[[a-z]&&[^b]]+end", [["end"]]), (r"[]x]y", [["y"]]), ("", [[]]),
])
def test_runs_that_a_match_must_hold(pattern, expected):
    assert patterns.literal_runs(pattern) == expected


def test_twenty_thousand_rules_in_one_pass(spark, monkeypatch):
    words = [f"fn{i * 7919 % 100_003:06d}" for i in range(20_000)]
    forms = [r"\b{}\s*\(", "(?i){}", "{}|other_{}x", r"[a-z]{{0,3}}{}\d?", "(?:{})", "{}+=", "é{}é"]
    table = [(i, forms[i % len(forms)].format(*[w] * 2)) for i, w in enumerate(words)] + [(20_000, None), (20_001, "."), (20_002, "x?"), (5, "second of the id")]
    docs = [(i % 190, " ".join(f"{words[(i * 97 + k * 31) % 20_000]}{('(', ' (', '+=', 'é', ' ')[k % 5]}" + (words[k].upper() if k == i % 9 else "") for k in range(i % 12))) for i in range(200)] + [(500, None), (501, "")]
    df, rules_table = spark.createDataFrame(docs, "doc_id int, raw_code string"), spark.createDataFrame(table, "rule_id int, pattern string").repartition(4)
    got = Counter(tuple(r) for r in rules.match_rule_table(df, rules_table, "raw_code", ["doc_id"]).collect())
    expected = Counter()
    for number, pattern in table:
        if pattern is not None:
            test = re.compile(pattern)
            expected.update((doc, number) for doc, text in docs if text is not None and test.search(text))
    assert got == expected and len(expected) > 1000
    assert df.select("raw_code").count() == 202
    monkeypatch.setattr(rules, "RULES_IN_ONE_PASS", 3000)
    assert Counter(tuple(r) for r in rules.match_rule_table(df, rules_table, "raw_code", ["doc_id"]).collect()) == expected
    assert rules.match_rule_table(df, rules_table.limit(0), "raw_code", ["doc_id"]).collect() == []


def test_rule_table_reads_texts_once_and_does_not_move_them(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    table = spark.createDataFrame([(i, rf"\bword{i}\b") for i in range(3000)], "rule_id int, pattern string")
    tree = rules.match_rule_table(docs, table, "text", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert tree.count("documents.parquet") == 1 and "hashpartitioning" not in tree and "BroadcastHashJoin" in tree
