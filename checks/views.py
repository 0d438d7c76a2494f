"""Inputs that the checked queries share: the driver tables seen as a code corpus.

Each view exists twice, as a DataFrame and as a SQL common table expression, built from the same
snippet and spelling lists. Every view keeps all rows and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.fixed_values import SPACE_CHARACTERS

# One of these is appended to each document, so that every rule and pattern has hits and misses.
SNIPPETS = (
    "int total(int a, int b) {\n    return a + b;\n}",
    "#include <string.h>\nvoid f(char *d, char *s) {\n    strcpy(d, s);\n    strcat(d, s);\n}",
    "#include <stdio.h>\nint main(int argc, char **argv) {\n  char b[8];\n  gets(b);\n  printf(b);\n  sprintf(b, \"%s\", argv[1]);\n}",
    "import os\ndef run(cmd):\n    os.system(cmd)\n    return eval(cmd)",
    "String q = \"SELECT name FROM users WHERE id = \" + id;\nstmt.execute(q);",
    "const q = 'SELECT a FROM t WHERE b = ' + x;\nlet z = `SELECT a FROM t WHERE b = ${x}`;",
    "element.innerHTML = input;\ndocument.write(input);\nres.send(`<p>${input}</p>`);",
    "public class Load {\n  @Override\n  Object get(ObjectInputStream s) { return s.readObject(); }\n}",
    "Process p = Runtime.getRuntime().exec(cmd);\nSystem.out.println(p);",
    "FILE *f = popen(cmd, \"r\");\nsqlite3_exec(db, sql, 0, 0, 0);\nread(fd, buf, 10);",
    "import pickle\nimport yaml\nfrom os import path\ndata = pickle.loads(blob)\ncfg = yaml.load(text)",
    "subprocess.run(cmd, shell=True)\nsubprocess.call(cmd, shell = False)\nexec(code)",
    "<?php\n$name = $_GET['n'];\necho $name;\n$x = $_POST['y']; htmlspecialchars($x);",
    "package main\nimport (\n\t\"fmt\"\n)\nfunc main() {\n\tfmt.Println(1)\n}",
    "def go(x)\n  require 'json'\n  puts x\nend",
    "std::cout << x; std::cin >> y;\nnamespace app { template <class T> T id(T t) { return t; } }",
    "char *p = (char *) malloc(10);\nif (p == NULL) { free(p); }\nint v = (int) rand(); MD5(p); memcpy(p, q, 4);",
    "// a comment\n/* block\n * more\n */\n# note\nfor (i = 0; i < n; i++) { while (a[3] && b) { do { x->y = &z; } while (0); } }",
    "password = 'hunter2-long'\nAPI_KEY = \"abcdef123\"\ntoken: admin hardcoded secret",
    "cursor.execute(\"SELECT 1 WHERE a = %s\", (a,))\nif validate(a): sanitize(a); escape(b)",
    "INSERT INTO t VALUES (1);\nDELETE FROM t;\nUPDATE t SET a = 1;\nprintf(\"%d\", var); printf(fmt, var);",
    "strncpy(d, s, sizeof(d)); snprintf(d, 4, f); fgets(b, 4, f);\nif (len > 3 && ptr != nullptr) { scanf(\"%d\", &v); getenv(\"X\"); }",
    "function load(a) {\n      const b = a;\n      console.log(b);\n      return new Thing(b);\n}",
    "using System;\n  import java.util.List;\n#include <vector>\nrequire('x');\ndelete[] p; delete q; SHA1(x); srand(1);",
    "print(1) if x else 0\n\n\n\t\tint main(void) { syslog(1, var); fprintf(f, var); }\n404 page Not Found",
    "plain words only, nothing that looks like code",
)
DIRS = ("src/core", "lib/node_modules/x", "app/web", "examples/demo", "pkg/build/out", "data/raw", "engine")
SUFFIXES = (".c", ".H", ".cpp", ".java", ".py", ".ts", ".md", ".go", ".rs", ".txt", ".js", "", ".hpp")
LABEL_TEXTS = (None, "1", " TRUE ", "yes", "Vulnerable", "unsafe", "buggy", "0", "false", "No", "safe", "FIXED", "clean", "2", "maybe", "")
LANGUAGE_TEXTS = ("C++", "c/cpp", "H", "Golang", None, "py", " JS ", "ts", "Rust", "", "c_cpp", "html", "CC", "JavaScript", "c", "ruby", "Java 8", "hpp")
MESSY_TAILS = (
    "\r\n// VULNERABLE: x\t\ty",
    "\r# safe  note\r/*  Vulnerable */ z",
    "\n\n\n\n\n\nint  x; /* Safe */",
    " vulnerable :  tail \n\n ",
    " end safe: thing; unsafe: kept",
    "\n   \x0b\n   x \x1c y\x85 z",
)


# --- Spark side -------------------------------------------------------------------------------
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: tuple, index: Column) -> Column:
    """Element of a fixed list, by an index that wraps around."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents under the corpus column names."""
    doc = F.col("doc_id")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("raw_code"),
        F.col("lang").alias("language"),
        "source",
        F.concat(pick(DIRS, doc), F.lit("/file"), doc.cast("string"), pick(SUFFIXES, doc)).alias("path"),
        F.when(doc % 2 == 1, F.col("source")).otherwise(F.lit("")).alias("group_id"),
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a code snippet behind the text."""
    code = F.concat("raw_code", F.lit("\n"), pick(SNIPPETS, F.col("doc_id")))
    return documents(spark, sf).withColumn("raw_code", code)


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with mixed line ends, label leaks, tabs and blank runs."""
    kind = F.col("doc_id") % 6
    body = F.when(kind == 0, F.replace("raw_code", F.lit("\n"), F.lit("\r\n"))).when(
        kind == 1, F.replace("raw_code", F.lit("\n"), F.lit("\r"))
    ).when(kind == 3, F.concat(F.lit("  \t"), "raw_code")).otherwise(F.col("raw_code"))
    return documents(spark, sf).withColumn("raw_code", F.concat(body, pick(MESSY_TAILS, F.col("doc_id"))))


def probability(key: str = "doc_id") -> Column:
    return ((F.col(key) * 7919) % 1000) / 1000.0


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a closed-form score and its decision at 0.5."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("is_vulnerable"), "quality")
    joined = documents(spark, sf).join(labels, "doc_id").withColumn("probability", probability())
    return joined.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus with a closed-form score."""
    return corpus(spark, sf).withColumn("probability", probability())


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Module metrics from line items, as text, with some invalid spellings."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    base = table(spark, sf, "lineitem")
    return base.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.when(key % 101 == 0, F.lit("0")).when(key % 103 == 0, F.lit("true")).when(key % 107 == 0, F.lit("NaN")).otherwise(
            (F.col("l_partkey") + 1).cast("string")).alias("lines_of_code"),
        F.when(key % 109 == 0, F.lit("3.5")).otherwise((F.col("l_quantity").cast("bigint") % 20).cast("string")).alias("cyclomatic_complexity"),
        (F.col("l_linenumber") % 5).cast("string").alias("nesting_depth"),
        (F.col("l_suppkey") % 40).cast("string").alias("dependency_count"),
        (F.col("l_partkey") % 3).cast("string").alias("deprecated_functions"),
        F.when(key % 113 == 0, F.lit("-1")).otherwise((F.col("l_suppkey") % 4).cast("string")).alias("unsafe_patterns"),
        (F.col("l_orderkey") % 3).cast("string").alias("security_hotspots"),
        ((F.col("l_orderkey") * 13 + F.col("l_linenumber")) % 105).cast("string").alias("test_coverage"),
        (F.col("l_orderkey") % 50).cast("string").alias("recent_commits"),
        F.when(key % 127 == 0, F.lit(None).cast("string")).otherwise((F.col("l_partkey") % 6).cast("string")).alias("past_vulnerabilities"),
    )


# --- SQL side ---------------------------------------------------------------------------------
def q(text: str | None) -> str:
    """SQL string literal."""
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def sql_pick(values: tuple, index: str) -> str:
    return f"list_extract([{', '.join(q(v) for v in values)}], 1 + CAST(({index}) % {len(values)} AS INTEGER))"


def sql_strip(text: str) -> str:
    return f"trim({text}, {q(SPACE_CHARACTERS)})"


def re2(pattern: str) -> str:
    """A catalogue pattern in the oracle's regex dialect."""
    return q(pattern)


def sql_count(text: str, pattern: str, ignore_case: bool = False) -> str:
    flag = "(?i)" if ignore_case and not pattern.startswith("(?i)") else ""
    return f"CAST(len(regexp_extract_all({text}, {re2(flag + pattern)})) AS BIGINT)"


def sql_hit(text: str, pattern: str, ignore_case: bool = False) -> str:
    flag = "(?i)" if ignore_case and not pattern.startswith("(?i)") else ""
    return f"regexp_matches({text}, {re2(flag + pattern)})"


def sql_lines(code: str) -> str:
    breaks = r"'\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'"
    return f"CAST(len(list_filter(regexp_split_to_array({code}, {breaks}), lambda x: {sql_strip('x')} <> '')) AS BIGINT)"


DOCUMENTS = f"""docs AS (
  SELECT doc_id, text AS raw_code, lang AS language, source,
         {sql_pick(DIRS, 'doc_id')} || '/file' || doc_id || {sql_pick(SUFFIXES, 'doc_id')} AS path,
         CASE WHEN doc_id % 2 = 1 THEN source ELSE '' END AS group_id
  FROM documents)"""
CORPUS = f"""{DOCUMENTS},
corpus AS (
  SELECT doc_id, raw_code || chr(10) || {sql_pick(SNIPPETS, 'doc_id')} AS raw_code, language, source, path, group_id,
         ((doc_id * 7919) % 1000) / 1000.0::DOUBLE AS probability
  FROM docs)"""
MESSY = f"""{DOCUMENTS},
messy AS (
  SELECT doc_id, CASE doc_id % 6
           WHEN 0 THEN replace(raw_code, chr(10), chr(13) || chr(10))
           WHEN 1 THEN replace(raw_code, chr(10), chr(13))
           WHEN 3 THEN '  ' || chr(9) || raw_code ELSE raw_code END || {sql_pick(MESSY_TAILS, 'doc_id')} AS raw_code,
         language, source, path, group_id
  FROM docs)"""
LABELLED = f"""{DOCUMENTS},
labelled AS (
  SELECT d.*, l.toxic AS is_vulnerable, l.quality, ((d.doc_id * 7919) % 1000) / 1000.0::DOUBLE AS probability,
         CASE WHEN ((d.doc_id * 7919) % 1000) / 1000.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM docs d JOIN labels l USING (doc_id))"""
METRICS = """metrics AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN k % 101 = 0 THEN '0' WHEN k % 103 = 0 THEN 'true' WHEN k % 107 = 0 THEN 'NaN' ELSE CAST(l_partkey + 1 AS VARCHAR) END AS lines_of_code,
    CASE WHEN k % 109 = 0 THEN '3.5' ELSE CAST(CAST(l_quantity AS BIGINT) % 20 AS VARCHAR) END AS cyclomatic_complexity,
    CAST(l_linenumber % 5 AS VARCHAR) AS nesting_depth, CAST(l_suppkey % 40 AS VARCHAR) AS dependency_count,
    CAST(l_partkey % 3 AS VARCHAR) AS deprecated_functions,
    CASE WHEN k % 113 = 0 THEN '-1' ELSE CAST(l_suppkey % 4 AS VARCHAR) END AS unsafe_patterns,
    CAST(l_orderkey % 3 AS VARCHAR) AS security_hotspots,
    CAST((l_orderkey * 13 + l_linenumber) % 105 AS VARCHAR) AS test_coverage,
    CAST(l_orderkey % 50 AS VARCHAR) AS recent_commits,
    CASE WHEN k % 127 = 0 THEN NULL ELSE CAST(l_partkey % 6 AS VARCHAR) END AS past_vulnerabilities
  FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem))"""


def sql_clean(code: str) -> str:
    """Text cleaning as nested SQL calls."""
    text = f"replace(replace({code}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    text = rf"regexp_replace({text}, '(?im)(//|#|/\*)\s*(vulnerable|safe)\s*:?', '\1 ', 'g')"
    text = rf"regexp_replace({text}, '(?i)\b(vulnerable|safe)\s*:\s*', '', 'g')"
    text = rf"regexp_replace({text}, '[ \t]+', ' ', 'g')"
    text = rf"regexp_replace({text}, '\n{{4,}}', repeat(chr(10), 3), 'g')"
    return sql_strip(text)


CLEAN = f"""{MESSY},
prepared AS (
  SELECT m.doc_id, {sql_clean('m.raw_code')} AS raw_code, m.language, m.source, m.path, m.group_id, l.toxic AS is_vulnerable
  FROM messy m LEFT JOIN labels l USING (doc_id)),
clean AS (
  SELECT *, sha256(raw_code) AS code_hash, CAST(length(raw_code) AS BIGINT) AS code_length
  FROM prepared WHERE length(raw_code) BETWEEN 30 AND 200000 AND is_vulnerable IN (0, 1))"""
