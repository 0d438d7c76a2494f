"""Features of code text."""

from pyspark.sql import functions as F

from checks import views as v
from checks.normalise import BEST8, COLS8, sql_first  # noqa: F401
from riskloom import fixed_values as fixed
from riskloom.operators import features

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _rows(spark, sf):
    return v.corpus(spark, sf).select("doc_id", "raw_code", "path")


def _without_text(df):
    return df.drop("raw_code", "path")


DANGEROUS_SQL = ", ".join(f"{v.sql_count('raw_code', p)} AS dangerous_{name}" for name, p, _ in fixed.DANGEROUS)
SANITIZER_SQL = ", ".join(f"{v.sql_count('raw_code', p)} AS sanitizer_{name}" for name, p, _ in fixed.SANITIZERS)
DANGEROUS_SUM = " + ".join(v.sql_count("raw_code", p) for _, p, _ in fixed.DANGEROUS)
SANITIZER_SUM = " + ".join(v.sql_count("raw_code", p) for _, p, _ in fixed.SANITIZERS)


@case("fea_01_dangerous_counts", f"WITH {v.CORPUS} SELECT doc_id, {DANGEROUS_SQL} FROM corpus")
def fea_01(spark, sf):
    return _without_text(features.dangerous_counts(_rows(spark, sf)))


@case("fea_02_sanitizer_counts", f"WITH {v.CORPUS} SELECT doc_id, {SANITIZER_SQL} FROM corpus")
def fea_02(spark, sf):
    return _without_text(features.sanitizer_counts(_rows(spark, sf)))


@case("fea_03_signal_totals", f"""WITH {v.CORPUS}, t AS (SELECT doc_id, {DANGEROUS_SUM} AS dangerous_total, {SANITIZER_SUM} AS sanitizer_total FROM corpus)
SELECT *, greatest(0, dangerous_total - sanitizer_total) AS net_risk FROM t""")
def fea_03(spark, sf):
    counted = features.signal_totals(features.sanitizer_counts(features.dangerous_counts(_rows(spark, sf))))
    return counted.select("doc_id", "dangerous_total", "sanitizer_total", "net_risk")


# The oracle spells Unicode white space, which the token pattern's last branch must not match.
TOKENS_SQL = r"CAST(len(regexp_extract_all(raw_code, '[A-Za-z_][A-Za-z0-9_]*|\p{Nd}+|==|!=|<=|>=|&&|\|\||[^\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')) AS BIGINT)"


@case("fea_04_token_count", f"WITH {v.CORPUS} SELECT doc_id, {TOKENS_SQL} AS token_count FROM corpus")
def fea_04(spark, sf):
    return _rows(spark, sf).select("doc_id", features.token_count(F.col("raw_code")).alias("token_count"))


IMPORTS_SQL = v.sql_count("raw_code", fixed.IMPORT_PATTERN[1])


@case("fea_05_import_count", f"WITH {v.CORPUS} SELECT doc_id, {IMPORTS_SQL} AS import_count FROM corpus")
def fea_05(spark, sf):
    return _rows(spark, sf).select("doc_id", features.import_count(F.col("raw_code")).alias("import_count"))


def sql_names(patterns):
    parts = ", ".join(f"CASE WHEN {v.sql_hit('raw_code', p)} THEN '{name}' END" for name, p, _ in patterns)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


@case("fea_06_suspicious_names", f"""WITH {v.CORPUS}, t AS (SELECT doc_id, {sql_names(fixed.DANGEROUS)} AS d, {sql_names(fixed.SANITIZERS)} AS s FROM corpus)
SELECT doc_id, array_to_string(d, ',') AS suspicious, CAST(len(d) AS BIGINT) AS suspicious_count, array_to_string(s, ',') AS sanitizers, CAST(len(s) AS BIGINT) AS sanitizer_count FROM t""")
def fea_06(spark, sf):
    text = F.col("raw_code")
    named = _rows(spark, sf).select("doc_id", features.suspicious_names(text).alias("d"), features.sanitizer_names(text).alias("s"))
    return named.select(
        "doc_id", F.array_join("d", ",").alias("suspicious"), F.size("d").cast("bigint").alias("suspicious_count"),
        F.array_join("s", ",").alias("sanitizers"), F.size("s").cast("bigint").alias("sanitizer_count"))


# Structure. ``\w`` and ``\b`` of the oracle know ASCII only, so words are spelled with classes.
W = r"[\p{L}\p{N}_]"
WORDS_SQL = rf"""CAST(len(list_filter(regexp_split_to_array(raw_code, '[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'), lambda x: x <> '')) AS BIGINT)"""
INDENT_SQL = f"""CAST(coalesce(list_max(list_transform(list_filter(string_split(raw_code, chr(10)), lambda l: {v.sql_strip('l')} <> ''),
  lambda l: length(l) - length(ltrim(l, {v.q(fixed.SPACE_CHARACTERS)})))), 0) AS BIGINT)"""
CALLS_SQL = v.sql_count("raw_code", W + r"+\s*\(")
POINTER_OPS_SQL = v.sql_count("raw_code", rf"[*&]{W}+|->")


def _bounded(words):
    """Whole words in a language without Unicode word boundaries: count them among all words."""
    listed = ", ".join(f"'{w}'" for w in words)
    return f"CAST(len(list_filter(regexp_extract_all(raw_code, '{W}+'), lambda x: x IN ({listed}))) AS BIGINT)"


LOOPS_SQL, IFS_SQL = _bounded(["for", "while", "do"]), _bounded(["if"])


@case("fea_07_file_summary", rf"""WITH {v.CORPUS}, t AS (SELECT *, lower(regexp_extract(path, '[^/](\.[^/.]+)$', 1)) AS s, {sql_names(fixed.DANGEROUS)} AS d, {sql_names(fixed.SANITIZERS)} AS g FROM corpus)
SELECT path, CASE WHEN s IN ('.c', '.h') THEN 'c' WHEN s IN ('.cc', '.cpp', '.cxx', '.hpp') THEN 'cpp'
  WHEN s = '.java' OR regexp_matches(raw_code, '\bpublic\s+class\b') THEN 'java' WHEN s = '.py' THEN 'python'
  WHEN s IN ('.js', '.ts') THEN substr(s, 2) WHEN s = '.go' THEN 'go' WHEN s = '.rs' THEN 'rust' ELSE 'unknown' END AS language,
  {v.sql_lines('raw_code')} AS lines_of_code, {TOKENS_SQL} AS token_count, {IMPORTS_SQL} AS import_count, {WORDS_SQL} AS ast_node_count, {INDENT_SQL} AS ast_max_depth,
  {CALLS_SQL} AS ast_function_calls, CAST(len(d) AS BIGINT) AS dangerous_call_count, CAST(len(g) AS BIGINT) AS sanitization_count,
  CAST(len(d) AS BIGINT) AS suspicious_pattern_count, array_to_string(d, ',') AS suspicious_patterns FROM t""")
def fea_07(spark, sf):
    rows = features.file_summary(_rows(spark, sf)).select("features.*")
    return rows.withColumn("suspicious_patterns", F.array_join("suspicious_patterns", ","))


def sql_total(patterns):
    """Sum of counts. A bare word between boundaries is counted among whole Unicode words."""
    parts = []
    for _, p, _ in patterns:
        bare = p.removeprefix("\\b").removesuffix("\\b")
        if p == f"\\b{bare}\\b" and bare.isalnum():
            parts.append(_bounded([bare.lower()]).replace("raw_code", "lower(raw_code)"))
        else:
            parts.append(v.sql_count("raw_code", p, ignore_case=True))
    return " + ".join(parts)


FAMILY_SQL = ", ".join(f"{sql_total(patterns)} AS sec_{name}" for name, patterns in fixed.FAMILIES.items())


@case("fea_08_family_counts", f"WITH {v.CORPUS} SELECT doc_id, {FAMILY_SQL} FROM corpus")
def fea_08(spark, sf):
    return _without_text(features.family_counts(_rows(spark, sf)))


@case("fea_09_safe_signals", f"""WITH {v.CORPUS}, t AS (SELECT doc_id, {sql_total(fixed.SAFE_SIGNALS)} AS sec_safe_patterns, {' + '.join(sql_total(p) for p in fixed.FAMILIES.values())} AS d FROM corpus)
SELECT doc_id, sec_safe_patterns, round(sec_safe_patterns / (d + 1)::DOUBLE, 6) AS sec_safety_ratio FROM t""")
def fea_09(spark, sf):
    rows = features.safe_signals(features.family_counts(_rows(spark, sf)))
    return rows.select("doc_id", "sec_safe_patterns", F.round("sec_safety_ratio", 6).alias("sec_safety_ratio"))


COMMENTS_SQL = f"len(list_filter(string_split(raw_code, chr(10)), lambda l: regexp_matches({v.sql_strip('l')}, '^(//|#|/\\*|\\*)')))"
BRANCHES_SQL = _bounded(["if", "else", "elif", "while", "for", "switch", "case", "catch"]) + rf" + CAST(len(regexp_extract_all(raw_code, '{W}(&&|\|\|){W}')) AS BIGINT)"


@case("fea_10_complexity", f"""WITH {v.CORPUS} SELECT doc_id, {BRANCHES_SQL} AS cyclomatic_complexity, {INDENT_SQL} AS max_indent_depth,
  round({COMMENTS_SQL} / (len(string_split(raw_code, chr(10))) + 1)::DOUBLE, 6) AS comment_ratio FROM corpus""")
def fea_10(spark, sf):
    rows = features.complexity(_rows(spark, sf))
    return rows.select("doc_id", "cyclomatic_complexity", "max_indent_depth", F.round("comment_ratio", 6).alias("comment_ratio"))


@case("fea_11_pointer_and_casts", rf"""WITH {v.CORPUS} SELECT doc_id, {v.sql_count('raw_code', rf'[*&]{W}+|->|{W}+\[[0-9]+\]')} AS pointer_count,
  {v.sql_count('raw_code', fixed.CAST_PATTERN)} AS cast_count FROM corpus""")
def fea_11(spark, sf):
    return _without_text(features.pointer_and_casts(_rows(spark, sf)))


@case("fea_12_structure", f"""WITH {v.CORPUS} SELECT doc_id, {WORDS_SQL} AS ast_node_count, {INDENT_SQL} AS ast_max_depth, {POINTER_OPS_SQL} AS ast_pointer_ops,
  {CALLS_SQL} AS ast_function_calls, {LOOPS_SQL} AS ast_loops, {IFS_SQL} AS ast_if_statements FROM corpus""")
def fea_12(spark, sf):
    return _without_text(features.structure(_rows(spark, sf)))


def sql_any(patterns):
    return "CAST(" + " OR ".join(v.sql_hit("raw_code", p) for _, p, _ in patterns) + " AS INTEGER)"


@case("fea_13_taint_flags", f"""WITH {v.CORPUS} SELECT doc_id, {sql_any(fixed.TAINT_SOURCES)} AS has_source, {sql_any(fixed.TAINT_SINKS)} AS has_sink,
  {sql_any(fixed.TAINT_SOURCES)} * {sql_any(fixed.TAINT_SINKS)} AS source_and_sink, {v.sql_count('raw_code', fixed.TAINT_SANITIZERS[1], True)} AS taint_sanitizers FROM corpus""")
def fea_13(spark, sf):
    return _without_text(features.taint_flags(_rows(spark, sf)))


@case("fea_14_code_metrics", rf"""WITH {v.CORPUS} SELECT doc_id, CAST(len(string_split(raw_code, chr(10))) AS BIGINT) AS metric_lines, CAST(length(raw_code) AS BIGINT) AS metric_chars,
  {v.sql_count('raw_code', '[*&]')} AS metric_pointers, {CALLS_SQL} AS metric_calls FROM corpus""")
def fea_14(spark, sf):
    return _without_text(features.code_metrics(_rows(spark, sf)))


REDUCED_SQL = ", ".join(f"{sql_total(patterns)} AS sec_{name}" for name, patterns in fixed.REDUCED_FAMILIES.items())


@case("fea_15_reduced_families", f"""WITH {v.CORPUS} SELECT doc_id, {REDUCED_SQL}, {sql_total(fixed.REDUCED_SAFE_SIGNALS)} AS sec_safe_patterns,
  CAST(length(raw_code) AS BIGINT) AS code_length, CAST(len(string_split(raw_code, chr(10))) AS BIGINT) AS code_lines FROM corpus""")
def fea_15(spark, sf):
    return _without_text(features.reduced_family_counts(_rows(spark, sf)))


ONE_HOT_SQL = ", ".join(f"CAST(language = '{name}' AS INTEGER) AS lang_{name}" for name in fixed.ONE_HOT_LANGUAGES)


@case("fea_16_language_one_hot", f"""WITH {v.CORPUS}, d AS (SELECT doc_id, raw_code, {BEST8} AS language FROM (SELECT doc_id, raw_code, {COLS8} FROM corpus))
SELECT doc_id, {ONE_HOT_SQL}, CAST(language = 'unknown' AS INTEGER) AS lang_other,
  CAST(contains(raw_code, 'public class') OR contains(raw_code, 'import java') AS INTEGER) AS two_java,
  CAST(contains(raw_code, '#include') OR contains(raw_code, 'std::') AS INTEGER) AS two_cpp FROM d""")
def fea_16(spark, sf):
    return _without_text(features.language_two_hot(features.language_one_hot(_rows(spark, sf))))
