"""Weakness rules on code text and on module metrics, and the decisions built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import risk
from riskloom.functions.patterns import GRAM, CodeText, folded, needles, regex
from riskloom.session import settled, staged

# Message texts are data: pass other tables to change wording or language.
FINDINGS = {
    ("buffer_overflow", "strcpy"): "Buffer overflow: strcpy copies without a length limit",
    ("buffer_overflow", "strcat"): "Buffer overflow: strcat appends without a length limit",
    ("buffer_overflow", "gets"): "Buffer overflow: gets reads input of any length",
    ("buffer_overflow", "sprintf"): "Buffer overflow: sprintf writes without a bound",
    ("command_injection", "system"): "Command injection: system() starts a shell",
    ("command_injection", "popen"): "Command injection: popen() starts a shell pipe",
    ("command_injection", "runtime_exec"): "Command injection: Java runtime exec starts a process",
    ("sql_injection", "double_quoted"): "SQL injection: double-quoted query joined with +",
    ("sql_injection", "single_quoted"): "SQL injection: single-quoted query joined with +",
    ("sql_injection", "template"): "SQL injection: query template with interpolation",
    ("sql_injection", "sqlite"): "SQL injection: sqlite3_exec runs a query string as it is",
    ("xss", "inner_html"): "Cross-site scripting: assignment to innerHTML",
    ("xss", "write"): "Cross-site scripting: document.write of page content",
    ("xss", "template_send"): "Cross-site scripting: response sends an interpolated template",
    ("format_string", "printf_variable"): "Format string: variable used as printf format",
    ("deserialization", "object_stream"): "Deserialisation: ObjectInputStream on untrusted data",
    ("deserialization", "read_object"): "Deserialisation: readObject call without a class filter",
}
MITIGATIONS = {
    "buffer_overflow": "CWE-120: use bounded string functions or a string class",
    "command_injection": "CWE-78: pass an argument list to the process and start no shell",
    "sql_injection": "CWE-89: bind parameters in a prepared statement",
    "xss": "CWE-79: escape or sanitise untrusted text before rendering it",
    "format_string": "CWE-134: give printf a constant format",
    "deserialization": "CWE-502: exchange plain data formats or filter the classes read",
}
METRIC_FINDINGS = (
    ("unsafe_patterns", "unsafe calls: %d", "CWE-676: call checked library functions"),
    ("security_hotspots", "hotspots: %d", "CWE-119: bound each access to a buffer"),
    ("cyclomatic_complexity", "branches: %d", "CWE-1075: break the module up"),
    ("deprecated_functions", "outdated calls: %d", "CWE-1104: upgrade"),
    ("test_coverage", "coverage: %.1f%%", "CWE-1223: test more"),
)
FORBIDDEN_TEXT = {"gets": "gets() is forbidden", "strcpy": "strcpy() is forbidden", "eval": "eval() is forbidden"}
REMEDIATION = {
    "buffer_overflow": "Buffer overflow: use strncpy or fgets and check buffer sizes.",
    "injection": "Injection: use bound parameters and validate user input.",
}
REMEDIATION_DEFAULT = "Finding: review how input is sanitised."
RULE_COLUMNS = ("vulnerability_types", "cwe_ids", "recommendations")


def catalogue_frame(spark: SparkSession) -> DataFrame:
    """The rule catalogue as rows: its size is that of the tables above."""
    rows = [
        (family, cwe, order, pattern[0], pattern[1], FINDINGS[family, pattern[0]], MITIGATIONS[family])
        for family, (cwe, patterns) in fixed.CWE_RULES.items()
        for order, pattern in enumerate(patterns, 1)
    ]
    schema = "rule_family string, cwe_id string, rule_order int, rule_name string, pattern string, finding string, mitigation string"
    return spark.createDataFrame(rows, schema)


def rule_hits(code: Column, families: Sequence[str] = tuple(fixed.CWE_RULES), lowered: Column | None = None) -> Column:
    """Array of ``(family, order, rule, finding)`` of the rules that match, in catalogue order."""
    text = CodeText(code, lowered)
    return F.array_compact(
        F.array(
            *[
                F.when(
                    text.hit(pattern),
                    F.struct(
                        F.lit(family).alias("rule_family"),
                        F.lit(order).alias("rule_order"),
                        F.lit(pattern[0]).alias("rule_name"),
                        F.lit(FINDINGS[family, pattern[0]]).alias("finding"),
                    ),
                )
                for family in families
                for order, pattern in enumerate(fixed.CWE_RULES[family][1], 1)
            ]
        )
    )


def match_rules(df: DataFrame, code: str = "raw_code", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per (document, matching rule).

    The catalogue is compiled into the projection, so each pattern is compiled once and no text
    is paired with a rule it does not match.
    """
    return df.withColumn("_lowered", folded(F.col(code))).select(
        *keep, F.inline(rule_hits(F.col(code), lowered=F.col("_lowered")))
    )


def match_families(df: DataFrame, code: str = "raw_code", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per (document, matching rule family), made distinct inside the row."""
    families = F.array_distinct(F.transform(rule_hits(F.col(code), lowered=F.col("_lowered")), lambda hit: hit["rule_family"]))
    return df.withColumn("_lowered", folded(F.col(code))).select(*keep, F.explode(families).alias("rule_family"))


PATTERNS_IN_ONE_PASS = 500
RULES_IN_ONE_PASS = 200_000  # rows of the needle index that are sent to all tasks, some tens of megabytes


def needle_index(rules: DataFrame) -> DataFrame:
    """(rule_id, pattern, needle) of each rule, a row for each of its needles; the needle is null where nothing must stand in a text.

    Patterns are read by tasks, a batch at a time.
    """
    kind = dict(rules.dtypes)["rule_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(needles(p))) if p and needles(p) else [None] for p in batch.column(1).to_pylist()]
            rows = pa.array([i for i, some in enumerate(found) for _ in some], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([n for some in found for n in some], pa.string())], ["rule_id", "pattern", "needle"])

    return rules.select("rule_id", "pattern").filter("pattern is not null").mapInArrow(read, f"rule_id {kind}, pattern string, needle string")


def match_rule_table(df: DataFrame, rules: DataFrame, code: str, keep: Sequence[str], batch: int = PATTERNS_IN_ONE_PASS) -> DataFrame:
    """``match_rules`` for a rule catalogue of any size that arrives as a table ``(rule_id, pattern)``.

    Each pattern has a needle, four characters that stand in every text it matches. Texts are cut into their different runs of four
    characters, which meet the needles in a hash join inside the task; only then is the one pattern tried on the one text. So texts do not
    move and are read once, and the cost of a text does not grow with the rules that have nothing to do with it. Patterns without a
    needle are compiled into a projection, ``batch`` for each further pass.

    A document is a row: rows that agree in ``keep`` are told apart, and a rule gives one row for each row of ``df`` that it matches.
    """
    index = staged(needle_index(rules), "needles")
    general = index.filter("needle is null").select("rule_id", "pattern").collect()  # rules without a needle only
    count = index.filter("needle is not null").count()
    text, grams = F.col("_code"), r"(?s)(?![\uDC00-\uDFFF])(?=(.{%d}))" % GRAM
    named = df.select(F.col(code).alias("_code"), F.struct(*keep).alias("_keep"))
    passes = []
    parts = -(-count // RULES_IN_ONE_PASS)
    for part in range(parts):
        some = index.filter("needle is not null")
        if parts > 1:
            some = some.filter(F.pmod(F.xxhash64("rule_id", "pattern"), F.lit(parts)) == part)
        run = F.explode(F.array_distinct(F.regexp_extract_all(folded(text), F.lit(grams), F.lit(1)))).alias("needle")
        met = named.withColumn("_row", F.monotonically_increasing_id()).select("*", run).join(F.broadcast(some), "needle")
        hit = met.filter(F.regexp_like(text, F.concat(F.lit("(?dU)"), F.col("pattern"))))
        alternatives = some.groupBy("rule_id", "pattern").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
        if alternatives:  # a text may hold several needles of one rule
            hit = hit.dropDuplicates(["_row", "rule_id", "pattern"])
        passes.append(hit.select("_keep.*", "rule_id"))
    for start in range(0, len(general), batch):
        tests = [F.when(F.regexp_like(text, regex(row.pattern)), F.lit(row.rule_id)) for row in general[start : start + batch]]
        passes.append(named.select("_keep", F.explode(F.array_compact(F.array(*tests))).alias("rule_id")).select("_keep.*", "rule_id"))
    if not passes:
        return named.select("_keep.*", F.lit(None).cast(dict(rules.dtypes)["rule_id"]).alias("rule_id")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, passes)


def attach_weakness(hits: DataFrame) -> DataFrame:
    """Add CWE id and mitigation of the matched family; the family table has a fixed six rows."""
    rows = [(family, fixed.CWE_RULES[family][0], MITIGATIONS[family]) for family in fixed.CWE_RULES]
    table = hits.sparkSession.createDataFrame(rows, "rule_family string, cwe_id string, mitigation string")
    return hits.join(F.broadcast(table), "rule_family")


def attach_remediation(findings: DataFrame, pattern: str = "pattern_name") -> DataFrame:
    """Add the remediation text of a pattern name, or the default; the guide has a fixed two rows."""
    guide = findings.sparkSession.createDataFrame(list(REMEDIATION.items()), f"{pattern} string, _text string")
    joined = findings.join(F.broadcast(guide), pattern, "left")
    return joined.withColumn("remediation", F.coalesce("_text", F.lit(REMEDIATION_DEFAULT))).drop("_text")


def family_flags(df: DataFrame, family: str, code: str = "raw_code") -> DataFrame:
    """Findings of one family: matched rule names, their number and the CWE id (null if none)."""
    text = CodeText(F.col(code))
    cwe, patterns = fixed.CWE_RULES[family]
    named = df.withColumn("rule_names", text.names(patterns))
    return named.withColumns(
        {"hits": F.size("rule_names").cast("bigint"), "cwe_id": F.when(F.size("rule_names") > 0, F.lit(cwe))}
    )


def code_findings(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """``vulnerability_types`` (one per rule), ``cwe_ids`` and ``recommendations`` (one per family)."""
    lowered = df.withColumn("_lowered", folded(F.col(code)))
    matched = lowered.withColumn("_hits", rule_hits(F.col(code), lowered=F.col("_lowered")))
    families = F.transform(F.col("_hits"), lambda hit: hit["rule_family"])
    per_family = {
        "cwe_ids": [(family, fixed.CWE_RULES[family][0]) for family in fixed.CWE_RULES],
        "recommendations": [(family, MITIGATIONS[family]) for family in fixed.CWE_RULES],
    }
    columns = {"vulnerability_types": F.transform(F.col("_hits"), lambda hit: hit["finding"])}
    for name, rows in per_family.items():
        columns[name] = F.array_compact(F.array(*[F.when(F.array_contains("_families", f), F.lit(v)) for f, v in rows]))
    return matched.withColumn("_families", families).withColumns(columns).drop("_lowered", "_hits", "_families")


def metric_findings(df: DataFrame) -> DataFrame:
    tests = (
        F.col("unsafe_patterns") > 0,
        F.col("security_hotspots") > 0,
        F.col("cyclomatic_complexity") > fixed.MAX_COMPLEXITY,
        F.col("deprecated_functions") > 0,
        F.col("test_coverage") < fixed.MIN_COVERAGE,
    )
    def chosen(values: list[Column]) -> Column:
        return F.array_compact(F.array(*[F.when(test, value) for test, value in zip(tests, values)]))

    return df.withColumns(
        {
            "vulnerability_types": chosen([F.format_string(text, F.col(name)) for name, text, _ in METRIC_FINDINGS]),
            "cwe_ids": chosen([F.lit(cwe) for cwe in fixed.METRIC_CWES]),
            "recommendations": chosen([F.lit(advice) for _, _, advice in METRIC_FINDINGS]),
        }
    )


def decide(df: DataFrame, probability: str = "probability", reasons: str | None = None, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    """Combine a model score with the rule columns into one prediction per row.

    ``reasons`` names an array column with the features behind the score.
    """
    p = F.col(probability)
    why = F.array_join(F.col(reasons), ", ") if reasons else F.lit("no explanation available")
    flagged = df.withColumns({"is_vulnerable": p >= threshold, "risk_level": risk.risk_level(p)})
    return flagged.withColumns(
        {
            "risk_probability": risk.reported_probability(p),
            "recommendation": risk.advice_text(F.col("risk_level"), F.col("recommendations")),
            "vulnerability_types": F.when(
                F.col("is_vulnerable"),
                F.concat(F.array(F.concat(F.lit("Model score driven by: "), why)), F.col("vulnerability_types")),
            ).otherwise(F.col("vulnerability_types")),
            "cwe_ids": F.when(
                F.col("is_vulnerable") & (F.size("cwe_ids") == 0), F.array(F.lit(fixed.UNKNOWN_CWE))
            ).otherwise(F.col("cwe_ids")),
        }
    )


def decide_pr(df: DataFrame, probability: str = "probability", threshold: float = fixed.PR_THRESHOLD) -> DataFrame:
    """Change-scan decision: any rule, any suspicious pattern, or the score alone."""
    p = risk.reported_probability(F.col(probability))
    found = (F.size("vulnerability_types") > 0) | (F.size("cwe_ids") > 0) | (F.size("suspicious_patterns") > 0)
    judged = settled(df, {}).withColumns({"probability": p, "_flag": found | (p >= threshold)})
    return judged.withColumns(
        {
            "status": F.when(F.col("_flag"), F.lit("VULNERABLE")).otherwise(F.lit("SAFE")),
            "risk_level": F.when(F.col("_flag"), risk.risk_level(F.col("probability"))).otherwise(F.lit("LOW")),
        }
    ).drop("_flag")


def precheck(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """Fast gate before any model: forbidden calls found, and whether the text passes."""
    text = CodeText(F.col(code))
    issues = F.array_compact(F.array(*[F.when(text.hit(p), F.lit(FORBIDDEN_TEXT[p[0]])) for p in fixed.FORBIDDEN_CALLS]))
    return df.withColumn("issues", issues).withColumn("passed", F.size("issues") == 0)


def ci_findings(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """Heuristic families of the build check with their remediation texts."""
    named = df.withColumn("vulnerabilities", CodeText(F.col(code)).names(fixed.CI_FAMILIES))
    guide = F.create_map(*[F.lit(part) for pair in REMEDIATION.items() for part in pair])
    return named.withColumn(
        "mitigation",
        F.transform("vulnerabilities", lambda v: F.coalesce(F.try_element_at(guide, v), F.lit(REMEDIATION_DEFAULT))),
    )
