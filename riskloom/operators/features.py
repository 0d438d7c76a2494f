"""Feature columns from code text. Every operator here is one projection: no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.functions.patterns import CodeText, count, folded, regex

LOWERED = "_lowered"
CALL_SPACES = "".join(c for c in fixed.SPACE_CHARACTERS if not "\x1c" <= c <= "\x1f")  # what a regex takes for white space


def with_lowered(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """Fold the text once; the pattern columns that follow share it."""
    return df.withColumn(LOWERED, folded(F.col(code)))


def _text(code: str) -> CodeText:
    return CodeText(F.col(code), F.col(LOWERED))


def dangerous_counts(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = _text(code)
    return with_lowered(df, code).select("*", *[text.occurrences(p).alias(f"dangerous_{p[0]}") for p in fixed.DANGEROUS]).drop(LOWERED)


def sanitizer_counts(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = _text(code)
    return with_lowered(df, code).select("*", *[text.occurrences(p).alias(f"sanitizer_{p[0]}") for p in fixed.SANITIZERS]).drop(LOWERED)


def signal_totals(df: DataFrame) -> DataFrame:
    """Totals over the columns that ``dangerous_counts`` and ``sanitizer_counts`` added."""
    dangerous = sum((F.col(f"dangerous_{p[0]}") for p in fixed.DANGEROUS), F.lit(0))
    sanitizers = sum((F.col(f"sanitizer_{p[0]}") for p in fixed.SANITIZERS), F.lit(0))
    return df.withColumns({"dangerous_total": dangerous, "sanitizer_total": sanitizers}).withColumn(
        "net_risk", F.greatest(F.lit(0).cast("bigint"), F.col("dangerous_total") - F.col("sanitizer_total"))
    )


def security_signals(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """All size, token, import and pattern counts of the security signal block."""
    counted = signal_totals(sanitizer_counts(dangerous_counts(df, code), code))
    return counted.withColumns(
        {"lines_of_code": n.nonblank_lines(F.col(code)), "token_count": token_count(F.col(code)), "import_count": import_count(F.col(code))}
    )


def token_count(code: Column) -> Column:
    return count(code, fixed.TOKEN_PATTERN)


def import_count(code: Column) -> Column:
    return CodeText(code, code).occurrences(fixed.IMPORT_PATTERN)


def suspicious_names(code: Column, lowered: Column | None = None) -> Column:
    return CodeText(code, lowered).names(fixed.DANGEROUS)


def sanitizer_names(code: Column, lowered: Column | None = None) -> Column:
    return CodeText(code, lowered).names(fixed.SANITIZERS)


def family_counts(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = _text(code)
    columns = {f"sec_{name}": text.total(patterns, ignore_case=True) for name, patterns in fixed.FAMILIES.items()}
    return with_lowered(df, code).withColumns(columns).drop(LOWERED)


def safe_signals(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """Safe-pattern count and its ratio to the family counts, which must be present."""
    dangerous = sum((F.col(f"sec_{name}") for name in fixed.FAMILIES), F.lit(0))
    counted = with_lowered(df, code).withColumn("sec_safe_patterns", _text(code).total(fixed.SAFE_SIGNALS, ignore_case=True))
    return counted.withColumn("sec_safety_ratio", F.col("sec_safe_patterns") / (dangerous + 1)).drop(LOWERED)


def reduced_family_counts(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = _text(code)
    columns = {f"sec_{name}": text.total(patterns, ignore_case=True) for name, patterns in fixed.REDUCED_FAMILIES.items()}
    columns["sec_safe_patterns"] = text.total(fixed.REDUCED_SAFE_SIGNALS, ignore_case=True)
    columns["code_length"] = n.char_length(F.col(code))
    columns["code_lines"] = n.raw_lines(F.col(code))
    return with_lowered(df, code).withColumns(columns).drop(LOWERED)


def max_indent(code: Column) -> Column:
    """Longest run of leading white space over the lines that hold anything else."""
    indents = F.regexp_extract_all(code, regex(rf"(?m)^((?:[{fixed.SPACE}&&[^\n]])*)[^{fixed.SPACE}]"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(indents, F.length)), F.lit(0)).cast("bigint")


def complexity(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = F.col(code)
    comments = count(text, rf"(?m)^(?:[{fixed.SPACE}&&[^\n]])*(//|#|/\*|\*)")
    return df.withColumns(
        {
            "cyclomatic_complexity": count(text, fixed.BRANCH_PATTERN),
            "max_indent_depth": max_indent(text),
            "comment_ratio": comments / (n.raw_lines(text) + 1),
        }
    )


def pointer_and_casts(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = F.col(code)
    return df.withColumns({"pointer_count": count(text, fixed.POINTER_PATTERN), "cast_count": count(text, fixed.CAST_PATTERN)})


def nonblank_runs(code: Column) -> Column:
    """How many runs of characters that are no white space."""
    return F.regexp_count(n.narrow_spaces(code), F.lit(f"[^{n.NARROW_SPACES}]++")).cast("bigint")


def call_count(code: Column) -> Column:
    """Matches of ``fixed.CALL_PATTERN``: each ends at another bracket, so these are the brackets that follow a word and white space."""
    before = F.split(code, r"\(")
    last = lambda part: F.right(F.rtrim(part, F.lit(CALL_SPACES)), F.lit(1))
    found = F.filter(F.slice(before, 1, F.size(before) - 1), lambda part: F.regexp_like(last(part), regex(r"\w")))
    return F.when(code.isNotNull(), F.size(found)).cast("bigint")


def structure(df: DataFrame, code: str = "raw_code") -> DataFrame:
    """Structural counts that stand in for syntax-tree statistics."""
    text = F.col(code)
    return df.withColumns(
        {
            "ast_node_count": nonblank_runs(text),
            "ast_max_depth": max_indent(text),
            "ast_pointer_ops": count(text, fixed.POINTER_OP_PATTERN),
            "ast_function_calls": call_count(text),
            "ast_loops": count(text, fixed.LOOP_PATTERN),
            "ast_if_statements": count(text, fixed.IF_PATTERN),
        }
    )


def taint_flags(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = _text(code)
    source = F.greatest(*[text.hit(p).cast("int") for p in fixed.TAINT_SOURCES])
    sink = F.greatest(*[text.hit(p).cast("int") for p in fixed.TAINT_SINKS])
    return (
        with_lowered(df, code)
        .withColumns({"has_source": source, "has_sink": sink, "taint_sanitizers": text.occurrences(fixed.TAINT_SANITIZERS, ignore_case=True)})
        .withColumn("source_and_sink", F.col("has_source") * F.col("has_sink"))
        .drop(LOWERED)
    )


def code_metrics(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = F.col(code)
    return df.withColumns(
        {
            "metric_lines": n.raw_lines(text),
            "metric_chars": n.char_length(text),
            "metric_pointers": count(text, fixed.STAR_AMP_PATTERN),
            "metric_calls": count(text, fixed.CALL_PATTERN),
        }
    )


def language_one_hot(df: DataFrame, code: str = "raw_code") -> DataFrame:
    detected = df.withColumn("_language", n.detect_language_scored(F.col(code)))
    flags = {f"lang_{name}": (F.col("_language") == name).cast("int") for name in fixed.ONE_HOT_LANGUAGES}
    flags["lang_other"] = (F.col("_language") == "unknown").cast("int")
    return detected.withColumns(flags).drop("_language")


def language_two_hot(df: DataFrame, code: str = "raw_code") -> DataFrame:
    text = F.col(code)
    java = F.contains(text, F.lit("public class")) | F.contains(text, F.lit("import java"))
    cpp = F.contains(text, F.lit("#include")) | F.contains(text, F.lit("std::"))
    return df.withColumns({"two_java": java.cast("int"), "two_cpp": cpp.cast("int")})


def file_summary(df: DataFrame, code: str = "raw_code", path: str = "path") -> DataFrame:
    """One summary per file: language, sizes, structural counts and the suspicious patterns found."""
    text = F.col(code)
    names = structure(with_lowered(df, code), code).withColumns(
        {"suspicious_patterns": suspicious_names(text, F.col(LOWERED)), "_sanitizers": sanitizer_names(text, F.col(LOWERED))}
    )
    summary = F.struct(
        F.col(path).alias("path"),
        n.language_from_path(F.col(path), text).alias("language"),
        n.nonblank_lines(text).alias("lines_of_code"),
        token_count(text).alias("token_count"),
        import_count(text).alias("import_count"),
        F.col("ast_node_count"),
        F.col("ast_max_depth"),
        F.col("ast_function_calls"),
        F.size("suspicious_patterns").cast("bigint").alias("dangerous_call_count"),
        F.size("_sanitizers").cast("bigint").alias("sanitization_count"),
        F.size("suspicious_patterns").cast("bigint").alias("suspicious_pattern_count"),
        F.col("suspicious_patterns"),
    )
    return names.withColumn("features", summary).drop(
        LOWERED, "_sanitizers", "suspicious_patterns", "ast_node_count", "ast_max_depth", "ast_pointer_ops",
        "ast_function_calls", "ast_loops", "ast_if_statements",
    )
