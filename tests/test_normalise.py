import re

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.functions import risk
from riskloom.functions.patterns import CodeText


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, x {kind}")


def results(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


CLEANING = {
    "a\r\nb\rc": "a\nb\nc",
    "x\x00y": "xy",
    "// VULNERABLE: int x;": "// int x;",
    "# safe\nint y;": "# int y;",
    "/* Safe : note */": "/* note */",
    "say vulnerable:  now": "say now",
    "a \t  b": "a b",
    "a\n\n\n\n\n\nb": "a\n\n\nb",
    "\x1c  a \xa0\n": "a",
    "vul\x00nerable: x": "x",
}


def test_cleaning(spark):
    df = column(spark, list(CLEANING))
    assert results(df, n.clean_code(F.col("x"))) == list(CLEANING.values())


def test_cleaning_is_stable_on_its_own_output(spark):
    df = column(spark, [v for v in CLEANING.values()])
    assert results(df, n.clean_code(F.col("x"))) == list(CLEANING.values())


TEXTS = ["", "   ", "a", "a\n\nb\r\n c\x0b\x0cd\x85 e", "\n", "  x\n\ty\n z", "é ñ\xa0\nü", "\x1c\x1d a"]


def test_line_counts_follow_text_line_rules(spark):
    df = column(spark, TEXTS)
    assert results(df, n.nonblank_lines(F.col("x"))) == [len([l for l in t.splitlines() if l.strip()]) for t in TEXTS]
    assert results(df, n.raw_lines(F.col("x"))) == [len(t.split("\n")) for t in TEXTS]


def test_strip_follows_unicode_white_space(spark):
    assert results(column(spark, TEXTS), n.strip(F.col("x"))) == [t.strip() for t in TEXTS]


def test_labels(spark):
    values = ["1", "true", " YES ", "Vulnerable", "unsafe", "buggy", "0", "false", "no", "safe", "fixed", "clean", "2", "maybe", "", None, "1.0"]
    expected = [1] * 6 + [0] * 6 + [None] * 5
    assert results(column(spark, values), n.label_from_text(F.col("x"))) == expected


@pytest.mark.parametrize("size, kept", [(29, False), (30, True), (200_000, True), (200_001, False)])
def test_clean_length_bounds(spark, size, kept):
    assert results(column(spark, ["x" * size]), n.clean_length_ok(F.col("x"))) == [kept]


@pytest.mark.parametrize("size, kept", [(49, False), (50, True), (50_000, True), (50_001, False)])
def test_raw_length_bounds(spark, size, kept):
    assert results(column(spark, ["x" * size]), n.sample_ok(F.col("x"))) == [kept]


def test_junk_stays_on_one_line(spark):
    df = column(spark, ["x 404 page nOt FOUND", "404\nNot Found", "<!doctype HTML>", "<HTML lang>", "plain"])
    assert results(df, n.is_junk(F.col("x"))) == [True, False, True, True, False]


def test_suffixes(spark):
    paths = ["a/b.CPP", "a.tar.gz", ".bashrc", "dir.d/file", "x/.hidden", "x/..py", "noext", "a.py"]
    assert results(column(spark, paths), n.path_suffix(F.col("x"))) == [".cpp", ".gz", "", "", "", ".py", "", ".py"]


def test_scored_language_ties_go_to_the_first(spark):
    df = column(spark, ["def f(x)", "package main", "#include <stdio.h>\nprintf(", "nothing", "", None])
    # ``def`` scores once for Python and once for Ruby; the include scores for C and C++, printf for C and,
    # through its last five letters, not for Python's print.
    assert results(df, n.detect_language_scored(F.col("x"))) == ["python", "go", "c", "unknown", "unknown", "unknown"]


def test_javascript_spelling_names_java(spark):
    assert results(column(spark, ["JavaScript", "js", "C++17", "golang", " c ", "fortran", None]), n.language_name(F.col("x"))) == [
        "java", "javascript", "cpp", "go", "c", "unknown", "unknown"]


def test_risk_levels(spark):
    df = column(spark, [0.20, 0.3999, 0.40, 0.55, 0.6999, 0.70, 1.0], "double")
    assert results(df, risk.risk_level(F.col("x"))) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    with pytest.raises(Exception, match="between 0 and 1"):
        results(column(spark, [1.2], "double"), risk.risk_level(F.col("x")))
    assert results(column(spark, [1.2, -0.1], "double"), risk.risk_level(F.col("x"), strict=False)) == [None, None]


def all_patterns():
    groups = [
        (fixed.DANGEROUS, False), (fixed.SANITIZERS, False), (fixed.SAFE_SIGNALS, True), (fixed.TAINT_SOURCES, False), (fixed.TAINT_SINKS, False),
        ((fixed.TAINT_SANITIZERS, fixed.IMPORT_PATTERN), False), (fixed.WEB_LANGUAGE_PROBES, False), (fixed.JUNK_PATTERNS, True), (fixed.REDUCED_SAFE_SIGNALS, True)]
    groups += [(p, True) for p in fixed.FAMILIES.values()] + [(p, True) for p in fixed.REDUCED_FAMILIES.values()]
    groups += [(p, False) for _, p in fixed.CWE_RULES.values()]
    groups += [(p, False) for table in (fixed.LANGUAGE_SCORES_8, fixed.LANGUAGE_SCORES_6) for p in table.values()]
    return [(row, fold) for rows, fold in groups for row in rows]


def test_needles_never_hide_a_match(spark):
    """The gated count must equal the ungated count of another regex engine on snippets of every kind."""
    from checks.views import SNIPPETS
    texts = [*SNIPPETS, *[s.upper() for s in SNIPPETS], *[s.lower() for s in SNIPPETS], "paſſword = 'abcdefgh'", "ADMıN İnsert Key toKen sys\nSELECT x\rFROM y"]
    df = column(spark, texts).withColumn("low", F.lower("x"))
    rows = all_patterns()
    text = CodeText(F.col("x"))
    got = df.orderBy("i").select(*[text.occurrences(row, fold).alias(f"c{k}") for k, (row, fold) in enumerate(rows)]).collect()
    for source, line in zip(texts, got):
        for k, (row, fold) in enumerate(rows):
            expected = len(re.findall(row[1], source, re.IGNORECASE if fold else 0))
            assert line[k] == expected, (row[0], row[1], source)


def test_line_counts_know_all_white_space_and_look_it_up(spark):
    from riskloom import fixed_values as fixed
    texts = [f"a{c}b{c}{c} c{c}\n{c}" for c in fixed.SPACE_CHARACTERS] + [" 　 x ", "中文　\n \né", None]
    expected = [None if t is None else len([line for line in t.splitlines() if line.strip()]) for t in texts]
    assert results(column(spark, texts), n.nonblank_lines(F.col("x"))) == expected
    # Classes with characters beyond U+00FF take a chain of tests for each character of a text.
    plan = column(spark, ["x"]).select(n.nonblank_lines(F.col("x")))._jdf.queryExecution().analyzed().toString()
    assert "u2028" not in plan and "(?dU)" not in plan
