"""Scalar normalisation of code records: fields, labels, text, language, keys and sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import fixed_values as fixed
from riskloom.functions.patterns import CodeText, any_of, count, folded, regex

WIDE_LINE_ENDS = "\u2028\u2029"
WIDE_SPACES = "".join(c for c in fixed.SPACE_CHARACTERS if ord(c) > 0xFF)
# As escapes, for character classes.
NARROW_SPACES = "".join(f"\\x{ord(c):02x}" for c in fixed.SPACE_CHARACTERS if ord(c) <= 0xFF)
NARROW_LINE_ENDS = "".join(f"\\x{ord(c):02x}" for c in "\n\r\x0b\x0c\x1c\x1d\x1e\x85")


# --- field choice ---------------------------------------------------------------------------
def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(fixed.SPACE_CHARACTERS))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def first_nonblank(*fields: Column) -> Column:
    return F.coalesce(*[F.when(~is_blank(field), field) for field in fields])


def first_nonempty(*fields: Column) -> Column:
    return F.coalesce(*[F.nullif(field, F.lit("")) for field in fields])


def first_present(*fields: Column) -> Column:
    return F.coalesce(*fields)


def first_nonzero(*labels: Column) -> Column:
    """First label that is neither missing nor zero; 0 if there is none."""
    return F.coalesce(*[F.nullif(label.cast("int"), F.lit(0)) for label in labels], F.lit(0))


def label_from_text(value: Column) -> Column:
    text = F.lower(strip(value))
    return F.when(text.isin(*fixed.POSITIVE_LABELS), F.lit(1)).when(text.isin(*fixed.NEGATIVE_LABELS), F.lit(0))


def label_of(value: Column, data_type: T.DataType) -> Column:
    """Label of a typed column: booleans and 0/1 keep their value, text is looked up."""
    if isinstance(data_type, T.BooleanType):
        return value.cast("int")
    if isinstance(data_type, T.IntegralType):
        return F.when(value.isin(0, 1), value.cast("int"))
    return label_from_text(value.cast("string"))


# --- text -----------------------------------------------------------------------------------
def clean_code(code: Column) -> Column:
    text = F.replace(code, F.lit("\x00"), F.lit(""))
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lowered = folded(code)
    leaks = F.contains(lowered, F.lit("vulnerable")) | F.contains(lowered, F.lit("safe")) | F.contains(code, F.lit("\x00"))
    marked = F.regexp_replace(text, regex(r"(?im)(//|#|/\*)\s*(vulnerable|safe)\s*:?"), F.lit("$1 "))
    marked = F.regexp_replace(marked, regex(r"(?i)\b(vulnerable|safe)\s*:\s*"), F.lit(""))
    text = F.when(leaks, marked).otherwise(text)
    # A single blank would be replaced by itself, so only tabs and longer runs are touched.
    text = F.regexp_replace(text, F.lit(r"[ \t]{2,}|\t"), F.lit(" "))
    text = F.regexp_replace(text, F.lit(r"\n{4,}"), F.lit("\n\n\n"))
    return strip(text)


def narrow_spaces(code: Column) -> Column:
    """The text with white space beyond U+00FF as line breaks and blanks, so that patterns need to know only the first 256 characters."""
    replaced = reduce(lambda text, c: F.replace(text, F.lit(c), F.lit("\n" if c in WIDE_LINE_ENDS else " ")), WIDE_SPACES, code)
    return F.when(F.octet_length(code) == F.length(code), code).otherwise(replaced)


def content_key(code: Column) -> Column:
    return F.sha2(code, 256)


def char_length(code: Column) -> Column:
    return F.length(code).cast("bigint")


def nonblank_lines(code: Column) -> Column:
    # Possessive and of characters below 256 alone: such classes are looked up in a table, others are a chain of tests for each character.
    return F.regexp_count(narrow_spaces(code), F.lit(f"[^{NARROW_SPACES}][^{NARROW_LINE_ENDS}]*+")).cast("bigint")


def raw_lines(code: Column) -> Column:
    return (F.length(code) - F.length(F.replace(code, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


# --- language -------------------------------------------------------------------------------
def detect_language(code: Column) -> Column:
    return CodeText(code).first(fixed.LANGUAGE_PROBES, "unknown")


def detect_web_language(code: Column) -> Column:
    return CodeText(code).first(fixed.WEB_LANGUAGE_PROBES, "unknown")


def language_scores(code: Column, table: Mapping[str, Sequence]) -> dict[str, Column]:
    text = CodeText(code)
    return {
        language: sum((text.hit(pattern).cast("int") for pattern in patterns), F.lit(0))
        for language, patterns in table.items()
    }


def detect_language_scored(code: Column, table: Mapping[str, Sequence] = fixed.LANGUAGE_SCORES_8) -> Column:
    """Language with the most matching patterns; the first listed one on ties, ``unknown`` at zero."""
    names = list(table)
    scores = language_scores(code, table)
    # One sortable number per language: the score first, then the place in the list.
    ranked = F.greatest(*[score * 100 + (len(names) - i) for i, score in enumerate(scores.values())])
    return F.when(ranked >= 100, F.element_at(F.array(*map(F.lit, names)), len(names) + 1 - F.pmod(ranked, F.lit(100)))).otherwise(
        F.lit("unknown")
    )


def normalise_language(language: Column, code: Column) -> Column:
    text = F.lower(strip(F.coalesce(language, F.lit(""))))
    for spelling in ("c++", "c/cpp", "c_cpp"):
        text = F.replace(text, F.lit(spelling), F.lit("cpp"))
    aliases = F.create_map(*[F.lit(part) for pair in fixed.LANGUAGE_ALIASES.items() for part in pair])
    return F.coalesce(F.try_element_at(aliases, text), detect_language(code))


def language_name(value: Column) -> Column:
    """Language named by a free-form spelling; the first rule that holds decides."""
    text = strip(F.lower(value))
    chain = F
    for parts, spellings, name in fixed.LANGUAGE_NAME_RULES:
        tests = [F.contains(text, F.lit(part)) for part in parts] + [text == F.lit(word) for word in spellings]
        chain = chain.when(any_of(tests), F.lit(name))
    return chain.otherwise(F.lit("unknown"))


def path_suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/](\.[^/.]+)$", 1))


def language_from_path(path: Column, code: Column) -> Column:
    suffix = path_suffix(path)
    java = CodeText(code).hit(("java", r"\bpublic\s+class\b", ("public",)))
    table = fixed.SUFFIX_LANGUAGES
    c_family = [s for s in table if table[s] in ("c", "cpp")]
    known = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    looked_up = F.try_element_at(known, suffix)
    return F.when(suffix.isin(*c_family), looked_up).when(java, F.lit("java")).otherwise(F.coalesce(looked_up, F.lit("unknown")))


# --- keys -----------------------------------------------------------------------------------
def composed_group(cve: Column, commit: Column, path: Column, function: Column) -> Column:
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (cve, commit, path, function)]
    return F.concat_ws(":", *parts)


def effective_group(group_id: Column, code_hash: Column) -> Column:
    return F.when(F.length(group_id) > 0, group_id).otherwise(code_hash)


def scoring_row(code: Column) -> list[Column]:
    """The columns a model needs for a bare text."""
    return [
        code.alias("raw_code"),
        detect_web_language(code).alias("language"),
        F.lit("manual").alias("source"),
        char_length(code).alias("code_length"),
        nonblank_lines(code).alias("line_count"),
    ]


# --- predicates -----------------------------------------------------------------------------
def clean_length_ok(code: Column) -> Column:
    return F.length(code).between(fixed.MIN_CLEAN_CHARS, fixed.MAX_CLEAN_CHARS)


def raw_length_ok(code: Column, low: int = fixed.MIN_RAW_CHARS, high: int = fixed.MAX_RAW_CHARS) -> Column:
    return F.length(code).between(low, high)


def is_junk(code: Column) -> Column:
    text = CodeText(code)
    return any_of(text.hit(pattern, ignore_case=True) for pattern in fixed.JUNK_PATTERNS)


def sample_ok(code: Column, low: int = fixed.MIN_RAW_CHARS, high: int = fixed.MAX_RAW_CHARS, filter_junk: bool = True) -> Column:
    keep = raw_length_ok(code, low, high)
    return keep & ~is_junk(code) if filter_junk else keep


def is_source_file(path: Column) -> Column:
    return path_suffix(path).isin(*fixed.SOURCE_SUFFIXES)


def in_excluded_dir(path: Column, names: Sequence[str] = fixed.SCAN_EXCLUDED_DIRS) -> Column:
    folders = F.regexp_replace(path, r"[^/]*$", "")
    return F.arrays_overlap(F.split(folders, "/"), F.array(*map(F.lit, names)))


def in_pr_scope(path: Column, source_dir: str | None = None) -> Column:
    keep = ~F.split_part(path, F.lit("/"), F.lit(1)).isin(*fixed.PR_EXCLUDED_TOP_DIRS)
    if source_dir:
        keep = keep & F.startswith(path, F.lit(source_dir.replace("\\", "/").rstrip("/") + "/"))
    return keep


def is_synthetic(source: Column) -> Column:
    return source.isin(*fixed.SYNTHETIC_SOURCES)
