"""Patterns, word lists, code tables and limits that define the results.

Nothing here is computed. Every pattern row is ``(name, pattern, needles)``. The needles are
literals of which at least one occurs in any text the pattern can match; they let the compiler
skip the regex on texts that cannot match.
"""

# --- field priorities and limits of the corpus cleaner (fixed values) -------------------------
CODE_FIELDS = ("raw_code", "func", "code", "functionSource", "function", "vulnerable_code", "fixed_code")
LABEL_FIELDS = ("is_vulnerable", "target", "label", "vulnerable", "safety")
GROUP_FIELDS = ("cve_id", "commit_id", "id", "hash", "project")
SOURCE_ORDER = ("codexglue", "d2a", "reveal", "megavul_java", "megavul_c_cpp", "owasp2025", "cvefixes_zip")
SYNTHETIC_SOURCES = ("owasp2025",)
MIN_CLEAN_CHARS, MAX_CLEAN_CHARS = 30, 200_000
MIN_RAW_CHARS, MAX_RAW_CHARS = 50, 50_000
POSITIVE_LABELS = ("1", "true", "yes", "vulnerable", "unsafe", "buggy")
NEGATIVE_LABELS = ("0", "false", "no", "safe", "fixed", "clean")
JUNK_PATTERNS = (
    ("not_found", r"404.*Not Found", ("404",)),
    ("doctype", r"<!DOCTYPE html", ("<!doctype html",)),
    ("html_tag", r"<html", ("<html",)),
)

# --- language tables (fixed values) ------------------------------------------------------------
LANGUAGE_ALIASES = {
    "c": "c", "cpp": "cpp", "cc": "cpp", "cxx": "cpp", "h": "cpp", "hpp": "cpp", "java": "java",
    "py": "python", "python": "python", "js": "javascript", "javascript": "javascript",
    "ts": "typescript", "typescript": "typescript", "php": "php", "go": "go", "golang": "go", "html": "html",
}
# First match wins, in this order.
LANGUAGE_PROBES = (
    ("java", r"\b(public\s+class|import\s+java|package\s+[\w.]+;)", ("public", "import", "package")),
    ("cpp", r"#include\s*<|std::|->", ("#include", "std::", "->")),
    ("python", r"\bdef\s+\w+\(|import\s+\w+", ("def", "import")),
    ("javascript", r"\bfunction\s+\w+\(|const\s+\w+\s*=", ("function", "const")),
)
PHP_PROBE = ("php", r"<\?php|\bnamespace\s+[\w\\]+;", ("<?php", "namespace"))
HTML_PROBE = ("html", r"(?i)<!doctype html|<html", ("<!doctype html", "<html"))
WEB_LANGUAGE_PROBES = (*LANGUAGE_PROBES[:2], PHP_PROBE, *LANGUAGE_PROBES[2:], HTML_PROBE)

# One point per pattern that matches; ties go to the language listed first.
LANGUAGE_SCORES_8 = {
    "java": (
        ("class", r"public\s+class\s+\w+", ("public",)), ("import", r"import\s+java\.", ("import",)),
        ("override", r"@Override", ("@Override",)), ("system", r"System\.(out|in|err)", ("System.",)),
        ("string", r"String\s+\w+\s*=", ("String",)),
    ),
    "c": (
        ("include", r"#include\s*<.*\.h>", ("#include",)), ("printf", r"printf\s*\(", ("printf",)),
        ("scanf", r"scanf\s*\(", ("scanf",)), ("main", r"int\s+main\s*\(", ("main",)),
    ),
    "cpp": (
        ("include", r"#include\s*<.*>", ("#include",)), ("std", r"std::", ("std::",)),
        ("cout", r"cout\s*<<", ("cout",)), ("cin", r"cin\s*>>", ("cin",)),
        ("namespace", r"namespace\s+\w+", ("namespace",)), ("template", r"template\s*<", ("template",)),
    ),
    "python": (
        ("def", r"def\s+\w+\s*\(", ("def",)), ("import", r"import\s+\w+", ("import",)),
        ("from", r"from\s+\w+\s+import", ("import",)), ("main", r"if\s+__name__\s*==", ("__name__",)),
        ("print", r"print\s*\(", ("print",)),
    ),
    "javascript": (
        ("function", r"function\s+\w+\s*\(", ("function",)), ("const", r"const\s+\w+\s*=", ("const",)),
        ("let", r"let\s+\w+\s*=", ("let",)), ("console", r"console\.(log|error|warn)", ("console.",)),
    ),
    "php": (
        ("tag", r"<\?php", ("<?php",)), ("variable", r"\$\w+\s*=", ("$",)), ("echo", r"echo\s+", ("echo",)),
    ),
    "ruby": (
        ("def", r"def\s+\w+\s*\(", ("def",)), ("require", r"require\s+['\"]", ("require",)),
        ("puts", r"puts\s+", ("puts",)),
    ),
    "go": (
        ("package", r"package\s+\w+", ("package",)), ("func", r"func\s+\w+\s*\(", ("func",)),
        ("import", r"import\s+\(", ("import",)),
    ),
}
LANGUAGE_SCORES_6 = {
    "java": LANGUAGE_SCORES_8["java"][:4],
    "c": (LANGUAGE_SCORES_8["c"][0], LANGUAGE_SCORES_8["c"][1], LANGUAGE_SCORES_8["c"][3]),
    "cpp": (*LANGUAGE_SCORES_8["cpp"][:3], *LANGUAGE_SCORES_8["cpp"][4:]),
    "python": (LANGUAGE_SCORES_8["python"][0], LANGUAGE_SCORES_8["python"][2], LANGUAGE_SCORES_8["python"][3]),
    "javascript": (*LANGUAGE_SCORES_8["javascript"][:3], ("console", r"console\.(log|error)", ("console.",))),
    "php": LANGUAGE_SCORES_8["php"],
}
# (substrings that decide, exact spellings that decide, result); order decides.
LANGUAGE_NAME_RULES = (
    (("c++", "cxx", "cpp"), (), "cpp"),
    (("java",), (), "java"),
    (("python",), ("py",), "python"),
    (("javascript",), ("js",), "javascript"),
    (("php",), (), "php"),
    (("ruby",), ("rb",), "ruby"),
    (("go",), (), "go"),
    ((), ("c",), "c"),
)
ONE_HOT_LANGUAGES = ("c", "cpp", "java", "python", "javascript", "php", "ruby", "go")
SUFFIX_LANGUAGES = {
    ".c": "c", ".h": "c", ".cc": "cpp", ".cpp": "cpp", ".cxx": "cpp", ".hpp": "cpp", ".java": "java",
    ".py": "python", ".js": "js", ".ts": "ts", ".go": "go", ".rs": "rust",
}

# --- file scan (fixed values) ------------------------------------------------------------------
SOURCE_SUFFIXES = (".c", ".cc", ".cpp", ".cxx", ".h", ".hpp", ".java", ".py", ".js", ".ts", ".go", ".rs")
SCAN_EXCLUDED_DIRS = (".git", "node_modules", ".venv", "__pycache__", "venv", "build", "dist", ".tox")
PR_EXCLUDED_TOP_DIRS = ("app", "scripts", "tests", ".github", "notebooks", "docs", "data", "models", "reports")

# --- security signals (fixed values) -----------------------------------------------------------
DANGEROUS = (
    ("eval", r"\beval\s*\(", ("eval",)),
    ("exec", r"\bexec\s*\(", ("exec",)),
    ("subprocess_shell", r"subprocess\.(run|Popen|call|check_output)\s*\([^)]*shell\s*=\s*True", ("subprocess.",)),
    ("os_system", r"\bos\.system\s*\(|\bsystem\s*\(", ("system",)),
    ("popen", r"\bpopen\s*\(", ("popen",)),
    ("sql_raw", r"(?i)(SELECT|INSERT|UPDATE|DELETE)\s+[^;\n]*(\+|\$\{|%s|format\()", ("select", "insert", "update", "delete")),
    ("pickle", r"\bpickle\.(load|loads)\s*\(", ("pickle.",)),
    ("yaml_load", r"\byaml\.load\s*\(", ("yaml.load",)),
    ("unsafe_c", r"\b(strcpy|strcat|gets|sprintf|memcpy)\s*\(", ("strcpy", "strcat", "gets", "sprintf", "memcpy")),
    ("hardcoded_secret", r"(?i)(password|secret|token|api[_-]?key)\s*=\s*['\"][^'\"]{6,}", ("password", "secret", "token", "api")),
    ("taint_source_scanf", r"\bscanf\s*\(", ("scanf",)),
    ("taint_source_read", r"\bread\s*\([^)]*\)", ("read",)),
    ("taint_source_argv", r"\bargv\b", ("argv",)),
    ("taint_source_getenv", r"\bgetenv\s*\(", ("getenv",)),
)
SANITIZERS = (
    ("parameterized_sql", r"execute\s*\([^)]*(\?|%s)", ("execute",)),
    ("escape", r"\b(escape|htmlspecialchars|sanitize|DOMPurify|bleach\.clean)\s*\(", ("escape", "htmlspecialchars", "sanitize", "DOMPurify", "bleach.clean")),
    ("validation", r"\b(validate|is_valid|schema|pydantic|marshmallow)\b", ("validate", "is_valid", "schema", "pydantic", "marshmallow")),
    ("shell_false", r"subprocess\.(run|Popen|call|check_output)\s*\([^)]*shell\s*=\s*False", ("subprocess.",)),
)
TOKEN_PATTERN = r"[A-Za-z_][A-Za-z0-9_]*|\d+|==|!=|<=|>=|&&|\|\||[^\s]"
IMPORT_PATTERN = ("imports", r"(?m)^\s*(import|from\s+\S+\s+import|#include|using\s+|require\()", ("import", "#include", "using", "require("))

# Families are matched without regard to case; needles are lower case.
FAMILIES = {
    "buffer_overflow": (
        ("strcpy", r"\bstrcpy\s*\(", ("strcpy",)), ("strcat", r"\bstrcat\s*\(", ("strcat",)),
        ("sprintf", r"\bsprintf\s*\(", ("sprintf",)), ("gets", r"\bgets\s*\(", ("gets",)),
        ("scanf", r"\bscanf\s*\(", ("scanf",)), ("vsprintf", r"\bvsprintf\s*\(", ("vsprintf",)),
        ("memcpy", r"\bmemcpy\s*\(", ("memcpy",)), ("memmove", r"\bmemmove\s*\(", ("memmove",)),
    ),
    "format_string": (
        ("printf", r'\bprintf\s*\([^"]*\bvar', ("printf",)), ("fprintf", r'\bfprintf\s*\([^,]+,[^"]*\bvar', ("fprintf",)),
        ("syslog", r'\bsyslog\s*\([^,]+,[^"]*\bvar', ("syslog",)),
    ),
    "injection": (
        ("exec", r"\bexec\s*\(", ("exec",)), ("eval", r"\beval\s*\(", ("eval",)),
        ("system", r"\bsystem\s*\(", ("system",)), ("popen", r"\bpopen\s*\(", ("popen",)),
        ("execve", r"\bexecve\s*\(", ("execve",)), ("select", r"SELECT.*FROM.*WHERE", ("select",)),
        ("insert", r"INSERT\s+INTO", ("insert",)), ("delete", r"DELETE\s+FROM", ("delete",)),
        ("update", r"UPDATE.*SET", ("update",)), ("get", r"\$_GET", ("$_get",)),
        ("post", r"\$_POST", ("$_post",)), ("request", r"\$_REQUEST", ("$_request",)),
    ),
    "memory_mgmt": (
        ("malloc", r"\bmalloc\s*\(", ("malloc",)), ("calloc", r"\bcalloc\s*\(", ("calloc",)),
        ("realloc", r"\brealloc\s*\(", ("realloc",)), ("free", r"\bfree\s*\(", ("free",)),
        ("delete", r"\bdelete\s+", ("delete",)), ("delete_array", r"\bdelete\[\]", ("delete[]",)),
        ("new", r"\bnew\s+\w+", ("new",)),
    ),
    "crypto_weak": (
        ("md5", r"\bMD5\b", ("md5",)), ("sha1", r"\bSHA1\b", ("sha1",)), ("des", r"\bDES\b", ("des",)),
        ("rc4", r"\bRC4\b", ("rc4",)), ("rand", r"\brand\s*\(", ("rand",)), ("srand", r"\bsrand\s*\(", ("srand",)),
    ),
    "xss": (
        ("inner_html", r"innerHTML", ("innerhtml",)), ("write", r"document\.write", ("document.write",)),
        ("jquery_html", r"\$\.html\s*\(", ("$.html",)), ("react_html", r"dangerouslySetInnerHTML", ("dangerouslysetinnerhtml",)),
    ),
    "auth_issues": (
        ("password", r"password", ("password",)), ("secret", r"secret", ("secret",)), ("token", r"token", ("token",)),
        ("api_key", r"api_key", ("api_key",)), ("hardcoded", r"hardcoded", ("hardcoded",)), ("admin", r"admin", ("admin",)),
    ),
}
SAFE_SIGNALS = (
    ("strncpy", r"\bstrncpy\s*\(", ("strncpy",)), ("snprintf", r"\bsnprintf\s*\(", ("snprintf",)),
    ("strlcpy", r"\bstrlcpy\s*\(", ("strlcpy",)), ("fgets", r"\bfgets\s*\(", ("fgets",)),
    ("bounds_check", r"\bbounds_check", ("bounds_check",)), ("sizeof", r"\bsizeof\s*\(", ("sizeof",)),
    ("strncat", r"\bstrncat\s*\(", ("strncat",)), ("prepared", r"\bprepared_statement", ("prepared_statement",)),
    ("parameterized", r"\bparameterized", ("parameterized",)), ("sanitize", r"\bsanitize", ("sanitize",)),
    ("escape", r"\bescape", ("escape",)), ("validate", r"\bvalidate", ("validate",)),
    ("null_check", r"\bif\s*\(.*\bNULL\b", ("null",)), ("nullptr_check", r"\bif\s*\(.*\bnullptr\b", ("nullptr",)),
    ("len_check", r"\bif\s*\(.*\blen\b", ("len",)),
)
REDUCED_FAMILIES = {
    "buffer_overflow": FAMILIES["buffer_overflow"][:4],
    "injection": (*FAMILIES["injection"][:3], ("select", r"SELECT.*FROM", ("select",))),
    "memory_mgmt": (FAMILIES["memory_mgmt"][0], FAMILIES["memory_mgmt"][3], FAMILIES["memory_mgmt"][6]),
    "crypto_weak": (FAMILIES["crypto_weak"][0], FAMILIES["crypto_weak"][1], FAMILIES["crypto_weak"][4]),
}
REDUCED_SAFE_SIGNALS = (SAFE_SIGNALS[0], SAFE_SIGNALS[1], SAFE_SIGNALS[9], SAFE_SIGNALS[11])

# Structure of the text.
BRANCH_PATTERN = r"\b(if|else|elif|while|for|switch|case|catch|&&|\|\|)\b"
POINTER_PATTERN = r"[*&]\w+|->|\w+\[\d+\]"
CAST_PATTERN = r"\(\s*(int|char|void|long|unsigned|float|double)\s*\*?\s*\)"
POINTER_OP_PATTERN = r"[*&]\w+|->"
CALL_PATTERN = r"\w+\s*\("
LOOP_PATTERN = r"\b(for|while|do)\b"
IF_PATTERN = r"\bif\b"
STAR_AMP_PATTERN = r"[*&]"
COMMENT_STARTS = ("//", "#", "/*", "*")

TAINT_SOURCES = (
    ("get", r"\$_GET", ("$_GET",)), ("post", r"\$_POST", ("$_POST",)), ("scanf", r"\bscanf\s*\(", ("scanf",)),
    ("read", r"\bread\s*\(", ("read",)), ("argv", r"\bargv", ("argv",)), ("getenv", r"\bgetenv", ("getenv",)),
)
TAINT_SINKS = (
    ("strcpy", r"\bstrcpy\s*\(", ("strcpy",)), ("exec", r"\bexec\s*\(", ("exec",)), ("eval", r"\beval\s*\(", ("eval",)),
    ("system", r"\bsystem\s*\(", ("system",)), ("select", r"SELECT.*FROM", ("SELECT",)), ("memcpy", r"\bmemcpy\s*\(", ("memcpy",)),
)
TAINT_SANITIZERS = ("sanitizers", r"\bescape\b|\bvalidate\b|\bfilter_var\b", ("escape", "validate", "filter_var"))

# --- weakness rules (fixed values: identifiers, order and patterns) -----------------------------
CWE_RULES = {
    "buffer_overflow": ("CWE-120", (
        ("strcpy", r"\bstrcpy\s*\(", ("strcpy",)), ("strcat", r"\bstrcat\s*\(", ("strcat",)),
        ("gets", r"\bgets\s*\(", ("gets",)), ("sprintf", r"\bsprintf\s*\(", ("sprintf",)),
    )),
    "command_injection": ("CWE-78", (
        ("system", r"\bsystem\s*\(", ("system",)), ("popen", r"\bpopen\s*\(", ("popen",)),
        ("runtime_exec", r"\bRuntime\.getRuntime\(\)\.exec\s*\(", ("Runtime.getRuntime().exec",)),
    )),
    "sql_injection": ("CWE-89", (
        ("double_quoted", r'(?i)"\s*SELECT\s+[^"\n]*\s+FROM\s+[^"\n]*\s+WHERE\s+[^"\n]*"\s*\+', ("select",)),
        ("single_quoted", r"(?i)'\s*SELECT\s+[^'\n]*\s+FROM\s+[^'\n]*\s+WHERE\s+[^'\n]*'\s*\+", ("select",)),
        ("template", r"(?i)`\s*SELECT\s+[^`\n]*\s+FROM\s+[^`\n]*\s+WHERE\s+[^`\n]*\$\{", ("select",)),
        ("sqlite", r"\bsqlite3_exec\s*\(", ("sqlite3_exec",)),
    )),
    "xss": ("CWE-79", (
        ("inner_html", r"\.innerHTML\s*=", (".innerHTML",)), ("write", r"\bdocument\.write\s*\(", ("document.write",)),
        ("template_send", r"res\.send\s*\(\s*`[^`]*\$\{[^`]*`\s*\)", ("res.send",)),
    )),
    "format_string": ("CWE-134", (
        ("printf_variable", r"\bprintf\s*\(\s*[a-zA-Z_]\w*\s*\)\s*;", ("printf",)),
    )),
    "deserialization": ("CWE-502", (
        ("object_stream", r"\bObjectInputStream\b", ("ObjectInputStream",)), ("read_object", r"\breadObject\s*\(", ("readObject",)),
    )),
}
METRIC_CWES = ("CWE-676", "CWE-119", "CWE-1075", "CWE-1104", "CWE-1223")
MAX_COMPLEXITY, MIN_COVERAGE = 10, 50.0
UNKNOWN_CWE = "CWE-Unknown"
FORBIDDEN_CALLS = (
    ("gets", r"\bgets\s*\(", ("gets",)), ("strcpy", r"\bstrcpy\s*\(", ("strcpy",)), ("eval", r"\beval\s*\(", ("eval",)),
)
CI_FAMILIES = (("buffer_overflow", r"\bgets\s*\(", ("gets",)), ("injection", r"\beval\s*\(", ("eval",)))

# --- risk scale, module metrics, evaluation (fixed values) --------------------------------------
MEDIUM_FROM, HIGH_FROM = 0.40, 0.70
METRIC_FIELDS = (
    "lines_of_code", "cyclomatic_complexity", "nesting_depth", "dependency_count", "deprecated_functions",
    "unsafe_patterns", "security_hotspots", "test_coverage", "recent_commits", "past_vulnerabilities",
)
INTEGER_METRICS = tuple(name for name in METRIC_FIELDS if name != "test_coverage")
# The thresholds of the sweep, from 0.05 to 0.95 in steps of about 0.01, to the last digit.
THRESHOLDS = (
    0.05, 0.06, 0.07, 0.08, 0.09, 0.09999999999999999, 0.10999999999999999,
    0.12, 0.13, 0.13999999999999999, 0.14999999999999997, 0.15999999999999998, 0.16999999999999998, 0.18,
    0.19, 0.19999999999999996, 0.20999999999999996, 0.21999999999999997, 0.22999999999999998, 0.24, 0.24999999999999994,
    0.25999999999999995, 0.26999999999999996, 0.27999999999999997, 0.29, 0.3, 0.30999999999999994, 0.31999999999999995,
    0.32999999999999996, 0.33999999999999997, 0.3499999999999999, 0.35999999999999993, 0.36999999999999994, 0.37999999999999995, 0.38999999999999996,
    0.3999999999999999, 0.4099999999999999, 0.41999999999999993, 0.42999999999999994, 0.43999999999999995, 0.4499999999999999, 0.4599999999999999,
    0.4699999999999999, 0.4799999999999999, 0.48999999999999994, 0.49999999999999994, 0.5099999999999999, 0.5199999999999999, 0.5299999999999999,
    0.5399999999999999, 0.5499999999999999, 0.5599999999999999, 0.57, 0.58, 0.59, 0.6,
    0.61, 0.62, 0.63, 0.6399999999999999, 0.6499999999999999, 0.6599999999999999, 0.6699999999999999,
    0.6799999999999999, 0.69, 0.7, 0.71, 0.72, 0.73, 0.74,
    0.7499999999999999, 0.7599999999999999, 0.7699999999999999, 0.7799999999999999, 0.7899999999999999, 0.7999999999999999, 0.8099999999999999,
    0.82, 0.83, 0.84, 0.8499999999999999, 0.8599999999999999, 0.8699999999999999, 0.8799999999999999,
    0.8899999999999999, 0.8999999999999999, 0.9099999999999999, 0.9199999999999999, 0.9299999999999999, 0.94, 0.95,
)
MIN_ACCURACY = 0.80
DECISION_THRESHOLD, PR_THRESHOLD = 0.50, 0.50

# --- line ends and white space (fixed values) ----------------------------------------------------
LINE_ENDS = r"\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029"
SPACE = r"\s\x1c-\x1f"
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- parameter grids of the trainers' searches (fixed values; tree depth stops at 30, None is that depth) ---
FOREST_GRID = {"numTrees": (400, 600, 800), "maxDepth": (30,), "featureSubsetStrategy": ("sqrt", "log2")}
FOREST_POSITIVE_WEIGHT = 2.5
SEARCH_DRAWS, SEARCH_FOLDS, SCORE_FOLDS = 10, 3, 5
TRAINER_TEST_FRACTION = 0.25
