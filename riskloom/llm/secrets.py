"""Secrets in texts: fixed patterns, and values in credential context that are costly to guess.

A value behind a credential word (``password: x``, ``pwd=x``, ``the token is x``, ``Bearer x``), in a tag or attribute that is named so
(``<password>x</password>``) or before the host of a URL (``//user:x@host``) is split into words, dates, repeats, keyboard walks and brute-force characters. A dynamic programme finds the split with
the fewest guesses. Every value is judged by it. Values that cost much are spans of kind ``guess``; placeholders,
words, dates and walks are cheap and are left alone. A value of letters alone that reads like a word of some language is
one pick from a large dictionary, and dearer if it is longer than most words; two such words joined by a hyphen are a little
dearer than one. A value in quotes goes to the closing quote of its line, blanks included. Where one value lies in another
context's value (``Authorization: Bearer x``), each is judged.

Defined results: a null or empty text has no spans; spans never cross documents; values inside base spans are reported
once, as base spans, and those that reach further are spans beside them; repeated rows give repeated results; other
columns are kept out.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values: the base kinds in their order, with the characters that a match needs. ---
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # whole runs, as [0-9a-f]+ takes them, of 32 characters at least
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

# Short words follow a character that is no letter, or an edge as in ``dbPass`` and ``OAuth``; the others any character.
SECRET_WORDS = (
    r"passw(?:or)?d|passphrase|passcode|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|"
    r"contrase(?:\xf1|n)a|passwort|kennwort|mot de passe|wachtwoord|senha|пароль"
)
CONTEXT = re.compile(
    rf"(?:{SECRET_WORDS}|"
    r"(?:(?<![a-z])|(?<=(?-i:[a-z]))(?=(?-i:[A-Z]))|(?<=(?-i:[A-Z]))(?=(?-i:[A-Z][a-z])))"
    r"(?:pass|pw|auth(?:orization)?|bearer|login))[\"']?(?:\s*(?:=>|->|:=|[:=])|\s+is)\s*"
    r"(?:\"([^\"\n]+)\"|'([^'\n]+)'|`([^`\n]+)`|[\"'`]?([^\s\"'`<>]+))",
    re.IGNORECASE,
)
SCHEME = re.compile(r"(?<![a-z])(?:bearer|basic)\x20+([A-Za-z0-9+/_.~=-]+)", re.IGNORECASE | re.ASCII)
TAG = re.compile(rf"<[\w:.-]{{0,40}}(?:{SECRET_WORDS})[\w:.-]{{0,40}}(?:\s[^<>]*)?>\s*([^\s<>](?:[^<>]*[^\s<>])?)\s*</", re.IGNORECASE)
USERINFO = re.compile(r"://[^\s/:@\"'<>]*:([^\s/@\"'<>]+)@")
LONGEST_CONTEXT = 24  # characters of a value in which the context of a next value may begin
CONTEXT_WORDS = (
    "pass", "pwd", "pw", "secret", "token", "api", "access", "private", "credential", "auth", "bearer", "basic", "login",
    "contrase", "kennwort", "wachtwoord", "senha", "пароль", "://",
)

# Common parts of passwords, the most common first.
WORDS = (
    "password", "passwd", "qwerty", "admin", "letmein", "welcome", "login", "master", "secret", "token", "user", "test",
    "guest", "root", "changeme", "default", "example", "sample", "dummy", "placeholder", "your", "here", "none", "null",
    "true", "false", "undefined", "todo", "empty", "value", "string", "key", "api", "access", "private", "public",
    "system", "server", "database", "config", "local", "host", "service", "client", "account", "name", "number", "code",
    "dragon", "monkey", "shadow", "sunshine", "princess", "football", "baseball", "superman", "batman", "trustno",
    "hello", "freedom", "whatever", "summer", "winter", "spring", "autumn", "monday", "friday", "january", "august",
    "love", "angel", "flower", "cookie", "computer", "internet", "google", "mail", "home", "work", "office", "company",
    "the", "and", "for", "with", "not", "this", "that", "from", "required", "invalid", "incorrect", "missing", "expired",
    "reset", "change", "please", "enter", "valid", "strong", "weak", "new", "old", "same", "wrong", "right", "only",
)
RANK = {word: rank for rank, word in enumerate(WORDS, 1)}
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("@4301$57!", "aaeoissti")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
NEXT = {pair for row in ROWS for line in (row, row[::-1]) for pair in zip(line, line[1:])}
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
DATE_COST = math.log10(365.25 * 120)
YEAR_COST = math.log10(120)
JOIN_COST = math.log10(4)  # each further part of a value multiplies the guesses
LEAST_LOG10 = 8.0

# Words outside the list: each letter with those that follow it in words of European languages.
FOLLOWS = (
    "aabcdefgijklmnopqrstuvwxyz babcdeijlmnoprstuvy cacehikloqrstuy dabdefgijlmnorstuvwxyz eabcdefghijklmnopqrstuvwxyz fabefijlorstuy "
    "gabdeghiklmnorstuyz habefiklmnorstuwy iabcdefghijklmnopqrstuvwxz jadeosu kadeilnoprstuwy lacdefghijlnoprstuvyz "
    "mabefhilmnopstuy nacdefghijklmnopqrstuvwyz oabcdefghijklmnoprstuvwxyz pabcdefhikloprstuwy qu racdefghijklmnopqrstuvwyz "
    "sabcdefghiklmnopqrstuvwyz tabcdefghijlmnoprstuwyz uabcdefghijlmnopqrstuvwxyz vaeioruy wadehiklmnorstuy xacehioptu "
    "yabcdegilmnoprstvwxz zabegilnotuwyz"
)
PAIRS = {group[0] + after for group in FOLLOWS.split() for after in group[1:]}
NO_VOWELS = re.compile(r"[bcdfghjklmnpqrstvwxz]{6}")
DICTIONARY_COST = 6.0
USUAL_LENGTH = 12
COMPOUND_COST = 1.0  # of a word joined to another by a hyphen
LENGTH_COST = 0.25  # for each letter beyond the usual length


def _character(c: str) -> float:
    """Guesses for one brute-force character, as a power of ten."""
    return 1.0 if c.isdigit() else math.log10(26) if c.islower() else math.log10(36) if c.isupper() else math.log10(33)


def guess_cost(value: str) -> float:
    """log10 of the guesses of the cheapest split of a value; 0 for an empty one.

    Work is linear in the length: words and dates are short, and repeats and walks are taken as whole runs
    or their prefixes by going on with the part before.
    """
    n = len(value)
    if not n:
        return 0.0
    lower = value.lower()
    if len(lower) != n:  # a few letters grow when lowered
        lower = value
    plain = lower.translate(LEET)
    dates: dict[int, list[tuple[int, float]]] = {}
    for start in range(n):
        if value[start].isdigit():
            m = DATE.match(value, start)
            if m:
                dates.setdefault(m.end(), []).append((start, DATE_COST if m.end() - start > 4 else YEAR_COST))
            if re.match(r"(?:19|20)\d\d", value[start : start + 4]):
                dates.setdefault(start + 4, []).append((start, YEAR_COST))
    best = [0.0] + [math.inf] * n  # cheapest split of the first i characters, the join of a next part included
    brute = [math.inf] * (n + 1)  # the same, with a last part of brute force that may go on
    walk = [math.inf] * (n + 1)  # and with a keyboard walk
    repeat = [math.inf] * (n + 1)  # and with one character repeated
    for i in range(1, n + 1):
        c = value[i - 1]
        cost = _character(c)
        brute[i] = min(best[i - 1], brute[i - 1]) + cost
        same = i > 1 and c == value[i - 2]
        repeat[i] = min(best[i - 1] + cost + 0.5, repeat[i - 1] + 0.05 if same else math.inf)
        stepped = i > 1 and (lower[i - 2], lower[i - 1]) in NEXT
        walk[i] = min(best[i - 1] + math.log10(40) + 0.5, walk[i - 1] + 0.15 if stepped else math.inf)
        found = min(brute[i], repeat[i], walk[i])
        for length in range(3, min(LONGEST_WORD, i) + 1):
            rank = RANK.get(lower[i - length : i])
            other = RANK.get(plain[i - length : i])
            if rank or other:
                bits = math.log10(rank or other * 4)
                cased = 0.0 if value[i - length : i].islower() else 0.6
                found = min(found, best[i - length] + bits + cased)
        for start, cost in dates.get(i, ()):
            found = min(found, best[start] + cost)
        best[i] = found + (JOIN_COST if i < n else 0.0)
    return best[n]


def word_cost(value: str) -> float:
    """log10 of the guesses of a value that reads like a word: letters of one case or with a capital first, in usual pairs."""
    parts = value.split("-")
    if len(parts) == 2 and all(parts):  # a compound, as prose has them
        return max(map(word_cost, parts)) + COMPOUND_COST
    if not value.isalpha() or not (value[1:].islower() or value.isupper()):
        return math.inf
    plain = "".join(c for c in unicodedata.normalize("NFD", value.casefold()) if not unicodedata.combining(c))
    unusual = any(a.isascii() and b.isascii() and a + b not in PAIRS for a, b in zip(plain, plain[1:]))
    if unusual or NO_VOWELS.search(plain):
        return math.inf
    return DICTIONARY_COST + LENGTH_COST * max(0, len(value) - USUAL_LENGTH)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start and then kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def guess_spans(text: str, base: list[tuple[str, int, int]], least: float = LEAST_LOG10) -> list[tuple[int, int, float]]:
    """Values in credential context that cost 10**least guesses or more and reach beyond the base spans."""
    lower = text.lower()
    if not any(word in lower for word in CONTEXT_WORDS):
        return []
    found, taken = [], []
    for s, e in sorted((s, e) for _, s, e in base):  # base spans that overlap or touch are one
        if taken and s <= taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    judged = 0
    for start, end in sorted(set(_values(text, lower)), key=lambda v: (v[0], -v[1])):
        if end <= judged:  # a part of a value that has been judged
            continue
        judged = end
        while end > start and text[end - 1] in ".,;:!?)]}":
            end -= 1
        at = bisect.bisect_right(taken, (start, len(text))) - 1
        if end == start or (at >= 0 and end <= taken[at][1]):
            continue
        cost = min(guess_cost(text[start:end]), word_cost(text[start:end]))
        if cost >= least:
            found.append((start, end, cost))
    return found


def _values(text: str, lower: str) -> Iterator[tuple[int, int]]:
    """Start and end of the values in credential context; a value may hold the context of another."""
    m = CONTEXT.search(text)
    while m:
        yield m.span(m.lastindex)
        m = CONTEXT.search(text, max(m.start(m.lastindex), m.end(m.lastindex) - LONGEST_CONTEXT))
    if "bearer" in lower or "basic" in lower:
        yield from (m.span(1) for m in SCHEME.finditer(text))
    if "</" in text:
        yield from (m.span(1) for m in TAG.finditer(text))
    if "://" in text:
        yield from (m.span(1) for m in USERINFO.finditer(text))


def scan(text: str, least: float = LEAST_LOG10) -> list[tuple[str, int, int, float | None]]:
    """All spans as (kind, start, end, cost of guessing), by start and then kind."""
    base = base_spans(text)
    spans = [(*s, None) for s in base] + [("guess", s, e, c) for s, e, c in guess_spans(text, base, least)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def redact(text: str, least: float = LEAST_LOG10) -> str:
    """The text with each secret replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end, _ in scan(text, least):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join(out) + text[at:] if out else text


SPAN = "kind string, start int, end int, log10_guesses double"


def find_secrets(docs: DataFrame, least: float = LEAST_LOG10) -> DataFrame:
    """doc_id and the array ``secrets`` of (kind, start, end, log10_guesses) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("log10_guesses", pa.float64())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "log10_guesses"), s)) for s in scan(text or "", least)]
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "secrets"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, secrets array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")


def redact_documents(docs: DataFrame, least: float = LEAST_LOG10) -> DataFrame:
    """The documents with secrets in ``text`` replaced and ``n_chars`` counted anew; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redact(t, least) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def report(docs: DataFrame, least: float = LEAST_LOG10) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans of each document."""
    def joined(kinds: tuple[str, ...]):
        spans = F.filter("secrets", lambda s: s.kind.isin(*kinds))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long")

    return find_secrets(docs, least).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"), joined(KINDS).alias("spans"),
        count("guess").alias("n_guess"), F.array_max(F.transform("secrets", lambda s: s.log10_guesses)).alias("log10_guesses"),
    )
