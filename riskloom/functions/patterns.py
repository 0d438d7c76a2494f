"""Pattern catalogues compiled to column expressions.

Every pattern runs with ``(?dU)``: Unicode character classes, and only ``\\n`` as a line end.
A regex is tried only on texts that hold one of its needles, so on clean text a whole catalogue
costs a few substring searches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Pattern = tuple[str, str, Sequence[str]]


def regex(pattern: str) -> Column:
    return F.lit("(?dU)" + pattern)


def folded(code: Column) -> Column:
    """Lower case in which every character that folds to an ASCII letter has become that letter."""
    return F.lower(F.translate(code, "ſıİ", "sii"))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


class CodeText:
    """A text column with its folded form, and the two questions asked of it."""

    def __init__(self, code: Column, lowered: Column | None = None):
        self.code = F.coalesce(code, F.lit(""))
        self.lowered = folded(self.code) if lowered is None else lowered

    def _gate(self, pattern: Pattern, ignore_case: bool) -> tuple[Column, Column]:
        name, expression, needles = pattern
        if ignore_case and not expression.startswith("(?i)"):
            expression = "(?i)" + expression
        subject = self.lowered if expression.startswith("(?i)") else self.code
        return any_of(F.contains(subject, F.lit(needle)) for needle in needles), regex(expression)

    def hit(self, pattern: Pattern, ignore_case: bool = False) -> Column:
        gate, expression = self._gate(pattern, ignore_case)
        return gate & F.regexp_like(self.code, expression)

    def occurrences(self, pattern: Pattern, ignore_case: bool = False) -> Column:
        gate, expression = self._gate(pattern, ignore_case)
        return F.when(gate, F.regexp_count(self.code, expression)).otherwise(F.lit(0)).cast("bigint")

    def total(self, patterns: Iterable[Pattern], ignore_case: bool = False) -> Column:
        return reduce(lambda a, b: a + b, [self.occurrences(p, ignore_case) for p in patterns])

    def names(self, patterns: Iterable[Pattern], ignore_case: bool = False) -> Column:
        """Names of the patterns that match, in catalogue order."""
        return F.array_compact(F.array(*[F.when(self.hit(p, ignore_case), F.lit(p[0])) for p in patterns]))

    def first(self, probes: Iterable[Pattern], default: str) -> Column:
        """Name of the first probe that matches."""
        chain = F
        for probe in probes:
            chain = chain.when(self.hit(probe), F.lit(probe[0]))
        return chain.otherwise(F.lit(default))


def count(code: Column, expression: str) -> Column:
    return F.regexp_count(code, regex(expression)).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` reads it.

    A lambda body that reads an outer expression would compute it again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- what must stand in a text for a pattern to match -------------------------------------------
GRAM = 4


def literal_runs(pattern: str) -> list[list[str]] | None:
    """For each alternative of a pattern, runs of characters that every match of it holds. None if the pattern cannot be read for sure.

    Only what stands outside groups counts, and no character that may be left out or repeated.
    """
    if "\\Q" in pattern or "(?x" in pattern or "(*" in pattern:
        return None
    branches, runs, run = [], [], ""
    at, depth, size = 0, 0, len(pattern)

    def close() -> None:
        nonlocal run
        if run:
            runs.append(run)
        run = ""

    while at < size:
        c, taken, letter = pattern[at], 1, None
        if c == "\\":
            following = pattern[at + 1 : at + 2]
            if not following:
                return None
            taken = 2
            if not following.isalnum():
                letter = following
            elif following in "xupPNck0":  # codes of characters, properties, names: read over them as unknown
                if depth == 0:
                    close()
                brace = pattern[at + 2 : at + 3] == "{"
                taken = pattern.find("}", at) - at + 1 if brace else {"x": 4, "u": 6, "c": 3}.get(following, 3)
                if taken <= 0:
                    return None
        elif c == "[":
            end = _class_end(pattern, at)
            if end < 0:
                return None
            taken = end - at
        elif c == "(":
            if depth == 0:
                flags = pattern[at:].partition(")")[0]
                if flags.startswith("(?") and flags[2:].isalpha() and at == 0:
                    at += len(flags) + 1
                    continue
            depth += 1
        elif c == ")":
            depth -= 1
            if depth < 0:
                return None
        elif c == "|" and depth == 0:
            close()
            branches.append(runs)
            runs, at = [], at + 1
            continue
        elif c not in ".^$*+?{}":
            letter = c
        at += taken
        quantifier = pattern[at : at + 1] in ("*", "?", "{", "+")
        if depth == 0 and letter is not None and not quantifier:
            run += letter
            continue
        if depth == 0 and letter is not None and pattern[at : at + 1] == "+":
            run += letter  # once at least, but what follows need not be next to it
        if depth == 0 or c == "(":
            close()
        if pattern[at : at + 1] == "{":
            end = pattern.find("}", at)
            if end < 0:
                return None
            at = end + 1
        while pattern[at : at + 1] in ("*", "?", "+") and pattern[at : at + 1]:
            at += 1
    close()
    return None if depth else [*branches, runs]


def _class_end(pattern: str, at: int) -> int:
    """The place behind a character class that begins at ``at``; classes may hold classes."""
    depth, first = 0, True
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 2
            first = False
            continue
        if c == "[":
            depth += 1
            at += 1
            if pattern[at : at + 1] == "^":
                at += 1
            first = True
            continue
        if c == "]" and not first:
            depth -= 1
            if depth == 0:
                return at + 1
        first = False
        at += 1
    return -1


def needles(pattern: str) -> list[str] | None:
    """Short strings of which a text in lower case holds one if the pattern matches it; None if there are none that could tell."""
    branches = literal_runs(pattern)
    if not branches:
        return None
    found = []
    for runs in branches:
        best = max((r for r in runs if r.isascii()), key=len, default="").lower()
        if len(best) < GRAM:
            return None
        found.append(best[(len(best) - GRAM) // 2 :][:GRAM])
    return found
