"""All checked queries: name -> (spark, sf_dir) -> DataFrame, and the SQL that must agree."""

from __future__ import annotations

from importlib import import_module

SECTIONS = (
    "sources", "normalise", "filters", "sets", "features", "text", "rules", "aggregates", "sampling", "models", "evaluation", "stream",
)
QUERIES, ORACLE = {}, {}
for section in SECTIONS:
    for name, (build, sql) in import_module(f"checks.{section}").CASES.items():
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
