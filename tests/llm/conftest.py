"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import re

import pytest

EXTRA = "key string, n long, cls long, x double, positive boolean, row long, component long, score double, length int, rank long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes documents of (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), *[None] * 10) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make


@pytest.fixture(scope="session")
def awkward():
    prose = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, prose), (5, prose), (5, prose), (6, prose.upper()), (7, "one two"), (8, "one two"), (None, prose),
        (9, prose.replace("alpha", "αλφα")), (10, " ".join(f"w{i}" for i in range(30_000))), (11, "é" * 60), (12, "é" * 60), (-3, "x" * 500), (13, "x" * 70), (14, "a" * 49),
    ]


@pytest.fixture(scope="session")
def small_documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)
