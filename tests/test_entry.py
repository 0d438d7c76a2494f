"""The entry module works with and without the optional training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q), len(e.oracle_sql()))"


def counts(folder):
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return [int(x) for x in out.stdout.split()]


def copy_without(folder, *left_out):
    def ignore(directory, names):
        inside = os.path.relpath(directory, ROOT)
        return [n for n in names if n in {".git", "__pycache__"} or os.path.normpath(os.path.join(inside, n)) in left_out]

    shutil.copytree(ROOT, folder, ignore=ignore)
    return folder


def test_imports_without_the_subpackage(tmp_path):
    from checks.registry import ORACLE, QUERIES

    bare = copy_without(tmp_path / "bare", os.path.join("riskloom", "llm"), os.path.join("tests", "llm"), "corpus_pipeline.py")
    assert counts(bare) == [len(QUERIES), 0, len(ORACLE)]


def test_imports_with_the_pipeline_left_behind(tmp_path):
    from checks.registry import ORACLE, QUERIES

    bare = copy_without(tmp_path / "left", os.path.join("riskloom", "llm"), os.path.join("tests", "llm"))
    assert counts(bare) == [len(QUERIES), 0, len(ORACLE)]


def test_imports_with_an_empty_folder_left(tmp_path):
    from checks.registry import ORACLE, QUERIES

    bare = copy_without(tmp_path / "empty", os.path.join("riskloom", "llm"), os.path.join("tests", "llm"))
    os.makedirs(bare / "riskloom" / "llm" / "__pycache__")
    assert counts(bare) == [len(QUERIES), 0, len(ORACLE)]
