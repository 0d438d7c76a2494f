import bz2
import gzip
import json
import math
import tempfile
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.functions import normalise as n
from riskloom.operators import dedup, vectorise
from riskloom.plans.prepare import clean_corpus, clean_table
from riskloom.sources import files, health, nested, sinks, tables, text_lines


@pytest.fixture()
def folder():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


CODE = "int value(int a) { return a * 2; } // long enough"


def test_lines_keep_order_and_survive_bad_input(spark, folder):
    lines = [json.dumps({"func": f"{CODE} {i}", "target": i % 2}).encode() for i in range(40)]
    (folder / "b.jsonl").write_bytes(b"\n".join([*lines[20:], b"", b"   ", b'{"func": ', b'{"func": "bad \xff byte, long enough to keep", "target": 1}']))
    (folder / "a.jsonl").write_bytes(b"\n".join(lines[:20]))
    read = text_lines.json_lines(spark, str(folder))
    rows = text_lines.func_target(read).orderBy("row_pos").collect()
    assert [r.raw_code for r in rows[:40]] == [f"{CODE} {i}" for i in range(40)]
    assert rows[40].raw_code == "bad � byte, long enough to keep"
    assert text_lines.load_health(read).agg(F.sum("lines"), F.sum("errors")).first()[:] == (42, 1)


def test_missing_source_is_skipped(spark, folder):
    (folder / "a.jsonl").write_text("{}")
    assert text_lines.readable(spark, {"a": str(folder), "gone": str(folder / "none")}) == {"a": str(folder)}


def test_first_source_wins_for_equal_code(spark, folder):
    for name, label in (("one", 1), ("two", 0)):
        (folder / name).mkdir()
        (folder / name / "x.jsonl").write_text(json.dumps({"code": f"// SAFE: {CODE}", "label": label, "language": "C++"}))
    frames = {k: text_lines.standard_records(text_lines.json_lines(spark, str(folder / k)), k).drop("source") for k in ("one", "two")}
    rows = clean_table(dedup.union_sources(frames)).collect()
    assert [(r.source, r.is_vulnerable, r.language) for r in rows] == [("one", 1, "cpp")]
    assert rows[0].code_length == len(rows[0].raw_code) and rows[0].raw_code.startswith("// int")


def test_boolean_and_text_labels_of_one_file(spark, folder):
    records = [{"func": CODE, "target": v} for v in (True, False, 1, 0, 2, "yes", "1.0", None)]
    (folder / "a.jsonl").write_text("\n".join(map(json.dumps, records)))
    rows = text_lines.standard_records(text_lines.json_lines(spark, str(folder)), "s").orderBy("row_pos")
    assert [r[0] for r in rows.select(n.label_from_text(F.col("is_vulnerable"))).collect()] == [1, 0, 1, 0, None, 1, None]


def test_pairs_from_an_array(spark, folder):
    (folder / "a.json").write_text(json.dumps([{"func_before": "old", "func": "new"}, {"func_before": "", "func": "only"}, {"func_before": None}]))
    rows = nested.from_pairs(nested.json_array(spark, str(folder / "a.json"))).collect()
    assert sorted((r.raw_code, r.is_vulnerable) for r in rows) == [("new", 0), ("old", 1), ("only", 0)]


def test_csv_with_line_breaks(spark, folder):
    (folder / "a.csv").write_text('code,safety,language\n"int a;\nint ""b"";",vulnerable,c\n"x, y",safe,c\n,vulnerable,c\nz,,c\n')
    rows = tables.safety_records(tables.quoted_csv(spark, str(folder / "a.csv"))).collect()
    assert [(r.raw_code, r.is_vulnerable) for r in rows] == [('int a;\nint "b";', 1), ("x, y", 0)]


def test_source_tree(spark, folder):
    for path, text in {"src/a.C": "int a;", "src/b.txt": "text", "build/c.py": "x", "src/node_modules/d.js": "x", "e.rs": "  \n", "f.py": "ok é"}.items():
        (folder / path).parent.mkdir(parents=True, exist_ok=True)
        (folder / path).write_text(text)
    (folder / "g.go").write_bytes(b"bad \xff")
    rows = {r.path: r.raw_code for r in files.source_tree(spark, str(folder)).collect()}
    assert rows == {"src/a.C": "int a;", "f.py": "ok é", "g.go": "bad �"}


def test_changed_file_list(spark, folder):
    (folder / "list.txt").write_text("﻿src/a.c\n\n  src/b.c \nsrc/a.c\n", encoding="utf-8")
    assert sorted(r.path for r in files.changed_files(spark, str(folder / "list.txt")).collect()) == ["src/a.c", "src/b.c"]


def test_term_counts_and_ngrams_against_plain_python(spark):
    texts = ["the cat the dog", "", "a b", "Été été ete", "x" * 3 + " yy " + "x" * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(
        vectorise.word_ngrams(vectorise.plain_words(F.col("t")), 1, 3).alias("g"), vectorise.char_ngrams(F.col("t"), 3, 6).alias("c"),
        vectorise.boundary_ngrams(F.col("t"), 3, 5).alias("b")).withColumn("n", vectorise.term_counts(F.col("g"))).collect()
    for text, row in zip(texts, rows):
        words = text.lower().replace("é", "e").split()
        grams = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        assert row.g == grams
        assert {x.term: x.tf for x in row.n} == {g: grams.count(g) for g in grams}
        low = text.lower()
        assert row.c == [low[i : i + k] for k in range(3, 7) for i in range(len(low) - k + 1)]
        expected = []
        for word in low.split():
            padded = f" {word} "
            for k in range(3, 6):
                expected.append(padded[:k])
                expected += [padded[i : i + k] for i in range(1, len(padded) - k + 1)]
                if len(padded) <= k:
                    break
        assert sorted(row.b) == sorted(expected)


def test_idf_formula(spark):
    df = spark.createDataFrame([(0, ["a", "a", "b"]), (1, ["a"])], "i int, w array<string>")
    model = vectorise.fit_tfidf(df, "w", 10)
    idf = {"a": math.log(3 / 3) + 1, "b": math.log(3 / 2) + 1}
    assert dict(zip(model.terms, model.idf)) == pytest.approx(idf)
    rows = {(r.i, r.term): r.weight for r in model.long(df, "w", "i").collect()}
    norm = math.hypot(2 * idf["a"], idf["b"])
    assert rows == pytest.approx({(0, "a"): 2 * idf["a"] / norm, (0, "b"): idf["b"] / norm, (1, "a"): 1.0})
    vector = model.vectors(df, "w", "v").orderBy("i").first().v
    assert list(vector.toArray()) == pytest.approx([2 * idf["a"] / norm, idf["b"] / norm])


LABELS = {"true": 1, "false": 0, "1.0": 1, "0.0": 0, "1": 1, '"1"': 1, "null": None, '"x"': None}


def test_labels_of_every_loader(spark, tmp_path):
    """Booleans and whole decimals are labels as integers are."""
    code = "c" * 30
    for number, (label, want) in enumerate(LABELS.items()):
        for loader, field in (("func_target", "target"), ("function_source", "label"), ("code_first", "label"), ("generic", "target"), ("func_label", "label"), ("passthrough", "is_vulnerable")):
            name = "raw_code" if loader == "passthrough" else "func"
            path = tmp_path / f"{number}-{loader}.jsonl"
            path.write_text(f'{{"{name}": "{code}", "{field}": {label}}}\n')
            rows = [r.is_vulnerable for r in getattr(text_lines, loader)(text_lines.json_lines(spark, str(path))).collect()]
            missing = {"func_label": [], "passthrough": [None]}.get(loader, [0])
            assert rows == ([want] if want is not None else missing), (loader, label)


def test_half_labels_are_none(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"func": "abc", "label": 0.5}\n')
    assert text_lines.func_label(text_lines.json_lines(spark, str(tmp_path))).collect() == []


def test_positions_of_a_long_file_do_not_repeat(spark, tmp_path):
    lines = (1 << 24) + 1000
    (tmp_path / "long.txt.gz").write_bytes(gzip.compress(b"1\n" * lines, 1))  # one split
    placed = text_lines.with_position(spark.read.text(str(tmp_path)))
    counted = placed.agg(F.count_distinct("row_pos").alias("n"), F.max("row_pos.row").alias("last")).first()
    assert counted.n == lines and counted.last == lines - 1


def test_broken_files_are_told(spark, folder):
    data = "\n".join(json.dumps({"func": f"{CODE} {i}", "target": 1}) for i in range(2000)).encode()
    packed = gzip.compress(data)
    forms = {
        "good.gz": packed, "two.gz": packed + gzip.compress(b"{}"), "padded.gz": packed + b"\0" * 700, "cut.gz": packed[:-9], "half.gz": packed[: len(packed) // 2], "flipped.gz": packed[:200] + b"\xff\x00\xff" + packed[203:],
        "text.gz": b"no archive", "empty.gz": b"", "good.bz2": bz2.compress(data), "cut.bz2": bz2.compress(data)[:-20], "plain.json": data,
    }
    for name, content in forms.items():
        (folder / name).write_bytes(content)
    found = {Path(r.path).name: r.problem for r in health.broken_files(spark, str(folder)).collect()}
    assert set(found) == {"cut.gz", "half.gz", "flipped.gz", "text.gz", "cut.bz2"}
    assert found["half.gz"] == "truncated" and found["text.gz"].startswith("damaged")
    assert health.broken_files(spark, str(folder / "plain.json")).collect() == []


def test_good_files_are_read_beside_broken_ones(spark, folder):
    lines = lambda a, b: "\n".join(json.dumps({"func": f"{CODE} {i}", "target": i % 2}) for i in range(a, b)).encode()
    tree = lambda i: {"cve_id": f"C{i}", "commits": [{"commit_hash": "h", "files": [{"file_path": "p", "vulnerable_functions": [{"func_before": f"{CODE} tree {i}"}]}]}]}
    arrays = [json.dumps([tree(i) for i in range(a, a + 300)]).encode() for a in (0, 300)]
    tables_ = [("code,safety,language\n" + "".join(f'"{CODE} row {i}",safe,c\n' for i in range(a, a + 300))).encode() for a in (0, 300)]
    for name, parts in {"lines": (lines(0, 300), lines(300, 600)), "megavul": arrays, "cvefixes": tables_}.items():
        (folder / name).mkdir()
        (folder / name / "a.gz").write_bytes(gzip.compress(parts[0]))
        (folder / name / "b.gz").write_bytes(gzip.compress(parts[1], 0)[:-4000])
        (folder / name / "c.gz").write_bytes(b"no archive")
    corpus = clean_corpus(spark, {name: str(folder / name) for name in ("lines", "megavul", "cvefixes")})
    profile = {r.source: (r.input_records, r.errors) for r in corpus.sources.collect()}
    assert {name: errors for name, (_, errors) in profile.items()} == {"lines": 2, "megavul": 2, "cvefixes": 2}
    assert all(300 < records < 600 for records, _ in profile.values())
    assert corpus.table.count() == sum(records for records, _ in profile.values())


@pytest.mark.parametrize("first", [4, 0.01])
def test_vocabulary_is_exact_however_few_buckets_come_first(spark, monkeypatch, first):
    """Many terms in few buckets, so that rare terms hide in heavy buckets and ties stand at the cut."""
    monkeypatch.setattr(vectorise, "BUCKETS_PER_TERM", 1)
    monkeypatch.setattr(vectorise, "FIRST_BUCKETS_PER_TERM", first)
    docs = [[f"t{(i * i + k * 7) % (11 + i % 397)}" for k in range(i % 23)] for i in range(900)]
    df = spark.createDataFrame([(d,) for d in docs], "g array<string>")
    totals, spread = Counter(t for d in docs for t in d), Counter(t for d in docs for t in set(d))
    for size, low, high in ((100, 1, 1.0), (200, 30, 1.0), (100, 2, 0.05), (10_000, 1, 1.0)):
        fits = [t for t in totals if spread[t] >= low and spread[t] <= high * len(docs)]
        expected = sorted(fits, key=lambda t: (-totals[t], t))[:size]
        rows = vectorise.vocabulary(df, "g", int(size), low, high).collect()
        assert [(r.term, r.total_count, r.doc_count) for r in rows] == [(t, totals[t], spread[t]) for t in expected]
    assert vectorise.vocabulary(df.limit(0), "g", 5).collect() == []


def test_a_file_for_each_row(spark, folder):
    rows = [("one",), ("two\nlines",), ("",), (None,), ("é€𝄞",), ("one",)]
    for root in (str(folder / "a b"), f"file://{folder}/c"):
        sinks.write_each(spark.createDataFrame(rows, "t string").repartition(3), "t", root)
        below = Path(root.removeprefix("file://"))
        found = sorted(f.read_text() for f in below.rglob("*.txt"))
        assert found == sorted(f"{t or ''}\n" for t, in rows)
        assert not [f for f in below.rglob("*") if f.name.startswith("_") or f.name.endswith(".crc")]
        assert sorted(r.raw_code for r in files.source_tree(spark, root, (".txt",)).collect()) == sorted(f"{t}\n" for t, in rows if t)
    sinks.write_each(spark.createDataFrame([], "t string"), "t", str(folder / "none"))
    assert files.source_tree(spark, str(folder / "none"), (".txt",)).collect() == []
