"""Files read in small ranges must give what one reader of the whole file gives."""

import csv
import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources import nested, tables

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("func_before", T.StringType()), T.StructField("func", T.StringType()), T.StructField(
    "deep", T.ArrayType(T.StructType([T.StructField("x", T.StringType())])))])
PARTS = ["}", "{", "[", "]", '"', "\\", "\n", "\r\n", ",", "a", "é", '\\"', "}}", '{"id": 1}', "]}", "日", " ", "\t"]


@pytest.fixture()
def narrow(spark):
    """Ranges of 61 bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "61")
    yield
    spark.conf.set(key, old)


def objects(rng, n):
    word = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(12)))
    return [{"id": i, "func_before": rng.choice([None, word()]), "func": word(), "deep": [{"x": word()} for _ in range(rng.randrange(3))]} for i in range(n)]


def read_array(spark, path):
    rows = nested.json_array(spark, str(path), ITEM, corrupt=True, position=True).orderBy("row_pos").collect()
    return [json.loads(json.dumps({"id": r.id, "func_before": r.func_before, "func": r.func, "deep": [d.asDict() for d in r.deep or []]})) for r in rows if r._corrupt is None], \
        [r._corrupt for r in rows if r._corrupt is not None]


@pytest.mark.parametrize("indent", [None, 1, 0])
def test_array_in_narrow_ranges(spark, narrow, tmp_path, indent):
    expected = objects(random.Random(1), 60)
    text = json.dumps(expected, ensure_ascii=indent == 0, indent=indent)
    (tmp_path / "a.json").write_bytes(text.encode())
    good, bad = read_array(spark, tmp_path / "a.json")
    assert good == expected and bad == []
    assert nested.json_array(spark, str(tmp_path / "a.json"), ITEM).rdd.getNumPartitions() > 1


def test_ranges_are_read_by_several_tasks_and_texts_move_once(spark, narrow, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(objects(random.Random(2), 40)))
    lines = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
    assert lines.rdd.getNumPartitions() > 20


def test_arrays_of_all_forms(spark, narrow, tmp_path):
    forms = {
        "a_empty.json": b"[]", "b_blank.json": b" \n ", "c_one.json": b'{"id": 1, "func": "x"}', "d_lines.json": b'{"id": 2}\n{"id": 3, "deep": [{"x": "}"}]}\n',
        "e_bom.json": b'\xef\xbb\xbf[ {"id": 4} ,\n{"id": 5}]\n\n', "f_tail.json": b'[{"id": 6}]', "g_zero.json": b"",
    }
    for name, data in forms.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "h.json.gz").write_bytes(gzip.compress(json.dumps([{"id": i} for i in range(7, 30)]).encode()))
    good, bad = read_array(spark, tmp_path)
    assert [g["id"] for g in good] == list(range(1, 30)) and bad == []


def test_damaged_arrays_keep_what_comes_before(spark, narrow, tmp_path):
    whole = json.dumps([{"id": i, "func": "f" * 30} for i in range(10)])
    forms = {
        "a": whole[:-1], "b": whole[:-2], "c": whole[:-30], "d": whole[:-1] + ', {"id": "x', "e": "hello", "f": whole + " junk", "g": whole.replace('"id": 4', '"id": 4 4'), "h": whole[:-1] + ",",
    }
    for name, text in forms.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = nested.json_array(spark, str(tmp_path), ITEM, corrupt=True, position=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.path[-6], [0, 0])[r._corrupt is not None] += 1
    assert by == {"a": [10, 1], "b": [9, 1], "c": [9, 1], "d": [10, 1], "e": [0, 1], "f": [10, 1], "g": [9, 1], "h": [10, 1]}


def write_csv(rows, names=("code", "safety", "language"), end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(names)
    writer.writerows(rows)
    return out.getvalue().encode()


CSV_PARTS = ['"', '""', ",", "\n", "\r\n", "a", "é", " ", '",', ',"', '"\n', "x y", "日", "\n\n"]


def csv_rows(rng, n):
    word = lambda: "w" + "".join(rng.choice(CSV_PARTS) for _ in range(rng.randrange(14))) + "w"
    return [(word(), rng.choice(["safe", "vulnerable"]), word()) for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_narrow_ranges(spark, narrow, tmp_path, end):
    rows = csv_rows(random.Random(3), 120)
    (tmp_path / "a.csv").write_bytes(write_csv(rows, end=end))
    got = tables.quoted_csv(spark, str(tmp_path / "a.csv"), corrupt=True, position=True).orderBy("row_pos").collect()
    assert [(r.code, r.safety, r.language) for r in got] == rows and {r._corrupt for r in got} == {None}


def test_csv_columns_by_name_and_header_of_each_file(spark, narrow, tmp_path):
    rows = csv_rows(random.Random(4), 30)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(write_csv([(x, b, "extra", a) for a, b, x in rows[10 * k : 10 * k + 10]], ("language", "safety", "note", "Code")))
    got = tables.quoted_csv(spark, str(tmp_path), position=True).orderBy("row_pos").collect()
    assert [(r.code, r.safety, r.language) for r in got] == rows


def test_csv_stray_quotes_empty_fields_and_an_open_end(spark, tmp_path):
    text = 'code,safety,language\n5" disk,safe,"c"\n,"",\n\n"a""b",safe\nx,safe,c,more\n"open, never closed\nsafe,c\n'
    (tmp_path / "a.csv").write_text(text)
    rows = tables.quoted_csv(spark, str(tmp_path / "a.csv"), corrupt=True, position=True).orderBy("row_pos").collect()
    assert [(r.code, r.safety, r.language, r._corrupt) for r in rows] == [
        ('5" disk', "safe", "c", None), (None, None, None, None), ('a"b', "safe", None, None), ("x", "safe", "c", None), (None, None, None, '"open, never closed\nsafe,c')]


def test_one_file_as_large_as_a_table(spark, sf, tmp_path):
    """Both formats, one file each, against the table itself."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    (tmp_path / "a.json").write_text(json.dumps([{"func_before": d.text, "func": str(d.doc_id)} for d in docs]))
    (tmp_path / "a.csv").write_bytes(write_csv([(d.text, "safe", str(d.doc_id)) for d in docs]))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 * 1024))
        pairs = nested.json_array(spark, str(tmp_path / "a.json")).select(F.col("func").cast("long"), "func_before").collect()
        records = tables.quoted_csv(spark, str(tmp_path / "a.csv")).select(F.col("language").cast("long"), "code").collect()
    finally:
        spark.conf.set(key, old)
    expected = sorted((d.doc_id, d.text) for d in docs)
    assert sorted(map(tuple, pairs)) == expected
    assert sorted((i, t or "") for i, t in records) == expected


def test_no_window_looks_ahead_over_a_range(spark, tmp_path):
    """A frame from each row to the end of its partition is computed anew for each row, so a range of n pieces would take n * n / 2 steps."""
    (tmp_path / "a.csv").write_text("code,safety,language\n" + "".join(f'"x\ny{i}",safe,c\n' for i in range(50)))
    (tmp_path / "a.json").write_text(json.dumps(objects(random.Random(3), 20)))
    for df in (tables.quoted_csv(spark, str(tmp_path / "a.csv")), nested.json_array(spark, str(tmp_path / "a.json"), ITEM)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "specifiedwindowframe" in plan and "currentrow$(), unboundedfollowing$()" not in plan
