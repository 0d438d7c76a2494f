"""Archives and their index against plain computations, byte by byte."""

import base64
import hashlib
import os
import random
from urllib.parse import urlparse

import pytest

from riskloom.llm import warc

CLASHING = "page_id long, url string, html string, hash string, leader long, captured string, payload string, run long, place long, shard int, file string, block string"
HOSTILE = [
    "", "\r\n\r\n", "WARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\n", "WARC/1.1", "x\r\n\r\nWARC/1.1", "aWARC/1.1\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc",
    "WARC/1.1\r", "WWARC/1.1\r\n", "WARC/1.WARC/1.1\r\nWARC/", "é" * 999 + "WARC/1.1\r\n日本語\u0000﻿", "\r\n" * 40, "0\r\n\r\n", "5\r\nWARC/1.1\r\n0\r\n\r\n", "﻿<html>",
]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 1, "c", "p", 2, 3, 4, "f", "b") for i, u, h in rows], CLASHING).repartition(4)


def plain(rows, least=0):
    smallest = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if i is not None and len(data) >= least:
            smallest[data] = min(i, smallest.get(data, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        leader = smallest.get(data)
        original = leader is None or leader == i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if original else "revisit", None if original else leader))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r.intact for r in rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def url(i):
    return [f"https://www.Host{i % 3}.example.org:443/a/{i % 7}?b=2&a={i % 2}#x", f"http://u@host1.example.org/{i}", "", None, "not a url", "http://x/ WARC/1.1\r\ny"][i % 6]


@pytest.fixture(scope="module")
def hostile_rows():
    rng = random.Random(1)
    rows = [(i, url(i), h) for i, h in enumerate(HOSTILE * 3)]
    rows += [(1000 + i, url(i), "".join(rng.choice(["WARC", "/1.1", "\r\n", "W", "\r", "é", "0", "\n"]) for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(5000 - i, url(i), "same text") for i in range(300)] + [(None, url(1), "same text"), (None, None, None), (None, "http://a/b", "alone"), (None, "http://a/b", "alone")]
    rows += [(4701, url(2), "same text"), (-5, url(3), None), (7, url(1), "x" * 700_000 + "WARC/1.1\r\n" + "y" * 100_000)]
    return rows


def test_round_trip_of_hostile_payloads(spark, hostile_rows):
    table = pages(spark, hostile_rows)
    assert found(warc.round_trip(table)) == plain(hostile_rows)
    assert found(warc.round_trip(table, least_bytes=5)) == plain(hostile_rows, 5)


def test_many_splits_and_a_shuffled_join_give_the_same(spark, hostile_rows, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "RUN_CAPTURES", 7)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
        result = warc.round_trip(pages(spark, hostile_rows))
        assert found(result) == plain(hostile_rows)
        check_offsets(result)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def check_offsets(result):
    for r in result.collect():
        with open(urlparse(r.file).path, "rb") as file:
            file.seek(r.offset)
            record = file.read(r.length)
        assert record.startswith(warc.START.encode())
        fields, about, payload = warc.parse(record[len(warc.START) :])
        assert fields["warc-payload-digest"] == "sha1:" + r.payload_digest and fields["warc-type"] == r.record_type
        if r.record_type == "response":
            assert base64.b32encode(hashlib.sha1(payload).digest()).decode() == r.payload_digest
        else:
            assert payload == b"" and fields["warc-refers-to"] == f"<urn:page:{r.refers_to}>" and int(about["content-length"]) == r.payload_bytes


def test_index_is_in_global_order_and_opens_records(spark, hostile_rows, tmp_path):
    merged = warc.round_trip(pages(spark, hostile_rows))
    check_offsets(merged)
    rows = sorted(merged.collect(), key=lambda r: (r.shard, r.place))
    keys = [(r.url_key.encode(), r.captured, r.page_id is None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    assert len({r.shard for r in rows}) > 1
    warc.index_lines(merged).write.text(str(tmp_path / "index"))
    lines = []
    for name in sorted(n for n in os.listdir(tmp_path / "index") if n.startswith("part-")):
        lines += (tmp_path / "index" / name).read_text().splitlines()
    assert len(lines) == len(hostile_rows) and [line.split(' {"')[0].rsplit(" ", 1)[0] for line in lines] == [r.url_key for r in rows]


def test_empty_table_and_one_page(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
    assert found(warc.round_trip(pages(spark, [(3, None, None)]))) == plain([(3, None, None)])


def test_damaged_records_are_told(spark, tmp_path):
    warc.write_archives(pages(spark, [(i, url(i), f"text {i}") for i in range(40)]).coalesce(1), str(tmp_path / "a"))
    name = next(n for n in os.listdir(tmp_path / "a") if n.startswith("part-"))
    data = (tmp_path / "a" / name).read_bytes()
    os.makedirs(tmp_path / "b")
    (tmp_path / "b" / "x.warc").write_bytes(data.replace(b"text 17", b"text 71").replace(b"text 5\r", b"text\r")[:-30])
    rows = warc.merge_runs(warc.read_runs(spark, str(tmp_path / "b"))).collect()
    assert len(rows) == 40 and sum(not r.intact for r in rows) == 3


def test_loser_tree_merges():
    rng = random.Random(2)
    for count in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(count)]
        runs = [[(v, r, i) for i, v in enumerate(run)] for r, run in enumerate(runs)]
        merged = [runs[r][i] for r, i in warc.LoserTree(runs)]
        assert merged == sorted(x for run in runs for x in run)


@pytest.mark.parametrize(("address", "key"), [
    ("https://www.A.example.org:443/b?y=2&x=1#f", "org,example,a)/b?x=1&y=2"), ("http://u:p@a.example.org", "org,example,a)/"),
    ("//a.org:8080/X", "org,a:8080)/X"), ("Urn:Page:3#x", "urn:page:3"), ("http://[::1", "[::1)/"),
])
def test_url_key(address, key):
    assert warc.url_key(address) == key
