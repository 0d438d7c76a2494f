"""WARC archives of captured pages and a globally ordered index of their captures.

Records are built by column expressions and written by Spark's text sink, a file for each task: WARC/1.1, uncompressed, so that
(file, offset, length) of the index opens a record directly. The separator of records, ``WARC/1.1`` and a line break, never stands inside
a block: a payload that holds it is sent in chunks that end within it. So Spark reads archives in ranges of bytes, record by record.

The index is merged as external runs. Each task that reads archives emits its captures as locally sorted runs; runs are written, cut
into ranges of (URL key, timestamp, page, run, place), and each range merges its pieces of all runs with a loser tree. Ranges follow each
other, so the captures of a URL lie together in order of time, however many it has.

Defined results: a null payload is empty; payloads are equal when their SHA-256 is; of equal ones that of the smallest page id is the
response, together with further rows of that very id, and rows without an id revisit it; where no row of a group has an id, all are
responses. A null or blank URL is written as about:blank; white space in URLs is percent-encoded. A page id gives the time of capture,
in seconds from 2000 on. Records that do not parse or whose payload disagrees with its digest have ``intact`` false. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import shared_dir, staged

VERSION = "WARC/1.1"
START = VERSION + "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"
BROADCAST_ROWS = 100_000  # leaders of payloads that are sent to all tasks, 40 bytes each; more are joined by a shuffle
RUN_CAPTURES = 50_000
RANGE_CAPTURES = 200_000


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 in upper-case base32: ten hexadecimal digits are eight digits of base 32."""
    digest = F.sha1(payload)
    eights = [F.lpad(F.conv(F.substring(digest, 1 + at, 10), 16, 32), 8, "0") for at in range(0, 40, 10)]
    return F.translate(F.concat(*eights), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest and captured of each page."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    since = "TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(pmod(coalesce(page_id, 0), 1000000000) AS DECIMAL(18, 6)))"
    return page.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "captured": F.expr(f"date_format({since}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")")})


def leaders(rows: DataFrame, least_bytes: int) -> DataFrame:
    """For each payload that more than one page has: its hash and the smallest page id."""
    whole = rows.filter(F.col("payload_bytes") >= least_bytes).select("page_id", F.unhex(F.sha2("payload", 256)).alias("hash"))
    groups = whole.groupBy("hash").agg(F.min("page_id").alias("leader"), F.max("page_id").alias("last"), F.count("*").alias("n"), F.count("page_id").alias("with_id"))
    return staged(groups.filter((F.col("leader") < F.col("last")) | ((F.col("with_id") > 0) & (F.col("with_id") < F.col("n")))).select("hash", "leader"), "warc-leaders")


def _safe_url(url: Column) -> Column:
    for text, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20"), (VERSION, VERSION.replace("/", "%2F"))):
        url = F.replace(url, F.lit(text), F.lit(code))
    return F.when(F.trim(F.coalesce(url, F.lit(""))) == "", "about:blank").otherwise(url)


def records(rows: DataFrame) -> Column:
    """The text of each record; ``leader`` is the page id that a revisit refers to, null for responses."""
    payload, size = F.col("payload"), F.col("payload_bytes").cast("string")
    risky = F.contains(F.concat(payload, F.lit("\r\n")), F.lit(START))
    pieces = F.split(payload, f"(?<={VERSION[:4]})(?={VERSION[4:]})".replace(".", "\\."))
    chunk = lambda p: F.concat(F.lower(F.hex(F.octet_length(p).cast("long"))), F.lit("\r\n"), p, F.lit("\r\n"))
    chunked = F.concat(F.array_join(F.transform(pieces, chunk), ""), F.lit("0\r\n\r\n"))
    status = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n")
    revisit = F.col("leader").isNotNull()
    plain_head = F.concat(status, F.lit("Content-Length: "), size, F.lit(END))
    block = F.when(revisit, plain_head).when(risky, F.concat(status, F.lit("Transfer-Encoding: chunked" + END), chunked)).otherwise(F.concat(plain_head, payload))
    name = lambda page: F.concat(F.lit(f"<{PAGE}"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">\r\n"))
    kind = F.when(revisit, F.concat(F.lit(f"revisit\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("leader")))).otherwise("response\r\n")
    block_name = F.col("block")
    text = F.concat(
        F.lit(START + "WARC-Type: "), kind, F.lit("WARC-Record-ID: "), name(F.col("page_id")), F.lit("WARC-Target-URI: "), _safe_url(F.col("url")),
        F.lit("\r\nWARC-Date: "), F.col("captured"), F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(payload),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block_name).cast("string"), F.lit(END), block_name)
    return rows.withColumn("block", block).select(text.alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """A record for each page below ``folder``; equal payloads of at least ``least_bytes`` bytes are stored once."""
    rows = captures(pages)
    known = leaders(rows, least_bytes)
    if known.isEmpty():
        joined = rows.withColumn("leader", F.lit(None).cast("long"))
    else:
        found = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
        joined = rows.withColumn("hash", F.unhex(F.sha2("payload", 256))).join(found, "hash", "left")
    # The response does not refer to itself.
    joined = joined.withColumn("leader", F.when(F.col("leader").eqNullSafe(F.col("page_id")), None).otherwise(F.col("leader")))
    records(joined).write.option("lineSep", END).text(folder)


def url_key(url: str) -> str:
    """The host from its last part on, without www and standard ports, then path and sorted query: pages of a site lie together."""
    match = re.match(r"(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?", url, re.I)
    if not match:
        return url.partition("#")[0].lower()
    host = re.sub(r":(?:80|443)?$", "", match[1].rpartition("@")[2].lower())
    host, _, port = re.sub(r"^www\d*\.", "", host).partition(":") if host[:1] != "[" else (host, "", "")
    query = "?" + "&".join(sorted(match[3].split("&"))) if match[3] else ""
    return ",".join(reversed(host.rstrip(".").split("."))) + (":" + port if port else "") + ")" + (match[2] or "/") + query


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {name.lower(): value.strip() for name, found, value in (line.partition(":") for line in lines) if found}


def _page(name: str) -> int | None:
    found = re.fullmatch(rf"<{PAGE}(-?\d+)>", name)
    return int(found[1]) if found else None


def whole(body: bytes) -> bytes:
    """A body without its chunks' sizes."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line], 16)
        if not size:
            return b"".join(out)
        if len(body) < line + 4 + size:
            raise ValueError("a chunk is cut short")
        out.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a record (without its first line), those of its HTTP head, and the payload. Raises ValueError where it is damaged."""
    head, found, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = int(fields.get("content-length", "-1"))
    if not found or size < 0 or rest[size:] != END.encode():
        raise ValueError("the record's length is wrong")
    http, _, body = rest[:size].partition(b"\r\n\r\n")
    about = _fields(http)
    return fields, about, whole(body) if about.get("transfer-encoding") == "chunked" else body


CAPTURE = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean, "
           "file string, split long, local long, length long")
CAPTURE_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[k]) for n, k in (f.split() for f in CAPTURE.split(", "))])


def _capture(record: bytes) -> tuple:
    try:
        fields, about, payload = parse(record)
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        kind = fields["warc-type"]
        if kind == "response":
            size, intact = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
        else:
            size, intact = int(about["content-length"]), True
        return (url_key(fields["warc-target-uri"]), fields["warc-date"], _page(fields["warc-record-id"]), size, digest, kind, _page(fields.get("warc-refers-to", "")), intact)
    except (ValueError, KeyError):
        return ("", "", None, None, None, None, None, False)


def _order(row: Sequence) -> tuple:
    return (row[0], row[1], row[2] is None, row[2] or 0)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives as written runs: each sorted by URL key, time and page, with its number and places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        rows: list[tuple] = []
        at, where = 0, None

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows.sort(key=_order)
            for a in range(0, len(rows), 8192):
                some = rows[a : a + 8192]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*some), CAPTURE_SCHEMA)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([number] * len(some)), pa.array(range(a, a + len(some)), pa.int64())], [*CAPTURE_SCHEMA.names, "run", "place"])
            number += 1
            rows.clear()

        for batch in batches:
            for record, file, start in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (file, start) != where:
                    at, where = 0, (file, start)
                record = record.as_py()
                length = len(START) + len(record)
                rows.append((*_capture(record), file, start, at, length))
                at += length
                if len(rows) >= RUN_CAPTURES:
                    yield from emit()
        yield from emit()

    lines = spark.read.schema("value string").option("lineSep", START).text(folder)
    meta = F.col("_metadata")
    pieces = lines.select(F.col("value").cast("binary").alias("value"), meta["file_path"].alias("file"), meta["file_block_start"].alias("split")).filter(F.octet_length("value") > 0)
    return staged(pieces.mapInArrow(run, CAPTURE + ", run long, place long"), "warc-runs")


class LoserTree:
    """Merges sorted lists: each step costs one comparison for each level, against the losers on the winner's way up."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers: list[int] = [-1] * max(len(runs), 1)
        for run in range(len(runs)):
            self._play(run)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come waits for its opponent
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def _before(self, a: int, b: int) -> bool:
        if self.at[a] == len(self.runs[a]):
            return False
        return self.at[b] == len(self.runs[b]) or self.runs[a][self.at[a]] < self.runs[b][self.at[b]]

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in the run) of all items in order."""
        while self.runs:
            run = self.losers[0]
            place = self.at[run]
            if place == len(self.runs[run]):
                return
            yield run, place
            self.at[run] += 1
            self._play(run)


def merge_runs(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """All captures in global order of URL key and time: ``shard`` numbers the ranges in order, ``place`` the captures of a range."""
    spark = runs.sparkSession
    # Where a split's first record begins: after all records that begin in the file's earlier splits.
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = runs.groupBy("file", "split").agg(F.sum("length").alias("bytes")).select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = runs.join(splits, ["file", "split"]).withColumn("offset", F.col("base") + F.col("local")).drop("base", "local", "split")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_captures))
    names = placed.columns

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        lists: dict[int, list] = {}
        first: dict[int, int] = {}
        columns = [table.column(c).to_pylist() for c in ("url_key", "captured", "page_id", "run", "place")]
        for at, (key, captured, page, run, place) in enumerate(zip(*columns)):
            first.setdefault(run, at)
            lists.setdefault(run, []).append((*_order((key, captured, page)), run, place))
        starts = list(first.values())
        order = [starts[run] + place for run, place in LoserTree(list(lists.values()))]
        merged = table.take(pa.array(order, pa.int64())).drop_columns(["run", "place"])
        shard = TaskContext.get().partitionId()
        merged = merged.append_column("shard", pa.array([shard] * len(order), pa.int32())).append_column("place", pa.array(range(len(order)), pa.int64()))
        yield from merged.to_batches(8192)

    kinds = [f"{n} {k}" for n, k in placed.dtypes if n not in ("run", "place")]
    by = ["url_key", "captured", F.col("page_id").isNull(), "page_id", "run", "place"]
    return placed.select(*names).repartitionByRange(ranges, *by).sortWithinPartitions("run", "place").mapInArrow(merge, ", ".join(kinds) + ", shard int, place long")


def index_lines(merged: DataFrame) -> DataFrame:
    """A line of text for each capture: URL key, time as fourteen digits, and a JSON object. Written as text, files follow in order."""
    about = F.to_json(F.struct("page_id", F.col("payload_digest").alias("digest"), "record_type", "refers_to", "offset", "length", "file"))
    return merged.select(F.concat_ws(" ", "url_key", F.regexp_replace("captured", "[^0-9]", ""), about).alias("value"))


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write the pages' archives to a fresh shared folder, read them back and return the merged index."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    write_archives(pages, folder, least_bytes)
    return merge_runs(read_runs(spark, folder))
