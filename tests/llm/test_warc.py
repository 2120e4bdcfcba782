from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from lithic.llm import warc
from lithic.sources.shared import scratch_path


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def rows():
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    return [
        (1, "http://a/1", "same"), (2, None, "same"), (9, "http://a/9?x\r\nWARC-Type: evil", "same"), (3, "http://a/3", ""),
        (4, "http://a/4", None), (5, "http://ä/5", tricky), (6, "u", "é" * 70000), (7, "u", tricky), (None, "u", "same"),
        (8, "u", "x"), (10, "u", "x"),
    ]


@pytest.mark.parametrize("least", (0, 2))
def test_round_trip(spark, least):
    table = [(i, u, p, "r") for i, u, p in rows()]
    records = spark.createDataFrame(table, "id long, uri string, payload string, record_type string")
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.deduplicate(records, min_bytes=least), path)
    out = warc.read_archives(spark, path)
    assert all(r.intact for r in out.collect())
    got = {r.record_id: r for r in warc.resolve(out).collect()}
    last = {}
    for i, _, payload in rows():
        data = (payload or "").encode()
        if i is not None and len(data) >= least:
            last[data] = max(i, last.get(data, i))
    for i, _, payload in rows():
        data, row = (payload or "").encode(), got[f"<urn:record:{'' if i is None else i}>"]
        assert row.payload_bytes == len(data) and row.payload_digest == digest(data)
        original = last.get(data, i) if i is not None else None
        if original == i:
            assert row.record_type == "response" and row.refers_to is None and bytes(row.payload) == data
        else:
            assert row.record_type == "revisit" and row.refers_to == f"<urn:record:{original}>" and row.payload is None
    assert got["<urn:record:9>"].target_uri == "http://a/9?x%0D%0AWARC-Type: evil"


def test_repeated_rows_and_empty_tables(spark):
    records = spark.createDataFrame([(1, "u", "p"), (2, "u", "p"), (2, "u", "p"), (1, "u", "p")], "id long, uri string, payload string")
    kinds = sorted((r.id, r.record_type) for r in warc.deduplicate(records).collect())
    assert kinds == [(1, "revisit"), (1, "revisit"), (2, "response"), (2, "response")]
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.deduplicate(records.limit(0)), path)
    assert warc.resolve(warc.read_archives(spark, path)).count() == 0


def test_records_without_ids_fill_as_many_archives_as_others(spark):
    ids = spark.range(0, 400, 1, 8).selectExpr(
        "if(id < 200, id, null) as id", "cast(id as string) as uri", "repeat('same', 250) as payload", "1 as more"
    )
    dealt = warc.deduplicate(ids, min_bytes=10**6, archive_bytes=20_000)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("payload#") and sum("Exchange hashpartitioning(deal" in x for x in plan.split("\n")) <= 2, plan
    path = scratch_path(spark, "warc")
    warc.write_archives(dealt, path)
    sizes = [r["n"] for r in spark.read.text(path, lineSep="WARC/1.1").selectExpr("_metadata.file_name as f").groupBy("f")
             .agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 15 and max(sizes) <= 60
    out = warc.read_archives(spark, path)
    assert out.count() == 400 and out.where("record_type = 'response' and intact and payload_bytes = 1000").count() == 400


def test_reads_archives_of_others(spark, tmp_path):
    def record(kind, extra, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode()
        return head + block + b"\r\n\r\n"

    full = record("response", "WARC-Record-ID: <a>\r\ncontent-type: application/http\r\n", b"HTTP/1.1 200\r\n\r\nhello")
    again = record("revisit", f"WARC-Record-ID: <b>\r\nWARC-Payload-Digest: sha1:{digest(b'hello')}\r\n", b"")
    lost = record("revisit", "WARC-Record-ID: <c>\r\nWARC-Payload-Digest: sha1:X\r\nWARC-Refers-To: <z>\r\n", b"")
    plain = record("resource", "WARC-Record-ID: <d>\r\nX-Long: a\r\n b\r\n", b"\xff\x00")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record("warcinfo", "", b"x")) + gzip.compress(full))
    (tmp_path / "b.warc").write_bytes(again + lost + plain)
    got = {r.record_id: r for r in warc.resolve(warc.read_archives(spark, str(tmp_path))).collect()}
    assert got["<a>"].payload == b"hello" and got["<d>"].payload == b"\xff\x00"
    assert (got["<b>"].refers_to, got["<b>"].payload_bytes) == ("<a>", 5)
    assert (got["<c>"].refers_to, got["<c>"].payload_bytes) == ("<z>", None)


@pytest.mark.parametrize("data", (b"HELLO\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
def test_what_is_no_archive(data):
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(data)))
