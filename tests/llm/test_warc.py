"""WARC archives: round trip, magic inside payloads, splits, damaged ends."""

import hashlib

import pytest

from stratum.llm import warc as W
from stratum.llm.common import new_path

LONG = "x" * 120


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, type string, digest string")


NESTED = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
          "tail WARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 999999\r\n\r\n")
ROWS = [
    (5, "http://a/ b\r\nX: y", LONG, "clash", "clash"), (3, None, LONG, None, None), (9, "http://c", LONG, None, None),
    (1, "http://d", None, None, None), (2, "http://e", "", None, None), (4, "http://f", "short", None, None),
    (6, "http://g", "short", None, None), (7, "http://h", NESTED, None, None), (8, "http://i", NESTED * 3, None, None),
    (10, "http://j", "WARC/1.1\r\n" * 40, None, None), (11, "http://k", "é\n\r\n\r\nü" * 30, None, None),
    (12, "http://l", "WARC/1.1\r\n", None, None), (13, "u", "y" * 5000, None, None), (13, "u", "y" * 5000, None, None),
    (14, "u", "y" * 5000, None, None), (None, "u", "y" * 5000, None, None),
]


def _expected(rows):
    first = {}
    for p, _, h, *_ in rows:
        if p is not None:
            first[h] = min(first.get(h, p), p)
    out = []
    for p, _, h, *_ in rows:
        h = h or ""
        b = h.encode()
        revisit = len(b) >= 100 and h in first and p != first[h]
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=repr)


def _read(spark, path, payloads=False):
    number = "cast(nullif(regexp_extract(%s, 'urn:page:([0-9]+)', 1), '') AS bigint) AS %s"
    return W.read_warc(spark, path, payloads).selectExpr(number % ("id", "page_id"), "payload_bytes", "payload_digest", "type",
                                                         number % ("refers", "refers_to"), *(["payload"] if payloads else []))


@pytest.mark.parametrize("compression, split", [("gzip", None), (None, "700b")])
def test_round_trip(spark, compression, split):
    path = new_path(spark, "warc-test")
    W.write_warc(_pages(spark, ROWS).coalesce(2), path, compression=compression)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = sorted((tuple(r) for r in _read(spark, path).collect()), key=repr)
        assert got == _expected(ROWS)
        payloads = {r.page_id: bytes(r.payload) for r in _read(spark, path, True).where("type = 'response'").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert payloads[7] == NESTED.encode() and payloads[8] == (NESTED * 3).encode() and payloads[10] == b"WARC/1.1\r\n" * 40
    assert payloads[11] == ROWS[10][2].encode() and payloads[1] == b""


@pytest.mark.parametrize("payloads", [False, True])
def test_scans_that_deal_files_differently(spark, monkeypatch, payloads):
    """As when executors come or go between two scans."""
    path = new_path(spark, "warc-test")
    W.write_warc(_pages(spark, ROWS).repartition(4, "page_id"), path)
    pieces, scans = W._pieces, []

    def dealt(*args):
        scans.append(1)
        spark.conf.set("spark.sql.files.minPartitionNum", "1" if len(scans) == 1 else "8")
        return pieces(*args)

    monkeypatch.setattr(W, "_pieces", dealt)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = sorted((tuple(r) for r in _read(spark, path, payloads).drop("payload").collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == _expected(ROWS)


def test_empty_table(spark):
    path = new_path(spark, "warc-test")
    W.write_warc(_pages(spark, []), path)
    assert W.read_warc(spark, path).count() == 0


def test_damaged_end_keeps_the_records_before(spark):
    path = new_path(spark, "warc-test")
    text = "".join(f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {n}\r\n\r\n{'a' * 5}\r\n\r\n"
                   for i, n in ((1, 5), (2, 5), (3, 50)))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert sorted(r.id for r in W.read_warc(spark, path).collect()) == ["<urn:page:1>", "<urn:page:2>"]
