"""WARC round trips: embedded version lines and whole records, nulls, copies, splits."""

import base64
import hashlib

import pytest

from obsflow.llm.warc import END, MAGIC, plan_records, read_archives, write_archives
from obsflow.session import work_dir


def record(page, body):
    return (f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\n"
            f"Content-Length: {len(body.encode())}{END}{body}{END}")


def expected(rows, min_bytes=0):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        top = max(same, default=None)
        again = len(body) >= min_bytes and top is not None and page != top
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


def round_trip(spark, rows, **kw):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = work_dir(spark, "warc-test")
    write_archives(plan_records(pages, **kw).repartition(2, "page_id"), path)
    got = read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in got.collect()), key=repr)


ROWS = [
    (1, "http://a/", "<p>plain</p>"), (2, None, None), (3, "http://b/\r\nX: y", ""), (4, "u", "<p>plain</p>"),
    (5, "u", "before " + record(99, "inner body") + " after"),
    (6, "u", record(98, "x")), (7, "u", record(97, "x" * 50)[:-4]), (8, "u", MAGIC * 5), (9, "u", "ends with " + MAGIC),
    (10, "u", "é\r\n\r\n" + record(96, record(95, "deep"))), (11, "u", "z" * 200_000), (None, "u", "<p>plain</p>"),
    (12, "u", f"{MAGIC}WARC-Type: response\r\nContent-Length: 999999{END}lie"), (13, "u", record(1, "a") + record(2, "b")),
    (None, "u", "no id"),
]


@pytest.mark.parametrize("split", ["134217728", "300"])
def test_round_trip_with_embedded_records(spark, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert round_trip(spark, ROWS) == expected(ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_small_payloads_stay_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef"), (4, "u", "abcdef")]
    assert round_trip(spark, rows, min_bytes=3) == expected(rows, 3)


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_pieces_are_found_whatever_the_split_of_the_second_scan(spark, monkeypatch):
    """Executors lost or gained between the scans change the split; here the second scan is cut differently."""
    from obsflow.llm import warc
    scans, plain = [], warc._pieces

    def scan(spark, path):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728" if not scans else "97")
        scans.append(path)
        return plain(spark, path)

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(warc, "_pieces", scan)
    try:
        assert round_trip(spark, ROWS) == expected(ROWS) and len(scans) == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_clashing_extra_columns(spark):
    rows = [(1, "u", "<p>a</p>", "k", 7, "w"), (2, "u", "<p>a</p>", None, None, None), (3, None, None, "k", 1, "w")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string, n int, payload string")
    got = sorted(tuple(r) for r in plan_records(pages).select("page_id", "payload", "record_type", "refers_to").collect())
    assert got == [(1, "<p>a</p>", "revisit", 2), (2, "<p>a</p>", "response", None), (3, "", "response", None)]
