import hashlib
import random

import pytest

from maskloom.llm.warc import archive_round_trip

FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:maskloom:page:999>\r\nContent-Length: 5\r\n\r\n"
        "hello\r\n\r\n")


def pages():
    random.seed(1)
    kinds = [None, "", "short", "é" * 80, "x" * 150, "a" + FAKE * 2 + "b" * 90, "WARC/1.0\r\n" * 3]
    rows = [(i, f"http://x/{i}\r\n", kinds[i % 7] if i % 11 else FAKE) for i in range(40)]
    return rows + [(None, None, "é" * 80), (500, None, "q" * 120), (400, "u", "q" * 120), (5, "again", rows[5][2])]


def brute(rows):
    first = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page is not None:
            first[payload] = min(page, first.get(payload, page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        again = len(payload) >= 100 and payload in first and first[payload] != page
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                    first[payload] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "2000"])
def test_round_trip_with_magic_inside_payloads(spark, split):
    rows = pages()
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, digest bigint")
        got = archive_round_trip(df.repartition(2), records=15)
        assert got.where("NOT digest_ok").count() == 0
        got = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_no_pages(spark):
    assert archive_round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
