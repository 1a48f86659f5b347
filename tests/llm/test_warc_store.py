"""Content-addressed archive: contract rows by brute force, exact records back."""

import hashlib
from collections import defaultdict

import pytest

from ledgerflow.llm import warc_store as ws

BIG = "<p>" + "ü large page " * 120 + "</p>"
ROWS = [(1, "http://a/", BIG), (2, "http://b/x y\r\nz", BIG), (5, None, BIG), (5, "http://d/", BIG), (None, "http://e/", BIG),
        (3, "http://f/", "small"), (4, "http://g/", "small"), (6, "http://h/", None), (7, "http://i/", ""),
        (8, "http://j/", "x" * 1000), (9, "http://k/", "x" * 1000), (10, "http://l/", "y" * 999), (11, "http://m/", "y" * 999),
        (12, "http://n/", "\r\n\r\n" * 300), (None, None, None), (13, "é", " \x00\U0001f600" * 400)]


def brute_force(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for text, ids in groups.items():
        data = text.encode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha1(data).hexdigest()
        for k, i in enumerate(ids):
            revisit = len(data) >= 1000 and k < len(ids) - 1
            out.append((i, len(data), digest, "revisit" if revisit else "response", ids[-1] if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture
def archive(spark, frame):
    df = frame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, digest string, row int")
    return ws.archive_pages(df)


def test_listing_equals_brute_force(spark, archive):
    assert sorted(map(tuple, ws.listing(spark, archive).collect()), key=repr) == brute_force(ROWS)


def test_payloads_are_stored_once(spark, archive):
    stored = [bytes(r.payload) for r in spark.read.parquet(f"{archive}/payloads").collect()]
    assert sorted(stored) == sorted({(h or "").encode() for _, _, h in ROWS})


def test_records_are_proper_and_originals_come_back(spark, archive):
    got = [bytes(r.record) for r in ws.records(spark, archive).collect()]
    assert len(got) == len(ROWS) and len({r.split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for r in got}) == len(ROWS)
    for r in got:
        fields, block = r.split(b"\r\n\r\n", 1)
        named = dict(line.split(b": ", 1) for line in fields.split(b"\r\n")[1:])
        assert r.startswith(b"WARC/1.1\r\n") and len(block) == int(named[b"Content-Length"]) + 4 and block.endswith(b"\r\n\r\n")
        if named[b"WARC-Type"] == b"revisit":
            target = next(x for x in got if b"WARC-Record-ID: " + named[b"WARC-Refers-To"] in x)
            assert b"WARC-Type: response" in target and named[b"WARC-Payload-Digest"] in target
    want = sorted(((i, h or "") for i, _, h in ROWS), key=repr)
    back = ws.originals(spark, archive).collect()
    assert sorted(((r.id, bytes(r.payload).decode()) for r in back), key=repr) == want
    assert {r.url for r in back} == {u and u.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in ROWS}


def test_any_record_comes_back(spark, frame, archive):
    whole = [bytes(r.record) for r in ws.records(spark, archive).collect()]
    odd = whole + [b"", b"no end of fields", b"\r\n\r\n", b"WARC/1.0\r\nContent-Length: 99999\r\n\r\nshort", b"\xff\xfe\r\n\r\n\x00\r\n\r\n",
                   b"WARC/1.0\r\nContent-Type: application/http\r\nContent-Length: 3\r\n\r\nHTTP head without end", whole[0] * 2,
                   b"WARC/1.0\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", b"WARC/1.0\r\nContent-Length: 5\r\n\r\nhello"]
    path = ws.archive_records(frame([(k, bytearray(r)) for k, r in enumerate(odd)] + [(99, None)], "id long, record binary"))
    back = {r.id: bytes(r.record) for r in ws.records(spark, path).collect()}
    assert back == {**dict(enumerate(odd)), 99: b""}
    stored = [bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert stored.count(BIG.encode()) == 1 and stored.count(b"hello") == 1


def test_damage_is_seen(spark, frame):
    path = ws.archive_pages(frame([(1, "u", "text")], "page_id long, url string, html string"))
    bad = spark.createDataFrame([(hashlib.sha256(b"text").hexdigest(), bytearray(b"other"))], "digest string, payload binary")
    bad.write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload damaged"):
        ws.listing(spark, path).collect()


def test_one_payload_in_most_rows(spark):
    df = spark.range(0, 3000, numPartitions=6).selectExpr("id AS page_id", "'u' AS url", "if(id % 3 < 2, repeat('hot ', 300), repeat(id || ' ', 300)) AS html")
    got = ws.listing(spark, ws.archive_pages(df)).collect()
    last = max(r.page_id for r in got if r.page_id % 3 < 2)
    assert all((r.record_type, r.refers_to) == (("revisit", last) if r.page_id % 3 < 2 and r.page_id != last else ("response", None))
               for r in got) and len(got) == 3000


def test_empty_table(spark):
    path = ws.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert ws.listing(spark, path).collect() == ws.records(spark, path).collect() == []
