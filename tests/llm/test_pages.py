"""WARC archives."""

import hashlib
import random
import tracemalloc
import zlib

from tallyframe.llm import queries, warc


def test_query_like_sql(spark, folder, duck):
    rows = queries.op9_warc(spark, folder).collect()
    cursor = duck.execute(queries.ORACLES["op9_warc"])
    names = [d[0] for d in cursor.description]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[n] for n in names) for r in rows), key=key) == sorted(cursor.fetchall(), key=key)


PAGES = [
    (1, "http://a b/\r\nX: y", "x" * 1500), (2, None, "x" * 1500), (None, "u", "x" * 1500), (3, "u", None), (4, "u", "é" * 700), (5, "u", "é" * 700),
    (6, "u", "short"), (7, "u", "short"), (2, "v", "x" * 1500), (8, "u", ""), (9, "u", "z" * 300_000), (None, "u", "n" * 1200), (None, "v", "n" * 1200),
]


def plain(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        keys = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        revisit = len(data) >= 1000 and keys and key != max(keys)
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(keys) if revisit else None, None))
    return sorted(out, key=str)


def test_round_trip_of_tricky_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "'a' AS key", "'b' AS payload", "'c' AS digest", "'d' AS first").repartition(3)
    assert sorted((tuple(r) for r in warc.roundtrip(pages).collect()), key=str) == plain(PAGES)
    assert warc.roundtrip(pages.limit(0)).collect() == []
    names = pages.select(pages.page_id.cast("string").alias("page_id"), "url", "html")
    assert {type(r.page_id) for r in warc.roundtrip(names).collect()} == {str, type(None)}


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    archives = warc.write(warc.typed(pages), f"file://{tmp_path}/a", archive_bytes=300)
    assert archives.count() > 3
    rows = warc.read_archives(archives, keep=True).collect()
    kept = sorted((r.payload.decode() for r in rows if r.record_type == "response"))
    expected = [(k, h) for (k, _, h), p in zip(PAGES, [None] * len(PAGES)) if True]
    responses = sorted(h or "" for k, h in expected if ("response" in [x[3] for x in plain(PAGES) if x[0] == k and x[1] == len((h or "").encode())]))
    assert kept == responses and not any(r.error for r in rows)
    assert {r.target_uri for r in rows if r.record_id == "<urn:page:1>"} == {"http://a%20b/%0D%0AX:%20y"}


def sliced(data, n):
    return [data[i : i + n] for i in range(0, len(data), n)]


def test_reader_in_pieces_of_any_size():
    data = warc.record("response", "a/b", "u", b"payload\r\n\r\nmore") + warc.record("revisit", "c", "u", b"12345", "a/b") + warc.record("response", None, None, b"")
    for n in (1, 2, 7, 100, 10_000):
        rows = list(warc.read(sliced(data, n), keep=True))
        assert [(r[0], warc.page_key(r[1]), warc.page_key(r[2]), r[4], r[6], r[7]) for r in rows] == [
            ("response", "a/b", None, 15, b"payload\r\n\r\nmore", None), ("revisit", "c", "a/b", 5, None, None), ("response", None, None, 0, b"", None),
        ]


def test_reader_reports_damage():
    good, payload = warc.record("response", "1", None, b"p" * 50), b"p" * 50
    assert [r[7] for r in warc.read([good, good[:-12]])] == [None, "truncated"]
    plain_text = zlib.decompress(good, 31)
    squeeze = lambda data: (lambda c: c.compress(data) + c.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    assert [r[7] for r in warc.read([squeeze(plain_text.replace(payload, b"q" * 50))])] == ["digest"]
    assert [r[7] for r in warc.read([squeeze(plain_text[:-2])])] == ["framing"]
    assert [r[7] for r in warc.read([squeeze(plain_text[:-20])])] == ["truncated"]
    assert list(warc.read([b"no archive"]))[0][7] and list(warc.read([squeeze(b"no record\r\n\r\n")]))[0][7]
    assert list(warc.read([])) == []


def test_reading_goes_on_behind_damage():
    rng = random.Random(1)
    bodies = [rng.randbytes(3000) for _ in range(4)]
    first, second, third, fourth = (warc.record("response", str(i), None, b) for i, b in enumerate(bodies))
    broken = second[:1500] + bytes(40) + second[1540:]
    alien = zlib.compressobj(6, zlib.DEFLATED, 31)
    alien = alien.compress(b"no record\r\n\r\n" + rng.randbytes(500)) + alien.flush()
    for data in (first + broken + third + b"junk" * 99 + fourth, first + second[:700] + third + alien + fourth):
        for n in (1, 100, 2999, 1 << 20):
            rows = list(warc.read(sliced(data, n), keep=True))
            good = [(warc.page_key(r[1]), r[6]) for r in rows if not r[7]]
            assert good == [("0", bodies[0]), ("2", bodies[2]), ("3", bodies[3])]
            assert 1 <= sum(bool(r[7]) for r in rows) <= 3


def test_members_that_swell_are_read_in_little_room():
    data = warc.record("response", "1", None, bytes(100 << 20))
    headers = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % (50 << 20)
    headers = headers.compress(text + b"x" * (50 << 20)) + headers.flush()
    assert len(data) < 200_000 and len(headers) < 200_000
    tracemalloc.start()
    try:
        assert [(r[4], r[7]) for r in warc.read([data])] == [(100 << 20, None)]
        assert [r[7] for r in warc.read([headers, warc.record("response", "2", None, b"")])] == ["an HTTP header does not end", None]
        assert tracemalloc.get_traced_memory()[1] < 30 << 20
    finally:
        tracemalloc.stop()
