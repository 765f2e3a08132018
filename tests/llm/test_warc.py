import hashlib
import struct

import pytest
import zstandard
from llm_docs import SF_SMALL

from tallyhouse.llm import warc as W
from tallyhouse.llm.common import read_table

LONG = "<p>long enough to be revisited</p>" * 5


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = i is not None and html in first and i > first[html]
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    first[html] if again else None))
    return out


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows],
                                 "page_id bigint, url string, html string, payload string, n bigint, record_type string") \
        .repartition(3)


ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://b", None), (5, "http://b", ""),
        (6, "http://c", "short"), (7, "http://c", "short"), (8, "http://d\r\nX: y", "é😀\r\n\r\n" * 40), (None, "http://e", LONG),
        (9, "u", "z" * 3_000_000), (1, "http://a/1", LONG), (10, "u", "WARC/1.1\r\n\r\n" * 20), (11, "u", "z" * 99), (12, "u", "z" * 99),
        (13, "u", "y" * 100), (14, "u", "y" * 100)]


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


def test_round_trip(spark, scratch):
    df = pages(spark, ROWS)
    got = W.archive(df, f"file://{scratch}/one")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(ROWS), key=key)
    full = W.read_warc(spark, f"file://{scratch}/one").collect()
    html = {r[0]: r[2] or "" for r in ROWS}
    for r in full:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == html[r.page_id]
    assert {r.url for r in full} >= {"http://a/1", "http://d X: y", ""}


def test_table(spark):
    df = read_table(spark, SF_SMALL, "pages")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, W.archive(df).collect()), key=key) == sorted(brute(rows), key=key)
    assert W.archive(df.limit(0)).collect() == []


def test_archives_are_split_and_complete(spark, scratch):
    rows = [(k, f"http://x/{k}", f"<html>{'word ' * (k % 50)}{k}</html>") for k in range(500)]
    files = W.write_warc(pages(spark, rows), f"file://{scratch}/many", archive_bytes=20_000).collect()
    assert len(files) > 3 and sum(f.records for f in files) == 500
    assert sorted(r.page_id for r in W.read_warc(spark, f"file://{scratch}/many").collect()) == list(range(500))


def test_layout_of_an_archive():
    records = [W.record_bytes(k, "http://x", f"payload {k}".encode() * 9,
                              hashlib.sha256(f"payload {k}".encode() * 9).hexdigest(), "response", None) for k in range(200)]
    data = W.archive_bytes_of(records)
    magic, size = struct.unpack_from("<II", data)
    assert 0x184D2A50 <= magic <= 0x184D2A5F
    frames = data[8 + size:]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj()
    assert reader.decompress(frames) == records[0]            # one frame, one record
    assert list(W.read_archive(data)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(frames) < plain                                # the dictionary helps
    with pytest.raises(ValueError):
        list(W.read_archive(data[:-3]))
    with pytest.raises(ValueError):
        W.parse_record(records[0].replace(b"payload 0payload", b"payload 1payload"))
