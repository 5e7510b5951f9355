import base64
import gzip
import hashlib
import random

import pytest

from strandline.llm import warc


def _pages(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{i}.example/ä?{i}%\n", "<p>" + "é" * rng.randrange(300) + str(i) + "\r\n\r\nWARC/1.1") for i in range(60)]
    rows += [(100 + i, "http://copy.example", "same") for i in range(5)] + [(104, "http://copy.example", "same")]
    rows += [(200, None, None), (201, "u", ""), (None, "http://x", "same"), (None, "http://y", "no id")]
    rows += [(300, "http://long.example", "long " * 200_000)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def _expected(rows, min_bytes=0):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, u, h in rows:
        p = (h or "").encode()
        to = last.get(h or "") if len(p) >= min_bytes else None
        to = None if to == i else to
        out.append((i, u, "response" if to is None else "revisit", to, base64.b32encode(hashlib.sha1(p).digest()).decode(), len(p), p if to is None else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    rows, df = _pages(spark)
    index = warc.write_archives(df, min_bytes=min_bytes, file_bytes=2000)
    got = [(r.page_id, r.url, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in warc.read_records(index).collect()]
    assert sorted(got, key=str) == _expected(rows, min_bytes)


def test_selected_records_and_files(spark):
    rows, df = _pages(spark)
    index = warc.write_archives(df)
    assert {r.page_id for r in warc.read_records(index.where("page_id % 7 = 0")).collect()} == {i for i, _, _ in rows if i is not None and i % 7 == 0}
    for r in index.select("file").distinct().collect():
        with gzip.open(r.file.removeprefix("file://")) as f:
            assert f.read(8) == b"WARC/1.1"


def test_coalesced_reads():
    assert list(warc.coalesced([(0, 10), (10, 5), (40, 5), (500, 1), (501, 100)], gap=30, most=60)) == [(0, 45, [0, 1, 2]), (500, 501, [3]), (501, 601, [4])]


def test_empty_table(spark):
    _, df = _pages(spark)
    index = warc.write_archives(df.limit(0))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_damaged_payload_is_refused():
    d = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    with pytest.raises(ValueError, match="digest"):
        warc.decode_record(warc.encode_record(1, "u", b"abd", d, None))


def test_urls_stand_as_they_are():
    for url, line in (("http://a/b%20c?x=100%", "http://a/b%20c?x=100%"), ("http://a/\tb%", "http://a/%09b%"), ("http://ä/\r\nX: y", "http://ä/%0D%0AX: y")):
        raw = warc.encode_record(1, url, b"p", base64.b32encode(hashlib.sha1(b"p").digest()).decode(), None)
        assert f"\r\nWARC-Target-URI: {line}\r\n".encode() in raw
        assert warc.decode_record(raw)[1] == url
