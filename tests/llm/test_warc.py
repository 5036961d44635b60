import base64
import hashlib
import io
import zlib

import pytest

from tapelake.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


ROWS = [
    (1, "http://Www.Example.com/a?b#c", "same"),
    (5, "http://example.com/x y", "same"),
    (3, "http://example.com/\r\nWARC-Type: revisit", "same"),
    (2, None, None),
    (8, "no scheme", ""),
    (8, "http://tie.org/", ""),
    (None, "http://null.id/", "same"),
    (None, "http://null.id/", "only without id"),
    (None, "http://null.id/2", "only without id"),
    (7, "http://h:8080/ü", "é" * 70000 + "\r\n\r\nWARC/1.1\r\n"),
    (11, "http://one.net/", "a\x00b"),
    (11, "http://one.net/", "a\x00b"),
]


def want(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        own = groups[html or ""]
        known = [p for p in own if p is not None]
        top = max(known) if known else None
        first = page == top
        out.append((page, len((html or "").encode()), digest(html or ""), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


@pytest.mark.parametrize(("limit", "lines"), [(64 << 20, 1000), (300, 2)])
def test_round_trip(spark, folder, limit, lines):
    more = [(100 + k, f"http://h{k % 7}.example.org/{k}", f"page {k % 20}") for k in range(120)]
    pages = spark.createDataFrame([(*r, "x") for r in ROWS + more], "page_id long, url string, html string, archive string")
    entries = warc.write_archives(pages, folder, limit)
    index = warc.write_index(entries, folder, lines)
    got = sorted((tuple(r) for r in warc.read_archives(entries, folder, index).collect()), key=str)
    assert got == want(ROWS + more)
    assert [first for first, _ in index] == sorted(first for first, _ in index)
    # Every key is found, whatever block it is in, and a key that isn't there is an error.
    keys = entries.select("key").distinct()
    assert warc.lookup(keys, folder, index).count() == keys.count()
    with pytest.raises(Exception, match="no capture"):
        warc.lookup(spark.createDataFrame([("com,example)/ 0",)], "key string"), folder, index).collect()


def test_empty(spark):
    assert warc.archive_and_read(spark, spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_records():
    data = warc.record(4, "http://a/ b\r\n", b"x\r\n\r\ny", None)
    fields, payload = warc.parsed(data)
    assert payload == b"x\r\n\r\ny" and fields["WARC-Target-URI"] == "http://a/%20b%0D%0A" and data.endswith(b"y\r\n\r\n")
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    two = warc.packed(b"one" * 1000) + warc.packed(b"two")
    for chunk in (1, 7, 1 << 20):
        assert list(warc.members(io.BytesIO(two), chunk)) == [b"one" * 1000, b"two"]
    assert zlib.decompress(warc.packed(b"z"), 31) == b"z"


def test_keys():
    assert warc.capture_key("http://www.Example.com:81/A?b#c") == "com,example,www:81)/A?b"
    assert warc.capture_key("x y") == "x%20y" and warc.capture_key(None) == "-" and warc.capture_key("") == "-"
