import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF, rows_of
from tradelens.llm import warc

COLS = "page_id long, url string, html string"
ODD = [(900_001, None, None), (900_002, "", ""), (900_003, "http://a.b/c\r\nX: y%41", "<p>é\r\n\r\n</p>"), (900_004, "not a url [", "same"), (900_005, "http://x.example.com:8080/p?q=1#f", "same"),
       (900_006, "http://x.example.com:8080/p?q=1", "same"), (900_006, "http://x.example.com:8080/p?q=1", "same"), (None, "http://n.com", "same"), (None, "http://n.com", "alone"),
       (900_010, "http://[bad", "x" * 2_000_000), (900_011, "http://h.com:99999/", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n")]


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= least:
            first[body] = min(page, first.get(body, page))
    count = {}
    for _, _, html in rows:
        count[(html or "").encode()] = count.get((html or "").encode(), 0) + 1
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        lead = first.get(body) if count[body] > 1 else None
        revisit = lead is not None and page != lead
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("least", [0, 4, 5])
def test_archive_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "BLOCK", 7)
    small = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    copies = [(910_000 + i, f"http://host{i % 3}.com/{i}", "copy") for i in range(150)]
    pages = small.unionByName(spark.createDataFrame(ODD + copies, COLS))
    assert rows_of(warc.archive(pages, least)) == brute([tuple(r) for r in pages.collect()], least)


def test_records_are_plain_gzip_members():
    raw = warc.record(5, "http://a.com/x", b"body\r\n\r\n", warc.digest_of(b"body\r\n\r\n"), None, False)
    text = gzip.decompress(raw + raw)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response") and text.count(b"WARC/1.1") == 2
    assert warc.parse(gzip.decompress(raw))["payload"] == b"body\r\n\r\n"


def test_url_keys():
    assert warc.url_key("http://www.Example.com/a?b=1#c") == "com,example,www)/a?b=1"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"


def test_lookup_finds_all_captures_of_a_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 5)
    rng = random.Random(1)
    pages = [(i, f"http://h{rng.randrange(6)}.com/{rng.randrange(10)}", f"p{i}") for i in range(400)] + [(1000 + i, "http://hot.com/", f"q{i}") for i in range(300)]
    captures = warc.write(spark.createDataFrame(pages, COLS), f"{tmp_path}/w")
    index = warc.build_index(captures, f"{tmp_path}/w")
    asked = ["http://hot.com/", "http://h1.com/3", "http://none.com/"]
    found = warc.lookup(index, spark.createDataFrame([(warc.url_key(u),) for u in asked * 2], "key string"))
    assert sorted(r.page_id for r in found.collect()) == sorted(i for i, u, _ in pages if u in asked)
    assert sorted((r.page_id, r.payload.decode()) for r in warc.read(found).collect()) == sorted((i, b) for i, u, b in pages if u in asked)


def test_digest_is_that_of_the_payload_as_read(spark, tmp_path):
    """A stored payload is altered in place, its header left as it is."""
    captures = warc.write(spark.createDataFrame([(i, f"http://a.com/{i}", f"payload {i}") for i in range(3)], COLS).coalesce(1), f"{tmp_path}/w")
    name = captures.first().file
    raw = open(name.removeprefix("file://"), "rb").read()
    out, places = b"", []
    for r in sorted(captures.collect(), key=lambda r: r.offset):
        member = gzip.decompress(raw[r.offset:r.offset + r.length]).replace(b"payload 1", b"PAYLOAD 1")
        places.append((name, len(out), len(gzip.compress(member, mtime=0))))
        out += gzip.compress(member, mtime=0)
    with open(name.removeprefix("file://"), "wb") as f:
        f.write(out)
    got = {r.page_id: r.payload_digest for r in warc.read(spark.createDataFrame(places, "file string, offset long, length long")).collect()}
    assert got == {i: warc.digest_of(b"PAYLOAD 1" if i == 1 else f"payload {i}".encode()) for i in range(3)}


def test_reads_are_dealt_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LEAST", 1000)
    rng = random.Random(3)
    pages = [(i, f"http://a.com/{i}", "".join(rng.choices("abcdefgh ", k=3000))) for i in range(80)]
    captures = warc.write(spark.createDataFrame(pages, COLS).coalesce(1), f"{tmp_path}/w")
    read = warc.read(captures, payloads=False).withColumn("task", F.spark_partition_id())
    rows = read.collect()
    assert sorted(r.page_id for r in rows) == list(range(80)) and all(r.payload is None and r.payload_bytes == 3000 for r in rows)
    assert len({r.task for r in rows}) > 1


def test_columns_of_clashing_names(spark):
    odd = spark.createDataFrame([(1, "http://a.com/", "x", "s", 3, "k"), (2, "http://a.com/", "x", "s", 3, "k")], COLS + ", Sha string, offset int, key string")
    assert [r[0::3] for r in rows_of(warc.archive(odd))] == [(1, "response"), (2, "revisit")]


def test_empty(spark):
    assert warc.archive(spark.createDataFrame([], COLS)).count() == 0
