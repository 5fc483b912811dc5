from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plaza.llm import warc

PAGES = "page_id long, url string, html string"


def plain(pages):
    rows = []
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, other in pages if (other or "") == (html or "") and p is not None]
        last = max(same, default=None)
        kind = ("response", None) if last is None or page == last else ("revisit", last)
        rows.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *kind))
    return sorted(rows, key=str)


def archived(spark, pages, path, extra=False, **options):
    frame = spark.createDataFrame(pages, PAGES)
    if extra:
        frame = frame.selectExpr("*", "'x' as digest", "1 as last", "2 as payload", "3 as revisit")
    warc.write_archives(frame.repartition(3), str(path), **options)
    found = warc.archived_pages(spark, str(path))
    return sorted(map(tuple, found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ODD = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y?q=ü b", "<p>one</p>"), (9, "http://b.example", "<p>one</p>"),
    (3, None, None), (4, "http://c.example/\r\nWARC-Type: request", ""), (5, "no scheme", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (None, "http://d.example/", "only without an id"), (None, "http://e.example/", "<p>one</p>"), (None, "http://e.example/", "only without an id"), (6, "http://f.example/", "ä漢\u0000\u001f" * 700_000), (7, "http://g.example/", "\r\n\r\n"),
    (8, "http://h.example/", "repeated"), (8, "http://h.example/", "repeated"), (8, "http://i.example/", "repeated"), (0, "http://h.example/", "repeated"),
]


@pytest.mark.parametrize("size", [1, 3000, 32 << 20])
def test_pages_come_back(spark, tmp_path, size):
    assert archived(spark, ODD, tmp_path / "w", extra=True, archive_bytes=size) == plain(ODD)


def test_no_pages(spark, tmp_path):
    assert archived(spark, [], tmp_path / "w") == []


def test_one_payload_for_most_pages(spark, tmp_path):
    pages = [(k, f"http://x.example/{k}", "" if k % 3 else f"own {k}") for k in range(1500)]
    assert archived(spark, pages, tmp_path / "w") == plain(pages)


def files(path):
    return [p for p in Path(path).iterdir() if p.name.startswith("part-")]


def test_archives_are_gzip_files_of_whole_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(ODD, PAGES).coalesce(1), str(tmp_path / "w"), archive_bytes=2000)
    kept = files(tmp_path / "w")
    assert len(kept) > 2
    text = b"".join(gzip.decompress(p.read_bytes()) for p in kept)
    assert text.count(b"WARC-Profile: " + warc.SAME_PAYLOAD.encode()) == sum(r[3] == "revisit" for r in plain(ODD))
    found = [fields for p in kept for fields, _ in warc.records_of(memoryview(p.read_bytes()))]
    assert len(found) == 3 * len(ODD)
    assert sum(f["warc-type"] == ["request"] for f in found) == len(ODD)
    assert "http://c.example/%0D%0AWARC-Type:%20request" in {f["warc-target-uri"][0] for f in found if "warc-target-uri" in f}


def test_damage_is_an_error(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(1, "http://a/", "<p>text</p>" * 50)], PAGES), str(tmp_path / "w"))
    plain_text = b"".join(gzip.decompress(p.read_bytes()) for p in files(tmp_path / "w"))
    for name, data in (("digest", plain_text.replace(b"<p>text</p>", b"<p>texT</p>", 1)), ("cut", plain_text[:200]), ("member", gzip.compress(plain_text)[:-20])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(data)
        with pytest.raises(Exception, match="another payload|cut off|ends within|not a WARC"):
            warc.read_archives(spark, str(tmp_path / name)).collect()


def test_blocks_and_payloads_come_back(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(ODD[:1], PAGES), str(tmp_path / "w"))
    row = warc.captures(warc.read_archives(spark, str(tmp_path / "w"), with_blocks=True)).first()
    assert row["response"]["block"].endswith(b"\r\n\r\n<p>one</p>")
    assert row["request"]["block"].startswith(b"GET /x HTTP/1.1\r\nHost: a.example")
    assert [m["fields"] for m in row["metadata"]] == [{"page-id": "1"}]
    assert (row["request"]["target_uri"], row["response"]["date"]) == ("http://a.example/x", warc.CAPTURED)


RECORD = "record_id string, type string, concurrent_to string, payload_bytes long"


def test_transactions_of_other_writers(spark):
    """Requests may be named by their response; some captures lack a part; a record may be read twice."""
    rows = [
        ("a", "response", None, 1), ("a1", "request", "a", None), ("a2", "metadata", "a1", None), ("a3", "metadata", "a", None),
        ("b", "response", "b1", 2), ("b1", "request", None, None), ("b2", "metadata", "b", None),
        ("c", "response", None, 3), ("c", "response", None, 3), ("c2", "metadata", "c", None),
        ("d1", "request", None, None), ("e1", "request", "lost", None), ("f2", "metadata", "lost too", None), ("w", "warcinfo", None, None),
    ]
    found = warc.captures(spark.createDataFrame(rows, RECORD)).select(
        F.col("request.record_id"), F.col("response.record_id"), F.array_sort(F.transform("metadata", lambda m: m["record_id"])))
    assert sorted(((a, b, tuple(c)) for a, b, c in found.collect()), key=str) == sorted(
        [("a1", "a", ("a2", "a3")), ("b1", "b", ("b2",)), (None, "c", ("c2",)), ("d1", None, ()), ("e1", None, ())], key=str)
