"""Archives have to hold every page exactly, and name originals as a plain grouping does."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import web_archives as warc
from claimgauge.sources.scratch import fresh_path

SCHEMA = "page_id long, url string, html string"
TRICKY = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n é \U0001f642 \x00"
EDGE = [
    (5, "http://a/b c?é=1", TRICKY), (3, None, TRICKY), (9, "http://x\r\ny: z", TRICKY),
    (1, "u", None), (2, "u", ""), (7, "big", "x" * 300_000),
    (8, "u", "same"), (8, "u", "same"), (None, "u", "same"), (None, None, "alone"), (11, "%41", "same"),
]


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, url, html in rows:
        body = (html or "").encode()
        original = first.get(html or "")
        original = original if original is not None and (page is None or original < page) else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, url, len(body), digest, "response" if original is None else "revisit", original))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


def test_edge_rows(spark):
    pages = spark.createDataFrame(EDGE, SCHEMA).withColumns({"payload": F.lit(1), "payload_digest": F.lit("x"), "content": F.lit(2)})
    assert got(warc.archived(pages)) == expected(EDGE)


def test_payloads_survive_and_rewriting_changes_nothing(spark):
    pages = spark.createDataFrame([r for r in EDGE if r[0] is not None], SCHEMA)
    one, two = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.archived(pages, folder=one)
    html = {r[0]: r[2] or "" for r in EDGE}
    back = warc.read_archives(spark, one)
    assert all(r.payload == html[r.page_id] for r in back.collect() if r.record_type == "response")
    warc.rewrite(spark, one, two)
    assert got(warc.read_archives(spark, two)) == got(back)


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame(EDGE, SCHEMA)
    out = warc.archived(pages, min_bytes=10).collect()
    assert {r.record_type for r in out if r.payload_bytes < 10} == {"response"}


def test_damage_is_noticed():
    record = warc._record(1, "u", "abc", warc.payload_digest(b"abc"), 3, None, None, "d").encode() + b"\r\n\r\n"
    assert len(list(warc.parse(record * 2))) == 2
    with pytest.raises(ValueError):
        list(warc.parse(record[:-4] + b"x\r\n\r\n" + record))


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert got(warc.archived(pages)) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_are_cut_by_bytes(spark, tmp_path):
    import glob
    import gzip

    sizes = [10, 400_000, 700_000, 3_000_000, 5, 900_000, 900_000, 20]
    pages = spark.createDataFrame([(i, f"u{i}", chr(233) * (n // 2) + str(i)) for i, n in enumerate(sizes)], "page_id long, url string, payload string")
    folder = f"{tmp_path}/cut"
    warc.write_archives(pages.coalesce(1), folder, archive_mb=1)
    found = [gzip.open(f).read() for f in sorted(glob.glob(f"{folder}/*.gz"))]
    counts = [len(list(warc.parse(raw))) for raw in found]
    assert sum(counts) == len(sizes) and max(counts) > 1
    assert all(len(raw) <= (1 << 20) + 4 * n or n == 1 for raw, n in zip(found, counts, strict=True))
    back = {r.page_id: r.payload for r in warc.read_archives(spark, folder).collect()}
    assert back == {r.page_id: r.payload for r in pages.collect()}
