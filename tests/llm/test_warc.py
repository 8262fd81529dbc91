from __future__ import annotations

import gzip
import hashlib
import os
from base64 import b32encode

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from rolemart.llm import registry, warc
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string"


def _expected(rows):
    best = {}
    for page_id, _, html in rows:
        key = (html or "").encode()
        if page_id is not None:
            best[key] = max(page_id, best.get(key, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = page_id is not None and page_id < best[data]
        out.append((page_id, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", best[data] if revisit else None))
    return sorted(out, key=str)


def _query(spark, path):
    return sorted((tuple(r) for r in registry.spark_queries()["op4_index_first_warc"](spark, path).collect()), key=str)


ROWS = [(1, "http://a/", "same"), (2, "http://b/ x", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nx" * 20_000), (6, "u", "own"), (7, "u", "own"), (7, "u", "own"),
        (None, "u", "same"), (None, None, None), *[(100 + i, "u", "copy") for i in range(300)]]


def test_query_on_driver_pages(spark):
    assert _query(spark, SF) == _expected([tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()])


def test_made_up_pages(spark, folder):
    assert _query(spark, folder(pages=(PAGES, ROWS))) == _expected(ROWS)
    assert _query(spark, folder(pages=(PAGES, []))) == []


@pytest.fixture
def archive(spark, frame, tmp_path):
    pages = frame(PAGES + ", digest string, part int", *[(*r, "d", 1) for r in ROWS]).repartition(4)
    return warc.write(pages, str(tmp_path / "warc")), str(tmp_path / "warc")


def test_archives_are_plain_warc_files(archive):
    index, folder = archive
    n = 0
    for name in os.listdir(folder):
        data = gzip.decompress(open(f"{folder}/{name}", "rb").read())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(next(x.split(b":")[1] for x in head.split(b"\r\n") if x.startswith(b"Content-Length")))
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            data, n = rest[size + 4 :], n + 1
    assert n == len(ROWS) == index.count()


def test_selected_records_are_read_by_ranges(archive):
    index, folder = archive
    some = index.where("page_id % 7 = 0 OR page_id = 5")
    for gap, most in ((0, 8_388_608), (65_536, 8_388_608), (0, 1), (1 << 40, 1 << 40)):
        got = warc.read(some, folder, gap, most).collect()
        assert sorted(r["page_id"] for r in got) == sorted(r["page_id"] for r in some.collect())
        assert {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}[5] == ROWS[5][2]
        ranges = warc.byte_ranges(some, gap, most).collect()
        assert sum(len(r["records"]) for r in ranges) == some.count()
        assert all(r["start"] <= x["offset"] and x["offset"] + x["length"] <= r["end"] for r in ranges for x in r["records"])
    assert warc.byte_ranges(some, 1 << 40, 1 << 40).count() == some.select("file").distinct().count()


def test_least_bytes(frame, tmp_path):
    pages = frame(PAGES, (1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"))
    index = warc.write(pages, str(tmp_path / "w"), least_bytes=3)
    assert {r["page_id"]: r["refers_to"] for r in index.collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_a_wrong_index_is_noticed(archive):
    index, folder = archive
    with pytest.raises(PythonException):
        warc.read(index.withColumn("page_id", F.coalesce("page_id", F.lit(0)) + 1), folder).collect()
