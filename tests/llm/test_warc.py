import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from meterline.llm import warc
from meterline.llm.common import table
from tests.llm.conftest import LONG, SF_DIR


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def compare(pages, compress=True):
    rows = [(r.page_id, r.html) for r in pages.select("page_id", "html").collect()]
    index = warc.write_archives(warc.plan_records(pages), compress)
    got = sorted(map(str, warc.digest(index).collect()))
    top = {}
    for i, html in rows:
        if i is not None:
            top[html or ""] = max(top.get(html or "", i), i)
    want = []
    for i, html in rows:
        first = top.get(html or "")
        own = first is None or i == first
        want.append((i, len((html or "").encode()), digest(html), "response" if own else "revisit", None if own else first))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, w, strict=True)) + ")" for w in want)
    return index


@pytest.fixture(scope="module")
def pages(ready):
    return table(ready, SF_DIR, "pages")


def test_equals_brute_force_on_the_table(pages):
    compare(pages)


@pytest.mark.parametrize("compress", [True, False])
def test_odd_pages(ready, compress):
    rows = [(1, "u", "same"), (5, "u", "same"), (3, None, "same"), (2, "a\r\nWARC-Type: x", None), (9, "v", ""), (9, "v", ""), (None, "w", "same"), (None, "w", "lone"), (4, "x", "é😀\r\n\r\nWARC/1.1\r\n\r\n"), (6, "y", LONG)]
    rows = [(*r, "clash", 1) for r in rows]
    pages = ready.createDataFrame(rows, "page_id bigint, url string, html string, digest string, refers_to int")
    compare(pages, compress)
    compare(pages.limit(0), compress)


def test_selected_records_come_back_whole(pages):
    index = warc.write_archives(warc.plan_records(pages.repartition(2)))
    some = index.where("page_id % 5 = 0")
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read_records(some).collect()}
    assert got == {r.page_id: (r.url, r.html) for r in pages.where("page_id % 5 = 0").collect()}


def test_neighbours_are_read_together(pages):
    index = warc.write_archives(warc.plan_records(pages.coalesce(1)))
    runs = warc.plan_reads(index).collect()
    assert len(runs) == 1 and runs[0].start == 0 and len(runs[0].parts) == index.count()
    assert warc.plan_reads(index.where("page_id = 7")).select(F.sum(F.col("stop") - F.col("start"))).first()[0] == index.where("page_id = 7").first().length


def test_offsets_tile_the_files(pages):
    by_file = {}
    for r in warc.write_archives(warc.plan_records(pages)).orderBy("file", "offset").collect():
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + r.length
