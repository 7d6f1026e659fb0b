import hashlib

import pytest

from tripengine.llm import warc
from tripengine.llm.common import scratch

PAGES = "page_id long, url string, html string, digest string"
BIG = "<html>" + "é" * 200
ROWS = [(4, "http://a/x y", BIG, "z"), (2, "http://b", BIG, "z"), (3, None, BIG, "z"), (5, "u", "short", "z"),
        (6, "u", "short", "z"), (7, "u", None, "z"), (8, "u", "", "z"), (None, "n", BIG, "z"),
        (9, "t", "q" * 100, "z"), (9, "t", "q" * 100, "z"), (10, "t", "r\r\n\r\n" * 50_000, "z"),
        (None, "only", "s" * 150, "z"), (None, "only", "s" * 150, "z")]


def want(rows):
    found = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "").encode() == data and p is not None]
        first = min(same, default=None)
        to = first if len(data) >= 100 and first is not None and page_id != first else None
        found.append((page_id, len(data), hashlib.sha256(data).hexdigest(),
                      "response" if to is None else "revisit", to))
    return sorted(found, key=str)


@pytest.fixture
def pages(session):
    return session.createDataFrame(ROWS, PAGES)


def test_round_trip(session, pages):
    assert sorted(map(tuple, warc.round_trip(session, pages).collect()), key=str) == want(ROWS)


def test_parts_of_the_index_in_small_reads(session, pages):
    folder = scratch(session, "w")
    index = warc.write_archives(pages, folder, archive_bytes=600)
    assert index.select("archive").distinct().count() > 1
    some = index.where("page_id IN (2, 5, 10)")
    found = {r.page_id: r for r in warc.read_records(some, folder, read_bytes=50, gap_bytes=0).collect()}
    assert sorted(found) == [2, 5, 10]
    assert bytes(found[10].payload).decode() == "r\r\n\r\n" * 50_000 and found[2].url == "http://b"


def test_records_are_warc():
    data = warc.record(4, "http://a/x y\r\nZ: 1", "d", b"body", None)
    fields, size, payload = warc.parsed(data)
    assert fields["warc-target-uri"] == "http://a/x%20y%0D%0AZ:%201" and "z" not in fields
    assert (size, payload, fields["warc-type"]) == (4, b"body", "response")
    fields, size, payload = warc.parsed(warc.record(5, None, "d", b"body", 4))
    assert (size, payload, fields["warc-refers-to"]) == (4, b"", "<urn:page:4>")


def test_an_index_of_other_records_is_refused(session, pages):
    folder = scratch(session, "w")
    index = warc.write_archives(pages, folder)
    from pyspark.sql import functions as F
    wrong = index.withColumn("digest", F.lit("0" * 64))
    with pytest.raises(Exception, match="not the index's"):
        warc.read_records(wrong, folder).collect()


def test_empty_table(session):
    assert warc.round_trip(session, session.createDataFrame([], PAGES)).collect() == []
