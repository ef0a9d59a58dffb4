"""Archives: exact round trips, and what broken ones give."""

import hashlib
import gzip

import pytest
from pyspark.sql import functions as F

from strata.llm import warc
from strata.llm.common import shared_folder
from strata.llm.warc import Params

SCHEMA = "page_id long, url string, html string, payload string, type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def round_trip(spark, rows, params=Params()):
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(pages(spark, rows), path, params)
    return path, warc.read_pages(spark, path)


ROWS = [
    (3, "http://a/", "<p>" + "é" * 500),
    (1, "http://b/", "<p>" + "é" * 500),
    (2, None, "short"),
    (4, "http://c/\r\nWARC-Type: response", "short"),
    (5, "http://d/", None),
    (6, "http://e/", ""),
    (7, "http://f/", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n0\r\n\r\n" * 40),
    (8, "http://g/", "x" * 300_000 + "ü€𐍈\x00\r\n\r\n"),
    (9, "http://h/", "é" * 100_000),
    (None, "http://i/", "no key"),
]


@pytest.mark.parametrize("params", [Params(), Params(chunk_bytes=7, segment_bytes=1001, records_per_file=50), Params(segment_bytes=64, chunk_bytes=1000)])
def test_round_trip(spark, params):
    path, found = round_trip(spark, ROWS, params)
    got = {r.page_id: r for r in found.collect()}
    first = {}
    for page, _, html in sorted(ROWS, key=lambda r: (r[0] is None, r[0])):
        body = (html or "").encode()
        original = first.setdefault(body, page) if len(body) >= 100 else page
        r = got.pop(page)
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert r.record_type == ("response" if original == page else "revisit")
        assert r.refers_to == (None if original == page else original)
        assert r.valid and r.payload == (body if original == page else None)
    assert not got


def test_files_are_plain_warc(spark):
    path, _ = round_trip(spark, ROWS)
    for r in spark.read.format("binaryFile").load(path).collect():
        data, at = gzip.decompress(r.content), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = data[at:end].split(b"\r\n")
            assert head[0] == b"WARC/1.1"
            length = int(dict(x.split(b": ", 1) for x in head[1:])[b"Content-Length"])
            assert data[end + 4 + length : end + 8 + length] == b"\r\n\r\n"
            at = end + 8 + length


def test_repeated_rows_are_records_each(spark):
    long = "z" * 1000
    _, found = round_trip(spark, [(1, "u", long)] * 3 + [(2, "u", long)] * 2, Params(segment_bytes=200))
    assert sorted((r.page_id, r.record_type, r.refers_to, r.valid) for r in found.collect()) == [
        (1, "response", None, True)] * 3 + [(2, "revisit", 1, True)] * 2


def test_empty_table(spark):
    assert round_trip(spark, [])[1].collect() == []


def test_missing_and_differing_segments_are_told(spark):
    path, _ = round_trip(spark, [(1, "u", "a" * 500), (2, "u", "b" * 500)], Params(segment_bytes=100))
    records = warc.read_records(spark, path)
    assert records.where("type = 'continuation'").count() > 4
    part = F.col("type").eqNullSafe("continuation") & (F.col("number") == 3)
    whole = {r.page: r.complete for r in warc.reassemble(records.where(~part | F.col("block").contains(b"bbb"))).collect()}
    assert whole == {1: False, 2: True}
    changed = records.unionAll(records.where(part).withColumn("block", F.lit(b"zz")))
    assert not any(r.complete for r in warc.reassemble(changed).collect())
    longer = records.withColumn("total", F.col("total") + 1)
    assert not any(r.complete for r in warc.reassemble(longer).collect())


@pytest.mark.parametrize("body, data", [
    (b"0\r\n\r\n", b""), (b"3;x=1\r\nabc\r\n1\r\nd\r\n0\r\nTrailer: 1\r\n\r\n", b"abcd"), (b"A\r\n0123456789\r\n0\r\n\r\n", b"0123456789"),
    (b"3\r\nab", None), (b"zz\r\n", None), (b"", None), (b"3\r\nabcd\r\n0\r\n", None), (b"-1\r\n", None)])
def test_dechunk(body, data):
    assert warc.dechunk(body) == data


def test_malformed_archives_are_refused():
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
