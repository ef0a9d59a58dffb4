"""WARC archives: writing pages as response and revisit records, in segments with chunked framing,
and reading any archive back, with segments put together, checked, and their framing taken off."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_batches

CRLF = "\r\n"
#: Fixed values of the WARC and HTTP formats.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = "Transfer-Encoding: chunked\r\n"


@dataclass(frozen=True)
class Params:
    #: Payloads shorter than this are never revisits.
    least_bytes: int = 100
    chunk_bytes: int = 8_192
    segment_bytes: int = 65_536
    records_per_file: int = 1_000
    date: str = "2024-01-01T00:00:00Z"


def head(*lines: tuple[str, Column | str | None]) -> Column:
    """Header lines; one whose value is NULL is left out."""
    parts = [F.lit(VERSION + CRLF)]
    for name, value in lines:
        value = F.lit(value) if isinstance(value, str) else value
        parts.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*parts, F.lit(CRLF))


def slices(data: Column, each: int) -> Column:
    """Binary data as an array of strings of `each` bytes; the last may be shorter."""
    n = F.octet_length(data)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / each).cast("int") - 1))
    cut = F.transform(starts, lambda i: F.substring(data, i * each + 1, F.lit(each)).cast("string"))
    return F.coalesce(cut, F.array().cast("array<string>"))


def chunked(payload: Column, each: int) -> Column:
    """Chunked transfer framing of binary data, as a string."""

    def frame(chunk: Column) -> Column:
        return F.concat(F.lower(F.hex(F.octet_length(chunk))), F.lit(CRLF), chunk, F.lit(CRLF))

    return F.concat(F.array_join(F.transform(slices(payload, each), frame), ""), F.lit("0\r\n\r\n"))


def write_archives(pages: DataFrame, path: str, params: Params = Params(), key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes a record for each row below `path`, in gzip files of bounded size.

    Of rows with equal payloads of `least_bytes` or more, the one with the smallest key is the
    response, the others are revisits of it. A NULL payload is empty. A NULL key counts as the
    largest and is left out of the record, as is a NULL url. Rows equal in key, url and payload are
    records of one identifier; if that is the response's, all of them are responses.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page"),
        F.regexp_replace(F.col(url).cast("string"), r"[\r\n]+", "%0A").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page").cast("string"), F.lit("")), "digest", F.coalesce("url", F.lit(""))))
    rows = rows.withColumn("record", F.concat(F.lit("<urn:uuid:"), uuid(name), F.lit(">")))
    first = (
        rows.where(F.col("bytes") >= params.least_bytes)
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("page").isNull().alias("last"), "page", "record")).alias("first"))
        .select("digest", F.col("first.record").alias("original"))
    )
    rows = rows.join(first, "digest", "left")
    revisit = (F.col("bytes") >= params.least_bytes) & (F.col("original") != F.col("record"))
    common = [
        ("WARC-Date", params.date),
        ("WARC-Target-URI", F.col("url")),
        ("X-Page-ID", F.col("page").cast("string")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    bare = HTTP_HEAD + CRLF
    repeated = F.concat(
        head(
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", F.col("record")),
            ("WARC-Refers-To", F.col("original")),
            ("WARC-Profile", SAME_PAYLOAD),
            *common,
            ("Content-Length", str(len(bare))),
        ),
        F.lit(bare),
    )
    block = F.concat(F.lit(HTTP_HEAD + CHUNKED + CRLF), chunked(F.col("payload").cast("binary"), params.chunk_bytes))
    parts = F.col("parts")

    def segment(text: Column, i: Column) -> Column:
        several, last = F.size(parts) > 1, i == F.size(parts) - 1
        number = F.when(several, (i + 1).cast("string"))
        length = F.octet_length(text).cast("string")
        lead = head(
            ("WARC-Type", "response"),
            ("WARC-Record-ID", F.col("record")),
            *common,
            ("WARC-Segment-Number", number),
            ("Content-Length", length),
        )
        own = F.concat(F.lit("<urn:uuid:"), uuid(F.md5(F.concat(F.col("record"), F.lit("|"), (i + 1).cast("string")))), F.lit(">"))
        follow = head(
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", own),
            ("WARC-Date", params.date),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Segment-Origin-ID", F.col("record")),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", F.when(last, F.col("total").cast("string"))),
            ("Content-Length", length),
        )
        return F.concat(F.when(i == 0, lead).otherwise(follow), text)

    responses = (
        rows.where(~F.coalesce(revisit, F.lit(False)))
        .withColumn("block", block)
        .withColumn("total", F.octet_length("block"))
        .withColumn("parts", slices(F.col("block").cast("binary"), params.segment_bytes))
        .select(F.explode(F.transform("parts", segment)).alias("value"))
    )
    records = responses.unionAll(rows.where(revisit).select(repeated.alias("value")))
    # The two line breaks after a record are the writer's line separator.
    records.write.options(lineSep=CRLF * 2, compression="gzip", maxRecordsPerFile=params.records_per_file).text(path)


def uuid(md5: Column) -> Column:
    return F.regexp_replace(md5, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


RECORD = "type string, record string, page long, refers_to string, origin string, number int, total long, digest string, block binary"
#: Header names by column.
HEADERS = {
    "type": "warc-type",
    "record": "warc-record-id",
    "page": "x-page-id",
    "refers_to": "warc-refers-to",
    "origin": "warc-segment-origin-id",
    "number": "warc-segment-number",
    "total": "warc-segment-total-length",
    "digest": "warc-payload-digest",
}


def parse(archive: bytes) -> Iterator[dict]:
    """The records of an archive, by their stated lengths."""
    while archive:
        if archive[:2] == b"\x1f\x8b":
            unzip = zlib.decompressobj(31)
            data, archive = unzip.decompress(archive) + unzip.flush(), unzip.unused_data
        else:
            data, archive = archive, b""
        at = 0
        while at < len(data):
            end = data.find(b"\r\n\r\n", at)
            lines = data[at : max(end, at)].decode("utf-8", "replace").split(CRLF)
            named = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
            if not lines[0].startswith("WARC/") or not named.get("content-length", "").isdigit():
                raise ValueError(f"no WARC record at byte {at}")
            start, length = end + 4, int(named["content-length"])
            if start + length > len(data):
                raise ValueError(f"the record at byte {at} is cut off")
            row = {c: named.get(h) for c, h in HEADERS.items()}
            row |= {c: row[c] and int(row[c]) for c in ("page", "number", "total")}
            yield row | {"block": data[start : start + length]}
            at = start + length + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records below `path` as they are stored. A file is read whole by one task."""
    kinds = pa.schema(
        [("type", pa.string()), ("record", pa.string()), ("page", pa.int64()), ("refers_to", pa.string())]
        + [("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("digest", pa.string()), ("block", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for archive in batch.column(0):
                for row in parse(archive.as_py()):
                    held.append(row)
                    size += len(row["block"])
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, kinds)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return map_batches(files.select("content"), run, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: segments are grouped by their origin, put in order of their numbers, and their
    lengths must add up to the stated total. `complete` is false, and the block NULL, if a segment
    is missing, differs from one of its number, or the total is not met."""
    alone = records.where("number IS NULL AND type <> 'continuation'").drop("origin", "number", "total")
    alone = alone.withColumn("complete", F.lit(True))
    parts = records.where("number IS NOT NULL OR type = 'continuation'").withColumn("origin", F.coalesce("origin", "record"))
    lead = F.max(F.when(F.col("type") != "continuation", F.struct("type", "page", "refers_to", "digest")))
    joined = parts.groupBy("origin").agg(
        F.sort_array(F.collect_set(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.count_if(F.col("number") == 1).alias("copies"),
        lead.alias("lead"),
    )
    numbers = F.transform("parts", lambda p: p["number"])
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    whole = (numbers == F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1)))) & (F.octet_length(block) == F.col("total"))
    whole = F.coalesce(whole, F.lit(False))
    # Equal records of one identifier were put together; each counts.
    many = F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(F.col("copies"), F.lit(1).cast("long"))))
    segmented = joined.select(
        F.col("lead.type").alias("type"),
        F.col("origin").alias("record"),
        F.col("lead.page").alias("page"),
        F.col("lead.refers_to").alias("refers_to"),
        F.col("lead.digest").alias("digest"),
        F.when(whole, block).alias("block"),
        whole.alias("complete"),
        many.alias("copy"),
    ).drop("copy")
    return alone.unionByName(segmented)


def dechunk(body: bytes) -> bytes | None:
    """The data of a chunked body; None if its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].partition(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or size and body[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def payload_of(block: bytes | None) -> bytes | None:
    """The body of an HTTP response, without its transfer framing."""
    if block is None:
        return None
    lead, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    names = [x.lower().replace(b" ", b"") for x in lead.split(b"\r\n")[1:]]
    return dechunk(body) if b"transfer-encoding:chunked" in names else body


def payloads(whole: DataFrame) -> DataFrame:
    """Adds `payload` in place of the block; NULL for a broken one."""
    schema = whole.drop("block").schema.add("payload", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 200) for k in range(0, batch.num_rows, 200)):
                found = pa.array([payload_of(b.as_py()) for b in part.column("block")], pa.binary())
                others = [n for n in part.schema.names if n != "block"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in others), found], [*others, "payload"])

    return map_batches(whole, run, schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response and revisit: page_id, payload_bytes, payload_digest, record_type,
    refers_to, valid (the record is complete and its payload has the stated digest), payload.

    A revisit has the figures of the response it refers to, and no payload of its own.
    """
    found = payloads(reassemble(read_records(spark, path))).where("type IN ('response', 'revisit')")
    digest = F.sha2("payload", 256)
    found = found.withColumns({"bytes": F.octet_length("payload").cast("long"), "own": digest})
    found = found.withColumn("stated", F.regexp_replace("digest", "^sha256:", ""))
    responses = found.where("type = 'response'")
    figures = responses.groupBy("record").agg(
        F.min("page").alias("original_page"), F.min("bytes").alias("original_bytes"), F.min("own").alias("original_digest")
    )
    revisits = found.where("type = 'revisit'").drop("payload", "bytes", "own", "record")
    revisits = revisits.join(figures, revisits.refers_to == figures.record, "left")
    plain = responses.select(
        F.col("page").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("own").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
        F.coalesce(F.col("complete") & (F.col("own") == F.col("stated")), F.lit(False)).alias("valid"),
        "payload",
    )
    again = revisits.select(
        F.col("page").alias("page_id"),
        F.col("original_bytes").alias("payload_bytes"),
        F.col("original_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("original_page").alias("refers_to"),
        F.coalesce(F.col("original_digest") == F.col("stated"), F.lit(False)).alias("valid"),
        F.lit(None).cast("binary").alias("payload"),
    )
    return plain.unionAll(again)
