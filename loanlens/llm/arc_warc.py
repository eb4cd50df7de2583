"""Conversion of legacy ARC archives to WARC.

An ARC file begins with a version block that says which fields the one-line record headers
have: five in version 1, ten in version 2.  The last is the record's length in bytes, and
nothing else tells where a record ends.  A record becomes a WARC record with an identifier
made from its place, its date in the newer form, a type from its content, and digests of
block and payload; a record whose payload was seen before becomes a revisit.

Archives are files of bounded bytes (or one record), each record a gzip member of its own.
Tasks number their files by the running size and Spark's writer puts them down, so commits
and retries are Spark's.  It wants a separator between rows: that is the last byte of a
member, which is 0 for members below 16 MB; larger ones are followed by an empty member.
Files are read back whole and parsed as streams, member after member, a record at a time.
Which payloads are equal is found on (digest, place) rows; payloads move at most once, when
the types join in.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import materialised, shared_dir

# Bytes of records, before compression, after which a file is full.
FILE_BYTES = 64_000_000
# Rows or bytes of parsed records that are passed on at a time.
BATCH_ROWS, BATCH_BYTES = 500, 8_000_000
# The header fields of the two ARC versions, and the revisit profile of WARC.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ORIGIN = "0.0.0.0"
PAGE = "X-Page-Id"

ARC_COLUMNS = (
    "place string, uri string, ip string, date string, mime string, page_id string, "
    "head binary, payload binary, payload_bytes long, payload_digest string, block_digest string"
)
WARC_COLUMNS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32, as archives write it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload of an HTTP response; a block that is none has no head."""
    end = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    return (block[: end + 4], block[end + 4 :]) if end >= 0 else (b"", block)


def _page_id(head: bytes) -> str | None:
    found = re.search(rb"^" + PAGE.encode() + rb": *(-?\d+)\r$", head, re.M)
    return found[1].decode() if found else None


def read_arc(stream: BinaryIO) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records of an ARC file, the version block left out.

    Lines that are no header for the version are skipped up to the next that is one; a
    record that is cut off at the end of the file is left out.
    """
    names, at = FIELDS[1].split(), 0
    while line := stream.readline():
        start, at = at, at + len(line)
        parts = line.decode("latin-1").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if line.startswith(b"filedesc:"):
            parts = line.decode("latin-1").split()
        if len(parts) < 5 or not parts[-1].isdigit():
            continue
        block = stream.read(int(parts[-1]))
        at += len(block)
        if line.startswith(b"filedesc:"):
            version = block.split(b" ", 1)[0]
            names = FIELDS[2 if version == b"2" else 1].split()
        elif len(block) == int(parts[-1]):
            yield start, dict(zip(names, parts)), block


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of the records of a WARC file."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def _opened(content: bytes) -> BinaryIO:
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def warc_date(date: str) -> str:
    """14 digits (or fewer, from the year on) as an ISO instant; without a year, the first of 1970."""
    digits = re.sub(r"\D", "", date)
    full = (digits if len(digits) >= 4 else "1970") + "19700101000000"[max(4, len(digits)) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    part, weight = [], 0
    for row in rows:
        part.append(row)
        weight += size(row)
        if len(part) >= BATCH_ROWS or weight >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part, weight = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))])


def member(data: bytes) -> bytes:
    """A record as a gzip member that ends in a zero byte."""
    packed = gzip.compress(data, 4, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", 4, mtime=0)


def _write(records: DataFrame, path: str, most: int, begin: Column | None = None) -> None:
    """Write ``record`` (binary) to files of about ``most`` bytes, ``begin`` in front of each file's first."""
    row = F.monotonically_increasing_id()
    rows = records.select(row.alias("row"), "record", (F.lit(None) if begin is None else begin).cast("binary").alias("begin"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, file = 0, None

        def members() -> Iterator[tuple]:
            nonlocal held, file
            for batch in batches:
                for row, record, begin in zip(*(c.to_pylist() for c in batch.columns)):
                    value = member(record)
                    if file is None or held + len(record) > most:
                        # The first row's number, which holds its task's, names a file.
                        file, held = f"{row:020d}", 0
                        value = (member(begin) if begin else b"") + value
                    held += len(record)
                    yield file, row, value[:-1]

        yield from _batches(members(), _schema("file string, row long, value binary"), lambda r: len(r[2]))

    sorted_rows = rows.mapInArrow(packed, "file string, row long, value binary").sortWithinPartitions("file", "row")
    # Bytes pass through a text column untouched, whatever they are.
    sorted_rows.select("file", F.col("value").cast("string").alias("value")).write.partitionBy("file").option("lineSep", "\0").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", "content")


def arc_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all ARC files in a folder; without payloads just their sizes and digests."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    name = "/".join(file.rsplit("/", 2)[-2:])
                    for at, f, block in read_arc(_opened(content.as_py())):
                        head, payload = _http(block)
                        shown = (head, payload) if payloads else (None, None)
                        yield (
                            f"{name}:{at}", f["URL"], f["IP-address"], warc_date(f["Archive-date"]), f["Content-type"],
                            _page_id(head), *shown, len(payload), digest(payload), digest(block) if payloads else None,
                        )

        yield from _batches(rows(), _schema(ARC_COLUMNS), lambda r: len(r[6] or b"") + len(r[7] or b""))

    return _files(spark, path).mapInArrow(parse, ARC_COLUMNS)


def write_arc(pages: DataFrame, path: str, date: str = "20000101000000", file_bytes: int = FILE_BYTES) -> None:
    """Pages as ARC files, version 1 and 2 by task: one record per row, the html as the payload of an HTTP response.

    The version block stands in front of the first record of each file.
    """
    html = F.coalesce("html", F.lit(""))
    known = F.col("page_id").isNotNull()
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"),
        F.when(known, F.concat(F.lit(f"{PAGE}: "), F.col("page_id").cast("string"), F.lit("\r\n"))).otherwise(""),
        F.lit("\r\n"),
    )
    # An address must not hold what separates the fields.
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "\\s", "%20")
    uri = F.when(uri == "", "urn:none").otherwise(uri)
    rows = pages.select(uri.alias("uri"), F.concat(head, html).alias("block"), (F.pmod(F.spark_partition_id(), F.lit(2)) == 1).alias("two"))
    two = F.col("two")
    length = F.octet_length("block").cast("string")

    def described(version: int) -> Column:
        text = f"{version} 0 spark\n{FIELDS[version]}\n"
        return F.lit(f"filedesc://pages.arc {ORIGIN} {date} text/plain " + ("200 - - 0 pages.arc " if version == 2 else "") + f"{len(text)}\n{text}\n")

    def line(version: int) -> Column:
        return F.concat_ws(" ", "uri", F.lit(f"{ORIGIN} {date} text/html" + (" 200 - - 0 pages.arc" if version == 2 else "")), length)

    record = F.concat(F.when(two, line(2)).otherwise(line(1)), F.lit("\n"), F.col("block"), F.lit("\n"))
    begin = F.when(two, described(2)).otherwise(described(1))
    _write(rows.select(record.cast("binary").alias("record"), begin.alias("begin")), path, file_bytes, F.col("begin"))


def revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """(place, refers_to, refers_place) of the records that repeat a payload of ``least`` bytes or more.

    Of equal payloads the one with the smallest page_id is the response; records without an
    id come after all others, and the place decides among repeated rows.
    """
    known = F.col("page_id").cast("decimal(38,0)")
    order = F.struct(known.isNull().alias("none"), known.alias("id"), F.col("place").alias("place"), F.col("uri").alias("uri"), F.col("date").alias("date"))
    sized = records.filter(F.col("payload_bytes") >= least)
    first = sized.groupBy("payload_digest", "payload_bytes").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = sized.join(first, ["payload_digest", "payload_bytes"]).filter("place <> first.place")
    return repeated.select(
        "place", F.col("first.id").cast("string").alias("refers_to"), F.col("first.place").alias("refers_place"),
        F.col("first.uri").alias("refers_uri"), F.col("first.date").alias("refers_date"),
    )


def _identifier(place: Column) -> Column:
    """A UUID of version 5's form from a record's place."""
    h = F.sha1(F.concat(F.lit(uuid.NAMESPACE_URL.hex), place))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", cut(1, 8), cut(9, 4), F.concat(F.lit("5"), cut(14, 3)), F.concat(F.lit("8"), cut(18, 3)), cut(21, 12)), F.lit(">"))


def convert(spark: SparkSession, arc: str, warc: str, least: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """All ARC files of one folder as WARC files in another."""
    seen = materialised(arc_records(spark, arc, payloads=False).select("place", "uri", "date", "page_id", "payload_bytes", "payload_digest"), "arc-digests")
    known = materialised(revisits(seen, least), "arc-revisits")
    rows = arc_records(spark, arc).join(known, "place", "left")
    again, http = F.col("refers_place").isNotNull(), F.octet_length("head") > 0
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    block_digest = F.when(~again, F.col("block_digest"))

    def field(name: str, value: Column) -> Column:
        """A header line; nothing where the value is null."""
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    header = F.concat_ws(
        "",
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(again, "revisit").when(http, "response").otherwise("resource")),
        field("WARC-Record-ID", _identifier(F.col("place"))),
        field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-IP-Address", F.col("ip")),
        field("WARC-Page-ID", F.col("page_id")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), block_digest)),
        field("WARC-Profile", F.when(again, REVISIT)),
        field("WARC-Refers-To", F.when(again, _identifier(F.col("refers_place")))),
        field("WARC-Refers-To-Target-URI", F.col("refers_uri")),
        field("WARC-Refers-To-Date", F.col("refers_date")),
        field("WARC-Refers-To-Page-ID", F.when(again, F.col("refers_to"))),
        field("Content-Type", F.when(http, "application/http; msgtype=response").otherwise(F.col("mime"))),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(header.cast("binary"), block, F.lit("\r\n\r\n").cast("binary"))
    _write(rows.select(record.alias("record")), warc, file_bytes)


def read_back(spark: SparkSession, warc: str) -> DataFrame:
    """One row per record of the WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Digests of responses are computed again and must agree with the header.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column(1):
                    for f, block in read_warc(_opened(content.as_py())):
                        told = f["warc-payload-digest"].removeprefix("sha1:")
                        size = int(f["warc-payload-length"])
                        if f["warc-type"] != "revisit":
                            payload = _http(block)[1]
                            if (len(payload), digest(payload)) != (size, told):
                                raise ValueError(f"damaged record {f['warc-record-id']}")
                        yield f.get("warc-page-id"), size, told, f["warc-type"], f.get("warc-refers-to-page-id")

        yield from _batches(rows(), _schema(WARC_COLUMNS), lambda r: 100)

    return _files(spark, warc).mapInArrow(parse, WARC_COLUMNS)


def archived(pages: DataFrame, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """One row per page, read back from its WARC record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload and a null address is ``urn:none``.  Of repeated rows of
    one page one is the response and the others revisit it.  Records without a page_id keep
    none.  Other columns are ignored.  An empty table gives an empty result.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(pages, arc, file_bytes=file_bytes)
    convert(spark, arc, warc, least, file_bytes)
    rows = read_back(spark, warc)
    return rows.select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )
