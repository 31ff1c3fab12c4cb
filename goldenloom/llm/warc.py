"""WARC (7): archives written by Spark's text writer, and a salvage reader.

Writing is a projection: each record is one string, and the writer's line separator is the two line ends
that close a record, so archives are committed as any Spark output and work on any file system. The
reader checks each record (version line, header, length, closing line ends, payload digest). After a
failed check it searches for the next valid version line or gzip member, goes on there, and logs the
bytes between as a quarantined gap."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.llm.common import new_path, table

RECORD = "urn:page:"
NO_ID = "<urn:no-page>"
#: The reader holds one archive at a time. Payloads of up to SMALL bytes go 4,000 to an archive, which is 256 MB at
#: most; larger ones go into archives of their own, as few to each as keep it at that, one at least.
SMALL, RECORDS_PER_ARCHIVE = 1 << 16, 4000
ARCHIVE_BYTES = SMALL * RECORDS_PER_ARCHIVE
DATE = "2024-01-01T00:00:00Z"
PIECE = 1 << 16
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, by five groups of 40 bits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_originals(pages: DataFrame, id_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """pages(id, url, payload, digest, bytes, refers_to): refers_to is the smallest id of equal payloads of
    at least min_bytes, null for that page itself and for payloads of which there is one."""
    base = pages.select(F.col(id_col).alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    base = base.withColumn("digest", base32_sha1(F.encode("payload", "utf-8"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    shared = base.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return base.join(table(shared, "shared-payloads"), ["digest", "bytes"], "left").withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record_text(crlf: str = "\r\n") -> Column:
    """The record of a row of with_originals(), without the line ends that close it."""
    lines = lambda *c: F.concat_ws(crlf, *c)  # noqa: E731  nulls are left out
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    revisit = F.col("refers_to").isNotNull()
    http = lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")))
    block = F.concat(http, F.lit(crlf * 2), F.when(revisit, "").otherwise(F.col("payload")))
    # Any id fits into a header line: as in a url. A null one has a name of its own.
    name = lambda c: F.coalesce(F.concat(F.lit(f"<{RECORD}"), F.url_encode(F.col(c).cast("string")), F.lit(">")), F.lit(NO_ID))
    head = lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")), F.concat(F.lit("WARC-Record-ID: "), name("id")),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), clean),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("refers_to"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")), F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(crlf * 2), block)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> None:
    """Archives of the pages in the folder `path`: the page with the smallest id of equal payloads is a
    response, the others revisit it; payloads under min_bytes are all responses.

    A null payload is empty; a null url is an empty target; rows equal in id and payload are all
    responses; a null id revisits, unless all its equals have none. Other columns are ignored."""
    rows = with_originals(pages, id_col, html_col, min_bytes)

    def write(some: DataFrame, records: int, mode: str = "error") -> None:
        some.select(record_text().alias("value")).write.mode(mode).option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records).text(path)

    longest = pages.agg(F.max(F.octet_length(F.col(html_col).cast("string")))).first()[0] or 0
    if longest <= SMALL:
        write(rows, RECORDS_PER_ARCHIVE)
        return
    write(rows.where(F.col("bytes") <= SMALL), RECORDS_PER_ARCHIVE)
    write(rows.where(F.col("bytes") > SMALL), max(1, ARCHIVE_BYTES // longest), "append")


def parse_record(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int]:
    """Header, block and end of the valid record at `at`; ValueError if there is none."""
    end = data.find(b"\r\n\r\n", at)
    if not data.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n"), at) or end < 0:
        raise ValueError("no version line or header")
    pairs = [line.partition(b":") for line in data[at:end].split(b"\r\n")[1:]]
    header = {k.strip().lower(): v.strip() for k, _, v in pairs}
    if not header.get(b"content-length", b"").isdigit():
        raise ValueError("no length")
    start = end + 4
    stop = start + int(header[b"content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("the record doesn't end where it should")
    block = data[start:stop]
    digest = header.get(b"warc-payload-digest", b"")
    if header.get(b"warc-type") == b"response" and digest.startswith(b"sha1:"):
        if base64.b32encode(hashlib.sha1(block.partition(b"\r\n\r\n")[2]).digest()) != digest[5:]:
            raise ValueError("the payload's digest differs")
    return header, block, stop + 4


def parse_member(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int]:
    """As parse_record(), for a gzip member that holds one record."""
    unzip, view, parts, end = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not unzip.eof and end < len(data):  # pieces, so that no member copies what comes after it
            parts.append(unzip.decompress(view[end : end + PIECE]))
            end = min(len(data), end + PIECE)
    except zlib.error as e:
        raise ValueError(str(e)) from None
    if not unzip.eof:
        raise ValueError("the member is cut off")
    plain = b"".join(parts)
    header, block, stop = parse_record(plain, 0)
    if stop != len(plain):
        raise ValueError("the member holds more than a record")
    return header, block, end - len(unzip.unused_data)


def records(data: bytes) -> Iterator[tuple[int, int, dict[bytes, bytes] | None, bytes]]:
    """(start, end, header, block) of the archive's valid records, in order; header None: a gap."""
    at, gap = 0, None
    while at < len(data):
        parse = parse_member if data.startswith(b"\x1f\x8b", at) else parse_record
        try:
            header, block, end = parse(data, at)
        except ValueError:
            gap = at if gap is None else gap
            found = _START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield gap, at, None, b""
            gap = None
        yield at, end, header, block
        at = end
    if gap is not None:
        yield gap, len(data), None, b""


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record or gap of the archives under `path`: archive, start, end, kind (record or gap), type,
    record_id, target_uri, payload_bytes, payload_digest, refers_to, payload (string; null if not asked
    for, for revisits and for gaps). payload_bytes and payload_digest are those of the full payload."""
    schema = "archive string, start long, end long, kind string, type string, record_id string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload string"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if x.endswith(" long") else pa.string() for x in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                rows = []
                for start, end, header, block in records(content.as_py()):
                    if header is None:
                        rows.append((name.as_py(), start, end, "gap", *[None] * 7))
                        continue
                    text = lambda key: header[key].decode("utf-8", "replace") if key in header else None  # noqa: B023, E731
                    http, _, payload = block.partition(b"\r\n\r\n")
                    told = re.search(rb"(?i)\r\nContent-Length: *(\d+)", http)
                    response = header.get(b"warc-type") == b"response"
                    rows.append((
                        name.as_py(), start, end, "record", text(b"warc-type"), text(b"warc-record-id"), text(b"warc-target-uri"),
                        len(payload) if response else int(told[1]) if told else None, (text(b"warc-payload-digest") or "").removeprefix("sha1:") or None,
                        text(b"warc-refers-to"), payload.decode("utf-8", "replace") if payloads and response else None))
                columns = zip(*rows) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, schema)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads these back, and returns per page: id,
    payload_bytes, payload_digest, record_type, refers_to.

    Every page comes back, or the query fails: a gap in an archive just written is an error. Ids may hold any
    characters, be empty or null. Null payloads are empty; repeated rows give repeated rows; an empty table gives an
    empty one; other columns are ignored."""
    spark, kind = pages.sparkSession, dict(pages.dtypes)[id_col]
    path = new_path(spark, "warc")
    write_warc(pages, path, id_col, html_col, min_bytes)
    page = lambda c: F.when(F.col(c).startswith(f"<{RECORD}"), F.url_decode(F.regexp_extract(c, f"^<{RECORD}(.*)>$", 1))).cast(kind)
    whole = F.when(F.col("kind") == "gap", F.raise_error(F.concat(F.lit("bytes can't be read in "), "archive"))).otherwise(F.lit(True))
    return read_warc(spark, path, payloads=False).where(whole).select(
        page("record_id").alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
