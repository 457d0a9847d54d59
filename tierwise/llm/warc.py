"""Legacy web archives (ARC, versions 1 and 2) converted to WARC.

An ARC file names its version in its first record; that decides how many fields a record's header
line has.  The line's last field declares the length of what follows, which is read by that
length, whatever it contains.  A WARC record is synthesised from each: an identifier from the
file's name and the record's place, the timestamp in ISO form, the type, and the SHA-256 digest of
the payload.  Of equal payloads the one of the smallest page id is kept, the others become
``revisit`` records that refer to it.

Records are written once as a table; which of them are copies is found from their digests and ids
alone, and payloads that stay are not moved.  Every record is a gzip member of its own, so files can be
read record by record.  Archives and files are cut by their bytes: one of a larger record has only that.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import arrow_schema, batches_of, map_arrow, written
from tierwise.llm.membership import without_keys

#: Bytes after which an ARC archive and a WARC file (compressed) end, and from which a payload may be replaced by a revisit.
ARC_BYTES, WARC_BYTES, LEAST_REVISIT = 8 << 20, 32 << 20, 100
#: Bytes of a gzip file that are decompressed at a time.
PIECE = 1 << 14
# The formats' own words.
FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
FIELD_LINE = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# This library's own header field of a revisit: the bytes of the payload that it stands for.
PAYLOAD_LENGTH = "X-Payload-Length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
CRLF = b"\r\n"


# ---- ARC


def arc_line(version: int, values: dict[str, bytes]) -> bytes:
    return b" ".join(values.get(f, b"-") for f in FIELDS[version]) + b"\n"


def arc_start(name: str, version: int) -> bytes:
    """The record that names the version and the fields."""
    body = b"%d 0 tierwise\n%s\n" % (version, FIELD_LINE[version])
    values = {"url": b"filedesc://" + name.encode(), "ip": b"0.0.0.0", "date": b"20200101000000", "mime": b"text/plain"}
    return arc_line(version, values | {"status": b"200", "length": b"%d" % len(body)}) + body + b"\n"


def arc_record(version: int, url: bytes, date: bytes, mime: bytes, body: bytes) -> bytes:
    url = UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url) or b"-"
    values = {"url": url, "ip": b"0.0.0.0", "date": date, "mime": mime, "status": b"200", "length": b"%d" % len(body)}
    return arc_line(version, values) + body + b"\n"


def parse_arc(content: bytes, name: str = "") -> Iterator[tuple[int, dict[str, bytes], bytes]]:
    """(offset, header fields, body) of each record after the first one.

    A file without a version, a header line with too few fields and a length that is none or goes
    beyond the file are errors that name the place; nothing is skipped.
    """
    if not content:
        return
    first = content.split(b"\n", 2)
    if not first[0].startswith(b"filedesc://") or len(first) < 2 or first[1][:1] not in (b"1", b"2"):
        raise ValueError(f"{name}: no ARC version block")
    version, at = int(first[1][:1]), 0
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):  # between records
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].rstrip(b"\r")
        values = line.rsplit(b" ", len(FIELDS[version]) - 1)
        if end < 0 or len(values) != len(FIELDS[version]) or not values[-1].isdigit():
            raise ValueError(f"{name}: no ARC header line at {at}")
        length = int(values[-1])
        if end + 1 + length > len(content):
            raise ValueError(f"{name}: the record at {at} is cut off")
        if at:
            yield at, dict(zip(FIELDS[version], values, strict=True)), content[end + 1 : end + 1 + length]
        at = end + 1 + length


def pages_as_arc(pages: DataFrame) -> DataFrame:
    """(path, content): ``pages`` (page_id, url, html) as ARC archives of both versions in turn.

    A record is an HTTP response with the page's id in a header; its time is page_id seconds after
    2020 began (without an id, that moment).  A null html is empty, a null url a hyphen.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("-")).cast("binary").alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("html"),
        F.date_format(
            F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyyMMddHHmmss"
        )
        .cast("binary")
        .alias("date"),
    )
    arrow = arrow_schema("path string, content binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, records, size = TaskContext.get().partitionId(), 0, [], 0
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n"

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [name], "content": [b"".join(records)]}, schema=arrow)

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, date = (batch.column(c)[i].as_py() for c in range(4))
                if not records:
                    version, name = 1 + n % 2, f"pages-{task:06d}-{n:06d}.arc"
                    n += 1
                    records = [arc_start(name, version)]
                known = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
                records.append(arc_record(version, url, date, b"text/html", head % (known, len(html)) + html))
                size += len(records[-1])
                if size >= ARC_BYTES:
                    yield archive()
                    records, size = [], 0
        if records:
            yield archive()

    return map_arrow(rows, run, "path string, content binary")


# ---- conversion

RECORD = """path string, record_id string, record_type string, target_uri string, warc_date string, ip string,
    block_type string, page_id long, http_head binary, payload binary, payload_bytes long, payload_digest string"""


def http_parts(body: bytes) -> tuple[bytes, bytes]:
    """Head, with its empty line, and payload."""
    end = body.find(CRLF * 2)
    return (body, b"") if end < 0 else (body[: end + 4], body[end + 4 :])


def http_header(head: bytes, name: bytes) -> int | None:
    found = re.search(rb"\r\n%s: *([0-9-]+)\r\n" % name, head)
    return int(found[1]) if found else None


def converted(path: str, offset: int, fields: dict[str, bytes], body: bytes) -> dict:
    """The WARC record of one ARC record: HTTP responses are told from other resources by their body."""
    http = body.startswith(b"HTTP/")
    head, payload = http_parts(body) if http else (b"", body)
    text = {k: v.decode("utf-8", "replace") for k, v in fields.items()}
    date = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", text["date"].ljust(14, "0"))
    if not date:
        raise ValueError(f"{path}: no date in the header line at {offset}")
    return {
        "path": path,
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}",
        "record_type": "response" if http or text["url"].startswith("dns:") else "resource",
        "target_uri": text["url"],
        "warc_date": "{}-{}-{}T{}:{}:{}Z".format(*date.groups()),
        "ip": text["ip"],
        "block_type": "application/http; msgtype=response" if http else text["mime"],
        "page_id": http_header(head, b"X-Page-Id"),
        "http_head": head,
        "payload": payload,
        "payload_bytes": len(payload),
        "payload_digest": hashlib.sha256(payload).hexdigest(),
    }


def convert(archives: DataFrame) -> DataFrame:
    """The WARC records of ARC archives (path, content), as ``binaryFile`` reads them; gzipped ones too."""
    arrow = arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    path, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                    for found in parse_arc(b"".join(members(content)), path):
                        record = converted(path, *found)
                        yield *(record[name] for name in arrow.names), len(found[2]) + 1000

        yield from batches_of(rows(), arrow)

    return map_arrow(archives.select("path", "content"), run, RECORD)


def members(content: bytes) -> Iterator[bytes]:
    """The contents of a gzip file's members, one at a time; other content as it is."""
    view, at = memoryview(content), 0
    while view[at : at + 2] == b"\x1f\x8b":
        stream, parts = zlib.decompressobj(31), []
        while not stream.eof:
            piece = view[at : at + PIECE]
            if not piece:
                raise ValueError("a gzip member is cut off")
            parts.append(stream.decompress(piece))
            at += len(piece) - len(stream.unused_data)
        yield b"".join(parts)
    if rest := bytes(view[at:]).strip(b"\x00"):
        yield rest if at else content


def with_revisits(records: DataFrame, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """Responses of ``least_bytes`` or more whose payload another one has too become revisits of the one
    with the smallest page id (then record id; those without a page id come last), as ``first`` says; they have
    no payload any more.

    Only digests, ids and heads are joined; a payload of which one digest has very many copies is split by the
    join.  Of the records only copies, and the few that a filter cannot tell from them, are moved.
    """
    records = written(records, "records")
    narrow = records.drop("payload")
    entry = F.struct(
        F.col("page_id").isNull().alias("no_id"), "page_id", "record_id", "target_uri", F.col("warc_date").alias("date")
    )
    large = narrow.filter(F.col("payload_bytes") >= least_bytes).filter("record_type = 'response'")
    first = large.groupBy("payload_digest").agg(F.min(entry).alias("first"))
    copies = large.select("record_id", "payload_digest").distinct().join(first, "payload_digest")
    copies = written(copies.filter("first.record_id <> record_id").select("record_id", "first"), "copies")
    revisits = narrow.join(copies, "record_id").withColumns({"record_type": F.lit("revisit"), "payload": F.lit(None).cast("binary")})
    others = without_keys(records, F.col("record_id"), copies.select(F.col("record_id").alias("row_key")))
    return others.withColumn("first", F.lit(None).cast(copies.schema["first"].dataType)).unionByName(revisits)


def warc_record(row: dict) -> bytes:
    """A record of ``with_revisits`` with its header, block and end."""
    first = row["first"]
    block = row["http_head"] + (row["payload"] or b"")
    lines = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", row["warc_date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
    ]
    if first is not None:
        lines += [
            ("WARC-Refers-To", f"<{first['record_id']}>"),
            ("WARC-Refers-To-Target-URI", first["target_uri"]),
            ("WARC-Refers-To-Date", first["date"]),
            ("WARC-Profile", REVISIT_PROFILE),
            (PAYLOAD_LENGTH, row["payload_bytes"]),
        ]
        if first["page_id"] is not None:
            lines.append(("X-Refers-To-Page-Id", first["page_id"]))
    lines += [("Content-Type", row["block_type"]), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines)
    return b"WARC/1.1\r\n" + head.encode() + CRLF + block + CRLF * 2


def gzipped(record: bytes) -> bytes:
    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
    return stream.compress(record) + stream.flush()


def write_warc(records: DataFrame, path: str) -> None:
    """Write the records of ``with_revisits`` as WARC files below ``path``, a gzip member each.

    A file is one value of Spark's text writer, whose line separator is the file's last byte: the member that
    ends it is empty, so that is a zero.  A repeated task's files replace those of its first try, by Spark's
    commit.
    """
    arrow = arrow_schema("value binary")
    last = gzipped(b"")
    names = ["record_id", "record_type", "target_uri", "warc_date", "ip", "block_type", "http_head", "payload", "payload_bytes", "payload_digest", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i].as_py() for c, name in enumerate(names)}
                parts.append(gzipped(warc_record(row)))
                size += len(parts[-1])
                if size >= WARC_BYTES:
                    yield pa.RecordBatch.from_pydict({"value": [b"".join([*parts, last[:-1]])]}, schema=arrow)
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_pydict({"value": [b"".join([*parts, last[:-1]])]}, schema=arrow)

    files = map_arrow(records.select(*names), run, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


# ---- reading back

READ = """path string, record_id string, record_type string, target_uri string, warc_date string, page_id long,
    payload_bytes long, payload_digest string, refers_to_record string, refers_to long"""


def parse_warc(content: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by its declared length."""
    at = 0
    while at < len(content):
        end = content.find(CRLF * 2, at)
        lines = content[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no WARC record at {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        stop = end + 4 + int(fields["content-length"])
        if content[stop : stop + 4] != CRLF * 2:
            raise ValueError(f"{name}: the record at {at} has another length than it declares")
        yield fields, content[end + 4 : stop]
        at = stop + 4


def read_record(path: str, fields: dict[str, str], block: bytes) -> dict:
    """A record's row.  A payload must have the digest that the record declares; a revisit has none, and its
    length is what the conversion measured (null in other writers' revisits, which do not say it)."""
    http, kind = fields["content-type"].startswith("application/http"), fields["warc-type"]
    head, payload = http_parts(block) if http else (b"", block)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{path}: the payload of {fields['warc-record-id']} has another digest")
    refers, measured = fields.get("x-refers-to-page-id"), fields.get(PAYLOAD_LENGTH.lower())
    return {
        "path": path,
        "record_id": fields["warc-record-id"].strip("<>"),
        "record_type": kind,
        "target_uri": fields["warc-target-uri"],
        "warc_date": fields["warc-date"],
        "page_id": http_header(head, b"X-Page-Id"),
        "payload_bytes": len(payload) if kind != "revisit" else int(measured) if measured else None,
        "payload_digest": digest,
        "refers_to_record": fields.get("warc-refers-to", "").strip("<>") or None,
        "refers_to": int(refers) if refers else None,
    }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the WARC files below ``path``."""
    arrow = arrow_schema(READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    name = batch.column(0)[i].as_py()
                    for member in members(batch.column(1)[i].as_py()):
                        for found in parse_warc(member, name):
                            record = read_record(name, *found)
                            yield *(record[c] for c in arrow.names), 1000

        yield from batches_of(rows(), arrow)

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    return map_arrow(files, run, READ)
