"""Legacy web archives: writing and reading ARC, converting it to WARC, writing and reading that.

An ARC file opens with a version block that says which fields the header lines have; each record is a
header line, which ends with the declared length, and that many bytes. The converter makes the
WARC record that says the same: identifier, timestamp, type and digests are synthesised from the
record alone, so a rerun gives the same. Repeated payloads become revisit records.

Files are written by Spark's text sink, one value per record, and read by its binary source, so any
store that Spark reaches will do.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType

from clickloom.llm.common import partitions
from clickloom.operators.skew import heavy_keys, salted_join
from clickloom.shared import materialize, shared_folder

# Bytes after which a file is full, before compression (a longer record has a file of its own); payload bytes passed
# on at once in a task.
FILE_BYTES = 32_000_000
BATCH_BYTES = 8_000_000
# Payloads below this many bytes are stored each time.
REVISIT_BYTES = 1_000

# The fields of header lines by version, and the profile of revisit records.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_VERSION = b"WARC/1.1"

_EPOCH = "1970-01-01T00:00:00Z"


def _as_text(value) -> str:
    return re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", value) if value else "-"


# ARC


def arc_record(version: int, url: str, ip: str, date: str, kind: str, block: bytes, offset: int = 0, file: str = "-") -> bytes:
    """Header line and block. White space in the url is percent-encoded; missing fields are ``-``."""
    fields = [_as_text(url), ip, date, _as_text(kind)]
    if version == 2:
        fields += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), file]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 clickloom\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(1, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body)


def http_response(payload: bytes, key: int | None, kind: str = "text/html; charset=utf-8") -> bytes:
    """A response with the payload; ``X-Record-Key`` carries the row's key."""
    lines = ["HTTP/1.1 200 OK", f"Content-Type: {kind}", f"Content-Length: {len(payload)}"]
    lines += [f"X-Record-Key: {key}"] if key is not None else []
    return "\r\n".join([*lines, "", ""]).encode() + payload


def _write(values: DataFrame, path: str, separator: str) -> None:
    """Each value as a file, and ``separator`` after it."""
    out = values.select(F.col("value").cast("string")).write
    out = out.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    out.option("maxRecordsPerFile", 1).option("lineSep", separator).text(path)


VALUE = StructType().add("value", BinaryType())


def _in_files(records: Iterable[bytes], head: Callable[[int], bytes], separator: bytes, most: int) -> Iterator[pa.RecordBatch]:
    """The contents of a task's files: ``head(i)`` and records, as many as ``most`` bytes hold, or one."""
    held: list[bytes] = []
    size = i = 0

    def file() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([separator.join([head(i), *held])], pa.binary())], names=["value"])

    for record in records:
        if held and size + len(record) > most:
            yield file()
            held, size, i = [], 0, i + 1
        held.append(record)
        size += len(record)
    if held:
        yield file()


def write_arc(
    pages: DataFrame,
    path: str,
    version: int = 2,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "20240101000000",
    file_bytes: int = FILE_BYTES,
) -> None:
    """One ARC record per row, its payload the ``html`` in UTF-8 (null: empty) as an HTTP response.
    A null url is ``-``. Tasks write what they read; an empty table writes no record."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for k, u, h in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    block = http_response((h or "").encode("utf-8", "surrogatepass"), k)
                    yield arc_record(version, u, "0.0.0.0", date, "text/html", block)

        yield from _in_files(records(), lambda i: arc_version_block(version, f"part-{i}.arc", date), b"\n", file_bytes)

    source = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
    _write(source.mapInArrow(run, VALUE), path, "\n")


class _Unpacked(io.RawIOBase):
    """A gzip file that ends where it is cut off or damaged."""

    def __init__(self, content: bytes) -> None:
        self.file = gzip.GzipFile(fileobj=io.BytesIO(content))

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            part = self.file.read1(len(buffer))
        except (EOFError, OSError, zlib.error):
            return 0
        buffer[: len(part)] = part
        return len(part)


def _opened(content: bytes) -> io.BufferedIOBase:
    return io.BufferedReader(_Unpacked(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def parse_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an ARC file, the version block among them (url ``filedesc://...``).

    Each has the fields of its header line in lower case, ``offset`` (of the header line) and ``block``, which is
    shorter than declared if the file ends early (``truncated``). A url with blanks is
    read from the right. A line that is no header (damage, padding) is skipped.
    """
    names = ARC_FIELDS[1].lower().split()
    at = 0
    while line := stream.readline():
        here, at = at, at + len(line)
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        is_head = text.startswith("filedesc://")
        own = ARC_FIELDS[1].lower().split() if is_head else names
        parts = text.rsplit(" ", len(own) - 1)
        if len(parts) != len(own) or not parts[-1].isdecimal():
            continue
        block = stream.read(int(parts[-1]))
        at += len(block)
        if is_head:
            lines = block.decode("utf-8", "replace").split("\n")
            declared = lines[1].lower().split() if len(lines) > 1 else []
            version = lines[0].split(" ")[0]
            names = declared or ARC_FIELDS.get(int(version) if version.isdecimal() else 1, ARC_FIELDS[1]).lower().split()
        yield dict(zip(own, parts)) | {"offset_in_file": here, "block": block, "truncated": len(block) < int(parts[-1])}


# The converter


def warc_date(date: str, other: str = _EPOCH) -> str:
    """An ARC date (up to 14 digits, from the year on) as ISO 8601; ``other`` if it is none."""
    try:
        full = (date + "00000101000000"[len(date) :]) if len(date) >= 4 else ""
        return datetime.strptime(full[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return other


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header lines with the first empty line after them, and payload."""
    found = [(at, len(end)) for end in (b"\r\n\r\n", b"\n\n") if (at := block.find(end)) >= 0]
    cut = sum(min(found)) if found else len(block)
    return block[:cut], block[cut:]


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


RECORD = (
    StructType()
    .add("key", LongType())
    .add("record_type", StringType())
    .add("record_id", StringType())
    .add("target_uri", StringType())
    .add("date", StringType())
    .add("ip", StringType())
    .add("content_type", StringType())
    .add("payload_digest", StringType())
    .add("payload_bytes", LongType())
    .add("truncated", BooleanType())
    .add("head", BinaryType())
    .add("payload", BinaryType())
)


def convert(record: dict, file: str, file_date: str = _EPOCH) -> dict:
    """The WARC record that says what an ARC record says, as ``RECORD``.

    The version block becomes ``warcinfo``, an HTTP response ``response``, all else ``resource``. The
    identifier is a name-based UUID of file, offset, url, date and block digest. A field that the version
    block does not declare is missing: no address or type, ``-`` as url, the date of the file.
    """
    block, url, date = record["block"], record.get("url", "-"), record.get("archive-date", "")
    digest = hashlib.sha1(block).hexdigest()
    kind = "warcinfo" if url.startswith("filedesc://") else "response" if block.startswith(b"HTTP/") else "resource"
    head, payload = split_http(block) if kind == "response" else (b"", block)
    key = http_field(head, "X-Record-Key") if kind == "response" else None
    name = f"{file} {record['offset_in_file']} {url} {date} {digest}"
    return {
        "key": int(key) if key and re.fullmatch(r"-?\d+", key) else None,
        "record_type": kind,
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
        "target_uri": url,
        "date": warc_date(date, file_date),
        "ip": record.get("ip-address"),
        "content_type": "application/http; msgtype=response" if kind == "response" else record.get("content-type"),
        "payload_digest": hashlib.sha1(payload).hexdigest(),
        "payload_bytes": len(payload),
        "truncated": record["truncated"],
        "head": head,
        "payload": payload,
    }


def _batched(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + len(row["payload"] or b"")
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the ARC files below ``path``, converted (``RECORD``). A file is read by one
    task, record by record; plain and gzip files may be mixed."""
    schema = to_arrow_schema(RECORD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    dated = _EPOCH
                    for record in parse_arc(_opened(content)):
                        made = convert(record, file.rsplit("/", 1)[-1], dated)
                        dated = made["date"] if made["record_type"] == "warcinfo" else dated
                        yield made

        yield from _batched(rows(), schema)

    return _files(spark, path).mapInArrow(run, RECORD)


def mark_revisits(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``records`` with ``first_id, first_key, first_uri, first_date``: of responses with one payload of at least
    ``least`` bytes, the one with the largest key (ties: the largest identifier), for all of
    them but itself; null elsewhere.

    Payloads are joined by digest with the few that repeat; a payload that holds many rows is spread.
    """
    wide = records.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= least))
    best = F.max(F.struct(F.coalesce("key", F.lit(-(2**63))).alias("order"), "record_id", "key", "target_uri", "date"))
    groups = wide.groupBy("payload_digest").agg(best.alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    groups = groups.select(
        "payload_digest", "n", F.col("first.record_id").alias("first_id"), F.col("first.key").alias("first_key"),
        F.col("first.target_uri").alias("first_uri"), F.col("first.date").alias("first_date"),
    )
    groups = materialize(groups, "warc-repeated")
    hot = heavy_keys(groups, "payload_digest", F.col("n"), 16 * partitions(records.sparkSession))
    marked = salted_join(records, groups.drop("n"), "payload_digest", "left", hot, ["record_id"])
    again = (F.col("record_type") == "response") & (F.col("payload_bytes") >= least) & (F.col("first_id") != F.col("record_id"))
    for name in ("first_key", "first_uri", "first_date", "first_id"):
        marked = marked.withColumn(name, F.when(again, F.col(name)))
    return marked


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def warc_record(row: dict) -> bytes:
    """Version, named fields, empty line and block; a revisit keeps the HTTP header lines only."""
    again = row["first_id"] is not None
    block = row["head"] + (b"" if again else row["payload"])
    fields = {
        "WARC-Type": "revisit" if again else row["record_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": row["date"],
        "WARC-Target-URI": None if row["record_type"] == "warcinfo" else row["target_uri"],
        "WARC-Filename": row["target_uri"].removeprefix("filedesc://") if row["record_type"] == "warcinfo" else None,
        "WARC-IP-Address": None if row["record_type"] == "warcinfo" else row["ip"],
        "WARC-Block-Digest": _base32(hashlib.sha1(block).hexdigest()),
        "WARC-Payload-Digest": _base32(row["payload_digest"]),
        "WARC-Truncated": "length" if row["truncated"] else None,
        "WARC-Profile": REVISIT_PROFILE if again else None,
        "WARC-Refers-To": f"<{row['first_id']}>" if again else None,
        "WARC-Refers-To-Target-URI": row["first_uri"] if again else None,
        "WARC-Refers-To-Date": row["first_date"] if again else None,
        "X-Refers-To-Key": row["first_key"] if again else None,
        "Content-Type": row["content_type"],
        "Content-Length": len(block),
    }
    lines = [f"{name}: {value}".encode("utf-8", "surrogatepass") for name, value in fields.items() if value is not None]
    return b"\r\n".join([WARC_VERSION, *lines, b"", block])


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """The records that ``mark_revisits`` made, as WARC files that open with a ``warcinfo`` record.
    The version blocks of the ARC files are not written again."""
    names = records.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[bytes]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield warc_record(dict(zip(names, row.values())))

        def head(i: int) -> bytes:
            body = b"software: clickloom\r\nformat: WARC File Format 1.1\r\n"
            name = f"part-{i}.warc"
            info = {
                "record_type": "warcinfo",
                "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
                "date": _EPOCH,
                "target_uri": name,
                "ip": None,
                "content_type": "application/warc-fields",
                "payload_digest": hashlib.sha1(body).hexdigest(),
                "truncated": False,
                "first_id": None,
                "head": b"",
                "payload": body,
            }
            return warc_record(info)

        yield from _in_files(rows(), head, b"\r\n\r\n", file_bytes)

    _write(records.where(F.col("record_type") != "warcinfo").mapInArrow(run, VALUE), path, "\r\n\r\n")


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields in lower case, block)`` of each record; lines between records are skipped, and so
    are records whose length is no number."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        if (length := fields.get("content-length", "0")).isdecimal():
            yield fields, stream.read(int(length))


READ = (
    StructType()
    .add("record_type", StringType())
    .add("record_id", StringType())
    .add("target_uri", StringType())
    .add("date", StringType())
    .add("content_type", StringType())
    .add("key", LongType())
    .add("payload_digest", StringType())
    .add("payload_bytes", LongType())
    .add("refers_to_id", StringType())
    .add("refers_to_key", LongType())
    .add("payload", BinaryType())
)


def _whole(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _read_row(fields: dict[str, str], block: bytes) -> dict:
    kind = fields.get("warc-type")
    is_http = fields.get("content-type", "").startswith("application/http")
    head, payload = split_http(block) if is_http else (b"", block)
    revisit = kind == "revisit"
    digest = fields.get("warc-payload-digest", "")
    stated = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
    own = (lambda name: fields.get(name, "").strip("<>") or None)
    return {
        "record_type": kind,
        "record_id": own("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "content_type": fields.get("content-type"),
        "key": _whole(http_field(head, "X-Record-Key")),
        "payload_digest": stated if revisit else hashlib.sha1(payload).hexdigest(),
        "payload_bytes": _whole(http_field(head, "Content-Length")) if revisit else len(payload),
        "refers_to_id": own("warc-refers-to"),
        "refers_to_key": _whole(fields.get("x-refers-to-key")),
        "payload": None if revisit else payload,
    }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files below ``path`` (``READ``). Digest and length are made of the bytes
    read; those of a revisit, which has no payload, are the stated ones of the full payload."""
    schema = to_arrow_schema(READ)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (_read_row(*r) for b in batches for content in b.column(1).to_pylist() for r in parse_warc(_opened(content)))
        yield from _batched(rows, schema)

    return _files(spark, path).mapInArrow(run, READ)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages as legacy ARC files, convert these to WARC files, and read them back (``READ``).

    One record per row: null html is an empty payload, null url ``-``, a null key stays null (and is
    below all keys), repeated rows are records of their own. An empty table gives no record. Files go to the
    shared folder.
    """
    spark = pages.sparkSession
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(pages, arc, key=key, url=url, html=html)
    write_warc(mark_revisits(read_arc(spark, arc)), warc)
    return read_warc(spark, warc).where(F.col("record_type") != "warcinfo")
