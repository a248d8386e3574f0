"""Legacy ARC archives, and their conversion to WARC.

Archives are real files in any folder that Spark can reach: the text writer ends every record with the
format's own separator, and whole files come back through the binary reader and are cut by declared lengths.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import fresh_path, saved

#: Least bytes of a payload that others may revisit.
LEAST_REVISIT = 1000

# Fixed values of the formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CAPTURE_DATE = "20240101000000"

RECORD = "page_id long, url string, ip string, warc_date string, content_type string, head binary, payload binary, payload_digest string, payload_bytes long, record_id string"


# -- one archive in memory: small helpers of the tasks ---------------------------------------------


def arc_opening(version: int, name: str) -> bytes:
    """The version block that opens an archive."""
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n"
    middle = f"{CAPTURE_DATE} text/plain" + (f" 200 - - 0 {name}" if version == 2 else "")
    return f"filedesc://{name} 0.0.0.0 {middle} {len(body)}\n{body}".encode()


def arc_record(version: int, name: str, page_id, url: str | None, html: str | None) -> bytes:
    """One document: its header line, then the network response with declared length."""
    payload = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    if page_id is not None:
        head += f"X-Page-Id: {page_id}\r\n"
    block = head.encode() + b"\r\n" + payload
    place = "".join(c if not c.isspace() else f"%{ord(c):02X}" for c in url or "urn:unknown") or "urn:unknown"
    more = f" 200 {hashlib.sha1(payload).hexdigest()} - 0 {name}" if version == 2 else ""
    return f"{place} 0.0.0.0 {CAPTURE_DATE} text/html{more} {len(block)}\n".encode() + block


def arc_records(data: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, network response) of every document after the version block."""
    version = None
    while line := data.readline():
        line = line.decode("utf-8").rstrip("\r\n")
        if not line:
            continue
        length = int(line.rsplit(" ", 1)[1])
        block = data.read(length)
        if len(block) < length:
            raise ValueError(f"an archive ends {length - len(block)} bytes early")
        if version is None:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            continue
        names = ARC_FIELDS[version]
        parts = line.rsplit(" ", len(names) - 1)
        if len(parts) < len(names):
            raise ValueError(f"a header line has {len(parts)} of {len(names)} fields")
        yield dict(zip(names, parts)), block


def http_parts(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head with its blank line, payload, and header fields by lower-case name."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return head + b"\r\n\r\n", payload, fields


def warc_date(stamp: str) -> str:
    """YYYYMMDDhhmmss as ISO 8601; shorter stamps of old archives are filled up."""
    s = (stamp + "00000101000000"[len(stamp) :])[:14] if len(stamp) < 14 else stamp[:14]
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def sha1_name(digest_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Header and block; the writer adds the two line ends that close a record."""
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def warc_records(data: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of every record."""
    while line := data.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:20]!r}")
        fields = {}
        while (line := data.readline().decode("utf-8").rstrip("\r\n")):
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        block = data.read(int(fields["content-length"]))
        if data.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


# -- jobs --------------------------------------------------------------------------------------------


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content", F.element_at(F.split("path", "/"), -1).alias("name"))


def _inflated(content: pa.Scalar) -> BinaryIO:
    """An archive as a stream, so that a task holds one record of it at a time."""
    data = pa.BufferReader(content.as_buffer())
    return gzip.GzipFile(fileobj=data) if content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b" else data


def _write(records: DataFrame, path: str, end: str) -> None:
    # deflate level 4: a third of the time of the default for 4 % more bytes
    rows = records.select(F.col("record").cast("string"))
    rows.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "FOUR").text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    """A folder of .gz ARC archives, versions 1 and 2 in turn, one for each partition that is read."""
    rows = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        version, name = 1 + number % 2, f"part-{number:05d}.arc"
        opened = False
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = [arc_record(version, name, *row) for row in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(([] if opened else [arc_opening(version, name)]) + out, pa.binary())], ["record"])
                opened = True

    _write(rows.mapInArrow(run, "record binary"), path, "\n")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a folder of ARC archives as RECORD, with the identifiers that WARC asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [pa.int64() if c.endswith(" long") else pa.binary() if c.endswith(" binary") else pa.string() for c in RECORD.split(", ")]
        for batch in batches:
            for content, archive in zip(batch.column(0), batch.column(1).to_pylist()):
                rows = []
                for number, (fields, block) in enumerate(arc_records(_inflated(content))):
                    head, payload, http = http_parts(block)
                    digest = hashlib.sha1(payload).hexdigest()
                    page = http.get("x-page-id")
                    # its place is part of a record's name, so repeated pages have records of their own
                    name = hashlib.sha1(f"{archive} {number} {fields['URL']} {fields['Archive-date']} {page} {digest}".encode()).digest()
                    row = (int(page) if page else None, fields["URL"], fields["IP-address"], warc_date(fields["Archive-date"]), fields["Content-type"])
                    rows.append((*row, head, payload, digest, len(payload), f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return _archives(spark, path).mapInArrow(run, RECORD)


def write_warc(records: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """A folder of .gz WARC archives, one for each partition of the only exchange of payloads, which is by digest.

    Of equal payloads of ``least`` bytes or more only the one with the largest page_id is stored whole.  Smaller
    ones are dealt by their record, so that however many are equal they don't meet; what is kept of large
    ones is stored first, so that the join stands alone and the rows of a hot payload can be split.
    """
    records = records.withColumn("_deal", F.when(F.col("payload_bytes") >= least, F.col("payload_digest")).otherwise(F.col("record_id")))
    large = records.where(F.col("payload_bytes") >= least)
    kept = large.groupBy("_deal").agg(F.max(F.struct("page_id", "record_id")).alias("_keep"), F.count("*").alias("_n"))
    kept = saved(kept.where("_n > 1").drop("_n"), "warc-kept")
    rows = records.join(kept.hint("merge"), "_deal", "left")
    later = (F.col("payload_bytes") >= least) & F.col("_keep").isNotNull() & F.coalesce(F.col("page_id") < F.col("_keep.page_id"), F.col("_keep.page_id").isNotNull())
    rows = rows.select("*", F.when(later, F.col("_keep.record_id")).alias("refers_to")).drop("_keep")
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    rows = rows.select("url", "ip", "warc_date", "content_type", "head", "payload", "payload_digest", "payload_bytes", "record_id", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, opened = TaskContext.get().partitionId(), False
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                if not opened:
                    about = b"software: ARC converter\r\nformat: WARC File Format 1.0\r\n"
                    fields = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'warcinfo {number}')}>"), ("WARC-Date", warc_date(CAPTURE_DATE)), ("Content-Type", "application/warc-fields")]
                    out.append(warc_record("warcinfo", fields, about))
                    opened = True
                for r in batch.slice(lo, 256).to_pylist():
                    fields = [("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["warc_date"]), ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"])]
                    fields += [("WARC-Payload-Digest", sha1_name(r["payload_digest"])), ("Content-Type", "application/http; msgtype=response")]
                    if r["refers_to"]:
                        fields += [("WARC-Refers-To", r["refers_to"]), ("WARC-Profile", REVISIT_PROFILE)]
                    block = r["head"] + (b"" if r["refers_to"] else r["payload"])
                    fields.append(("WARC-Block-Digest", sha1_name(hashlib.sha1(block).hexdigest())))
                    out.append(warc_record("revisit" if r["refers_to"] else "response", fields, block))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    _write(rows.mapInArrow(run, "record binary"), path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, record_id, refers_id of all response and revisit records.

    Digest and length of a stored payload are computed from its bytes and must equal the record's own;
    those of a revisit come from its headers.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, record_id string, refers_id string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [pa.int64() if c.endswith(" long") else pa.string() for c in schema.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in warc_records(_inflated(content)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    _, payload, http = http_parts(block)
                    digest, length = base64.b32decode(fields["warc-payload-digest"].split(":", 1)[1]).hex(), int(http["content-length"])
                    if kind == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
                        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest and length")
                    page = http.get("x-page-id")
                    rows.append((int(page) if page else None, fields["warc-target-uri"], length, digest, kind, fields["warc-record-id"], fields.get("warc-refers-to")))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return _archives(spark, path).mapInArrow(run, schema)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT) -> None:
    """ARC archives to WARC archives."""
    write_warc(read_arc(spark, arc_path), warc_path, least)


def archive_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages as ARC, converted to WARC, read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload; a null or blank url is stored as urn:unknown, white space in it
    percent-encoded; a null page_id comes back as null and never is the response of others that have
    one.  Rows with the same payload and the same largest page_id are all responses, so repeated rows
    don't revisit each other.  Other columns are not looked at; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    arc, out = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, out, least)
    index = saved(read_warc(spark, out), "warc-index")
    stored = index.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_id")).agg(F.max("page_id").alias("refers_to"))
    whole = index.where("refers_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    again = index.where("refers_id is not null").join(stored, "refers_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.select(columns).unionByName(again.select(columns))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, lower(sha1(h)) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS keep FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keep IS NOT NULL AND keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM d LEFT JOIN k USING (payload_digest)
"""
