"""WARC: archives in the older ARC format are parsed by their version's header lines and declared
lengths, and written anew as WARC records with equivalent identifiers, dates, types and digests."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Header fields of the two versions, in order.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which an archive ends and the next begins.
ARCHIVE_BYTES = 4 << 20
_END = b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def stored_url(url: str | None) -> str:
    """The URL as a header line holds it: white space would end the field, and "-" says that there is none."""
    found = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url or "")
    return "" if found == "-" else found


def record_id(page_id: object, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


# ARC


def arc_head(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 archive\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain", "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name, "Archive-length": str(len(body))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(url: str, block: bytes, version: int, date: str, name: str, offset: int, mime: str = "text/html", ip: str = "0.0.0.0") -> bytes:
    values = {
        "URL": stored_url(url) or "-", "IP-address": ip, "Archive-date": date, "Content-type": mime, "Result-code": "200",
        "Checksum": hashlib.md5(block).hexdigest(), "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(block)),
    }
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + block + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an archive: header fields by name, and block. The version block at its start says
    how many fields a header line has. Raises ValueError where lengths and lines don't agree."""
    at, fields = 0, None
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"header line at {at} has no end")
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        if not line:
            at = stop + 1
            continue
        if fields is None:
            size = int(line.rsplit(" ", 1)[1])
            version = int(data[stop + 1 : stop + 1 + size].split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"version {version} is unknown")
            fields = ARC_FIELDS[version]
        else:
            values = line.rsplit(" ", len(fields) - 1)
            if len(values) != len(fields):
                raise ValueError(f"header line at {at} has {len(values)} of {len(fields)} fields")
            header = dict(zip(fields, values, strict=True))
            if not re.fullmatch(r"\d{14}", header["Archive-date"]):
                raise ValueError(f"header line at {at} has no date where one belongs")
            size = int(header["Archive-length"])
            if stop + 1 + size > len(data):
                raise ValueError(f"record at {at} is cut short")
            yield header | {"block": data[stop + 1 : stop + 1 + size]}
        at = stop + 1 + size


def http_block(page_id: object, payload: bytes) -> bytes:
    owner = b"" if page_id is None else f"X-Page-Id: {page_id}\r\n".encode()
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + owner + f"Content-Length: {len(payload)}".encode() + _END + payload


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields in lower case, the header's bytes, the payload."""
    head, _, payload = block.partition(_END)
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
    return fields, head + _END, payload


def _segments(parts: Iterable[bytes], head: bytes, most: int) -> Iterator[bytes]:
    held, size = [head], 0
    for p in parts:
        held.append(p)
        size += len(p)
        if size >= most:
            yield b"".join(held)
            held, size = [head], 0
    if len(held) > 1:
        yield b"".join(held)


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: int = 2, date: str = "20260101000000", most: int = ARCHIVE_BYTES) -> DataFrame:
    """data: legacy archives of the pages, a row an archive of about most bytes. Null html is empty."""
    name = "pages.arc"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            at = 0
            for batch in batches:
                for page, url, html in zip(*batch.columns, strict=True):
                    made = arc_record(url.as_py() or "", http_block(page.as_py(), html.as_py() or b""), version, date, name, at)
                    at += len(made)
                    yield made

        for data in _segments(records(), arc_head(name, version, date), most):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return pages.select(id_col, url_col, F.col(html_col).cast("binary")).mapInArrow(write, "data binary")


def arc_records(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """id, uri, date, ip, head, payload, digest of every record of the archives in column data."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for r in parse_arc(data.as_py()):
                    fields, head, payload = http_parts(r["block"])
                    d = r["Archive-date"]
                    rows.append((fields.get("x-page-id"), "" if r["URL"] == "-" else r["URL"], f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", r["IP-address"], head, payload, sha1_base32(payload)))
                kinds = [pa.string()] * 4 + [pa.binary()] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["id", "uri", "date", "ip", "head", "payload", "digest"])

    found = archives.select("data").mapInArrow(read, "id string, uri string, date string, ip string, head binary, payload binary, digest string")
    return found.withColumn("id", F.col("id").cast(id_type))


# WARC


def warc_record(kind: str, ident: str, date: str, uri: str, block: bytes, fields: dict[str, str] | None = None, mime: str = "application/http; msgtype=response") -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": ident, "WARC-Date": date, "WARC-Target-URI": uri, **(fields or {}), "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Type": mime, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + _END


def _member(data: bytes) -> bytes:
    """A gzip member of its own, as archives hold each record."""
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and block of each record of a gzip archive; checks lengths and digests."""
    while data:
        z = zlib.decompressobj(31)
        raw = z.decompress(data) + z.flush()
        data = z.unused_data
        head, _, rest = raw.partition(_END)
        lines = head.decode().split("\r\n")
        fields = dict((k.lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]))
        size = int(fields["content-length"])
        block = rest[:size]
        if lines[0] != "WARC/1.1" or rest[size:] != _END:
            raise ValueError(f"record {fields.get('warc-record-id')} doesn't end where it declares")
        if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"record {fields.get('warc-record-id')} fails its digest")
        yield fields, block


def to_warc(records: DataFrame, most: int = ARCHIVE_BYTES) -> DataFrame:
    """data: WARC archives, a row an archive. records: arc_records() with first_id and first_uri, the page
    whose record holds this payload; a record of another page is a revisit of it."""
    info = _member(warc_record("warcinfo", record_id("info", ""), "2026-01-01T00:00:00Z", "", b"format: WARC File Format 1.1\r\n", mime="application/warc-fields"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[bytes]:
            for batch in batches:
                for r in batch.to_pylist():
                    first_uri = stored_url(r["first_uri"])
                    ident, first = record_id(r["id"], r["uri"]), record_id(r["first_id"], first_uri)
                    fields = {"WARC-IP-Address": r["ip"], "WARC-Payload-Digest": f"sha1:{r['digest']}"}
                    if r["revisit"]:
                        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": first, "WARC-Refers-To-Target-URI": first_uri, "WARC-Refers-To-Date": r["date"]}
                    block = r["head"] if r["revisit"] else r["head"] + r["payload"]
                    yield _member(warc_record("revisit" if r["revisit"] else "response", ident, r["date"], r["uri"], block, fields))

        for data in _segments(made(), info, most):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return records.select("id", "uri", "date", "ip", "head", "payload", "digest", "first_id", "first_uri", "revisit").mapInArrow(write, "data binary")


def read_warc(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """record, id, payload_bytes, payload_digest, record_type, refers of each response and revisit."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in parse_warc(data.as_py()):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    http, _, payload = http_parts(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response" and (digest != sha1_base32(payload) or len(payload) != int(http["content-length"])):
                        raise ValueError(f"the payload of {fields['warc-record-id']} isn't the one declared")
                    rows.append((fields["warc-record-id"], http.get("x-page-id"), int(http["content-length"]), digest, fields["warc-type"], fields.get("warc-refers-to")))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["record", "id", "payload_bytes", "payload_digest", "record_type", "refers"])

    found = archives.select("data").mapInArrow(read, "record string, id string, payload_bytes long, payload_digest string, record_type string, refers string")
    return found.withColumn("id", F.col("id").cast(id_type))


def first_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """sha1 (hex), first_id and first_uri: of each payload's pages the smallest id. Light rows, combined before the shuffle."""
    light = pages.select(F.sha1(F.coalesce(F.col(html_col), F.lit("")).cast("binary")).alias("sha1"), F.struct(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("uri")).alias("page"))
    return light.groupBy("sha1").agg(F.min(F.when(F.col("page.id").isNotNull(), F.col("page"))).alias("page")).select("sha1", F.col("page.id").alias("first_id"), F.col("page.uri").alias("first_uri"))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, version: int = 2) -> DataFrame:
    """data: WARC archives of the pages, by way of ARC archives of that version, which are parsed again.

    Of equal payloads of at least min_revisit_bytes the page with the smallest id has the response and
    the others revisit it; smaller ones are all responses."""
    id_type = pages.schema[id_col].dataType.simpleString()
    records = arc_records(pages_to_arc(pages, id_col, url_col, html_col, version), id_type).withColumn("sha1", F.sha1("payload"))
    joined = records.join(first_pages(pages, id_col, url_col, html_col), "sha1")
    return to_warc(joined.withColumn("revisit", (F.length("payload") >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))))


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, version: int = 2) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type and refers_to as the stored archives have them.

    Null html is an empty payload. Rows that repeat an id and a payload are all responses, or all
    revisits; a page with a null id revisits a known page, or is a response where its payload has
    none. An empty table gives no rows; columns but id, url and html aren't read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    stored = materialise(archive_pages(pages, id_col, url_col, html_col, min_revisit_bytes, version), "warc")
    back = materialise(read_warc(stored, id_type), "warc-read")
    targets = back.filter("record_type = 'response'").select(F.col("record").alias("refers"), F.col("id").alias("refers_to")).dropDuplicates(["refers"])
    return back.join(targets, "refers", "left").select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
