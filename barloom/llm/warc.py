"""Web archives: legacy ARC records are read by their version's header and converted to WARC records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, forget, meet

#: Header fields of a URL record by version of the ARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: The version, a reserved digit and the origin, then the names of the fields.
VERSION_BLOCK = re.compile(rb"[12] \d+ [^\n]*\nURL IP-address ")
#: How a gzip member begins.
GZIP = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: Header lines by their number of fields, whose content type may hold spaces: URL, address, date, type, the other fields.
_SPACED = {n: re.compile(r"(.*) ([0-9A-Fa-f:.]+|-) ([0-9]{4,14}) (.*)" + r" (\S+)" * (n - 5) + " ([0-9]+)", re.DOTALL) for n in (5, 10)}


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    kind: str
    block: bytes
    offset: int


def arc_header(version: int, url: str, ip: str, date: str, kind: str, length: int, offset: int = 0, name: str = "-") -> bytes:
    url = url.replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D") or "-"
    middle = [] if version == 1 else ["200", "-", "-", str(offset), name]
    return " ".join([url, ip, date, kind, *middle, str(length)]).encode() + b"\n"


def write_arc(records: list[tuple[str, str, str, str, bytes]], version: int = 1, name: str = "part.arc") -> bytes:
    """An ARC file of (url, ip, date of 14 digits, content type, block), after its version block."""
    block = f"{version} 0 barloom\n{ARC_FIELDS[version]}\n\n".encode()
    out = bytearray(arc_header(version, f"filedesc://{name}", "0.0.0.0", "20000101000000", "text/plain", len(block), 0, name) + block + b"\n")
    for url, ip, date, kind, block in records:
        out += arc_header(version, url, ip, date, kind, len(block), len(out), name) + block + b"\n"
    return bytes(out)


def _number(text: str) -> int | None:
    """A number of ASCII digits; other digits aren't ones of a header."""
    return int(text) if text.isascii() and text.isdigit() else None


def _arc_line(line: bytes, fields: int) -> tuple[list[str], int] | None:
    """A header line's fields and declared length, or None if it isn't one.

    A URL may hold spaces: fields count from the right. A content type may too (`text/html; charset=utf-8`): then the
    last address and date that follow each other are those of the record, and what stands between them and the last fields is the type.
    """
    text = line.decode("utf-8", "replace")
    parts = text.rsplit(" ", fields - 1)
    if len(parts) != fields or not (_number(parts[2]) is not None and 4 <= len(parts[2]) <= 14):
        found = _SPACED[fields].fullmatch(text)
        if found is None:
            return None
        parts = list(found.groups())
    if _number(parts[-1]) is None:
        return None
    return parts, int(parts[-1])


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The URL records of an ARC file (gzip members are opened), after its version block, which sets the fields of the header lines.

    A damaged gzip member costs its own records. Where a declared length doesn't lead to a line's end, or a line is no header, reading goes on at
    the next line that is one; a record cut off by the end of the file is left out.
    """
    if data[:2] == b"\x1f\x8b":
        data = gunzip(data)
    at, fields = 0, 5
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].rstrip(b"\r")
        # Beyond the start only files that were put together have one; pages may have such a URL too.
        about_file = line.startswith(b"filedesc:") and (at == 0 or VERSION_BLOCK.match(data, end + 1) is not None)
        if about_file:
            # The version is the first digit of the block, whose header line has that version's fields already.
            version = data[end + 1 : end + 2]
            fields = 10 if version == b"2" else 5
        found = _arc_line(line, fields) if line else None
        if found is None:
            at = end + 1
            continue
        parts, length = found
        stop = end + 1 + length
        if stop > len(data):
            at = end + 1
            continue
        if stop < len(data) and data[stop : stop + 1] not in b"\r\n":
            at = end + 1
            continue
        if not about_file:
            yield ArcRecord(parts[0], parts[1], parts[2], parts[3], data[end + 1 : stop], at)
        at = stop


def gunzip(data: bytes) -> bytes:
    """What all whole gzip members of a file hold, in turn.

    A damaged one is left out, as its text can't be trusted, and reading goes on at the next place where a member begins. The last
    one may be cut off: then what can be had of it is kept, and the records' own lengths and digests tell which are whole.
    """
    out, at = [], data.find(GZIP)
    while at >= 0:
        member, parts, read = zlib.decompressobj(31), [], at
        try:
            while not member.eof and read < len(data):
                parts.append(member.decompress(data[read : read + 65536]))
                read += 65536
        except zlib.error:
            parts = []
        whole = member.eof
        later = data.find(GZIP, min(read, len(data)) - len(member.unused_data) if whole else at + 1)
        if whole or later < 0:
            out += parts
        at = later
    return b"".join(out)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(headers with the empty line, payload); a block without a status line is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    for mark in (b"\r\n\r\n", b"\n\n"):
        at = block.find(mark)
        if at >= 0:
            return block[: at + len(mark)], block[at + len(mark) :]
    return block, b""


def warc_fields(record: ArcRecord, archive: str = "") -> dict[str, str]:
    """What a WARC record says of an ARC record: its identifier is of its contents and of its place in the archive.

    Dates of fewer than 14 digits are filled up; an impossible one becomes the start of 1970. Blocks that begin
    with a status line are responses, others resources of their own content type.
    """
    head, payload = split_http(record.block)
    digits = record.date + "19700101000000"[len(record.date) :]
    try:
        when = datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
    except ValueError:
        when = datetime(1970, 1, 1, tzinfo=timezone.utc)
    digest = sha1_base32(payload)
    date = when.strftime("%Y-%m-%dT%H:%M:%SZ")
    name = "|".join([record.url, date, digest, sha1_base32(head), archive, str(record.offset)])
    return {
        "WARC-Type": "response" if head else "resource",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "WARC-Date": date,
        "WARC-Target-URI": record.url,
        "WARC-IP-Address": record.ip,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response" if head else record.kind,
    }


def write_warc_record(fields: dict[str, str], block: bytes, compress: bool = False) -> bytes:
    fields = {**fields, "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Length": str(len(block))}
    data = b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    return gzip.compress(data, 6, mtime=0) if compress else data


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record; one whose block digest is wrong is left out, as is a cut-off one."""
    if data[:2] == b"\x1f\x8b":
        data = gunzip(data)
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = dict(line.split(": ", 1) for line in lines if ": " in line)
        length = _number(fields.get("Content-Length", ""))
        stop = -1 if length is None else end + 4 + length
        if stop < 0 or stop > len(data):
            at = end
            continue
        block = data[end + 4 : stop]
        if fields.get("WARC-Block-Digest", f"sha1:{sha1_base32(block)}") == f"sha1:{sha1_base32(block)}":
            yield fields, block
            at = stop
        else:
            at = end


RECORD = "page_id long, digest string, payload_bytes long, record_id string, date string, url string, ip string, kind string, content_type string, block binary"
ARCHIVED = 200


def _header(head: bytes, name: bytes) -> str | None:
    """The value of an HTTP header, or None."""
    mark = head.find(b"\n" + name + b": ")
    return head[mark + len(name) + 3 :].split(b"\n", 1)[0].strip().decode("utf-8", "replace") if mark >= 0 else None


def _page_of(head: bytes) -> int | None:
    value = _header(head, b"X-Page-Id") or ""
    n = _number(value.removeprefix("-"))
    return n if n is None or not value.startswith("-") else -n


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(name, content): pages written as ARC files of up to 200 records, by turns of version 1 and 2.

    The page's id, a whole number, travels in the block's HTTP headers. Null html is an empty payload, null url is '-'.
    """

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ARCHIVED):
                piece, records = batch.slice(at, ARCHIVED), []
                for page, url, html in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), pc.cast(piece.column(2), pa.binary()).to_pylist(), strict=True):
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + ("" if page is None else f"X-Page-Id: {page}\r\n") + "\r\n"
                    records.append((url or "-", "0.0.0.0", "20240101000000", "text/html", head.encode() + (html or b"")))
                turn += 1
                name = f"pages-{part:05d}-{turn:05d}.arc"
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([write_arc(records, 1 + turn % 2, name)], pa.binary())], ["name", "content"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{url_col}`").cast("string"), F.col(f"`{html_col}`").cast("string"))
    return rows.mapInArrow(write, "name string, content binary")


def convert_archives(archives: DataFrame, name_col: str = "name", content_col: str = "content") -> DataFrame:
    """A row for each record of stored ARC files (name, content), gzipped or not, with what a WARC record says of it.

    page_id is the number in the block's X-Page-Id header, null where there is none. Null content has no records; the names of
    files should differ, as identifiers are made of them.
    """

    def convert(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in RECORD.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for record in read_arc(content.as_py() or b""):
                    fields = warc_fields(record, name or "")
                    head, payload = split_http(record.block)
                    rows.append(
                        (_page_of(head), fields["WARC-Payload-Digest"][5:], len(payload), fields["WARC-Record-ID"], fields["WARC-Date"], record.url, record.ip)
                        + (fields["WARC-Type"], fields["Content-Type"], record.block)
                    )
                    if len(rows) == ARCHIVED:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return archives.select(F.col(f"`{name_col}`").cast("string"), F.col(f"`{content_col}`").cast("binary")).mapInArrow(convert, RECORD)


def write_archives(records: DataFrame, archive_bytes: int = 1 << 20, compress: bool = False) -> DataFrame:
    """(archive, n_records, content): WARC files of about archive_bytes of the converted records, a stored table.

    Of records of one payload those of the least page_id are whole, others are revisits that refer to it
    and hold the headers alone. Which is the least is settled on ids and digests, pre-aggregated by digest; records move
    once, by their identifier, so that a payload that very many pages have isn't dealt to one task.
    """
    narrow = records.select("digest", "page_id", "record_id", "url", "date")
    place = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "record_id", "url", "date")
    least = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("origin"))
    least = durable(least.where("n > 1 and origin.page_id is not null"), "least")
    later = meet(narrow, least, ["digest"]).where("page_id is null or page_id <> origin.page_id").select("record_id", "origin")
    ready = records.join(later, "record_id", "left").select(
        "page_id", "digest", "payload_bytes", "record_id", "date", "url", "ip", "kind", "content_type", "block", "origin"
    )

    def write(batches):
        import pyarrow as pa

        out, size, n = [], 0, 0

        def emit():
            content = b"".join(out)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{hashlib.sha1(content).hexdigest()}.warc" + ".gz" * compress]), pa.array([n], pa.int64()), pa.array([content], pa.binary())],
                ["archive", "n_records", "content"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, digest, length, record, date, url, ip, kind, content_type, block, origin = row
                fields = {
                    "WARC-Type": kind, "WARC-Record-ID": record, "WARC-Date": date, "WARC-Target-URI": url, "WARC-IP-Address": ip,
                    "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": content_type,
                }
                if origin:
                    fields |= {
                        "WARC-Type": "revisit", "WARC-Profile": REVISIT, "WARC-Refers-To": origin["record_id"],
                        "WARC-Refers-To-Target-URI": origin["url"], "WARC-Refers-To-Date": origin["date"], "X-Payload-Length": str(length),
                    }
                    block = split_http(block)[0]
                out.append(write_warc_record(fields, block, compress))
                size, n = size + len(out[-1]), n + 1
                if size >= archive_bytes:
                    yield emit()
                    out, size, n = [], 0, 0
        if n:
            yield emit()

    return ready.mapInArrow(write, "archive string, n_records long, content binary")


READ = "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, payload_digest string, refers_to_record string"


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each record of (…, content): its type, its page and the digest of its full payload.

    A response's digest is computed anew, a revisit's is the one it states.
    """

    def read(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in READ.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in READ.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in read_warc(content.as_py() or b""):
                    head, payload = split_http(block)
                    page, revisit = _page_of(head), fields.get("WARC-Type") == "revisit"
                    length = _number(fields.get("X-Payload-Length", "")) if revisit else len(payload)
                    digest = fields.get("WARC-Payload-Digest", "")[5:] if revisit else sha1_base32(payload)
                    rows.append((fields.get("WARC-Record-ID"), fields.get("WARC-Type"), fields.get("WARC-Target-URI"), fields.get("WARC-Date"), page, length, digest, fields.get("WARC-Refers-To")))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return archives.select("content").mapInArrow(read, READ)


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) for each page, from the archives written of them.

    Ids are whole numbers; other columns aren't read. Rows that repeat a page_id and its payload are all responses, or all revisits of a lesser page; a null
    page_id ranks last, so it revisits any page of the same payload, and is a response where there is none.
    """
    records = durable(convert_archives(archive_pages(pages, **columns)), "records")
    archives = durable(write_archives(records), "archives")
    back = read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_record")
    back = durable(back, "read-back")
    forget(records, archives)
    whole = back.where("record_type <> 'revisit'")
    again = back.where("record_type = 'revisit'")
    # Responses refer to nothing, so only revisits look for their origin.
    wanted = again.groupBy(F.col("refers_to_record").alias("record_id")).agg(F.count(F.lit(1)).alias("n"))
    origins = durable(whole.select("record_id", F.col("page_id").alias("refers_to")).join(wanted, "record_id").withColumnRenamed("record_id", "refers_to_record"), "origins")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = meet(again, origins, ["refers_to_record"]).select(*columns)
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(found)


#: DuckDB gives SHA-1 as hexadecimal digits: 40 of them are 32 groups of five bits.
ARCHIVE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT hex, min(page_id) AS first_page FROM h GROUP BY hex),
b AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v AS INT) + 1, 1), '' ORDER BY g * 4 + k) AS b32
      FROM (SELECT hex, g, k, (CAST('0x' || substr(hex, g * 5 + 1, 5) AS BIGINT) >> (15 - 5 * k)) & 31 AS v
            FROM f, (SELECT unnest(range(8)) AS g), (SELECT unnest(range(4)) AS k)) GROUP BY hex)
SELECT page_id, payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = first_page OR first_page IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM h JOIN f USING (hex) JOIN b USING (hex)
"""
