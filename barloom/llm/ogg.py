"""Ogg columns: pages with checked sums, packets from lacing values, logical streams and their times."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable

RATE = 8000
PACKET = 8000
SEGMENTS = 24
_HEAD = struct.Struct("<4sBBqIIIB")
_MIRROR = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_IDENT = struct.Struct("<8sBBHI")  # magic, version, place among the streams, number of streams, samples a second
_MAGIC = b"\x01pcm-u8\0"
CONTINUED, FIRST, LAST = 1, 2, 4


def page_sum(page: bytes) -> int:
    """The checksum of a page whose own sum is zero: polynomial 04c11db7 from the high bit, no start value, no inversion.

    zlib has the same polynomial from the low bit; mirrored bytes in and mirrored bits out make it this one.
    """
    low = zlib.crc32(page.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(low.to_bytes(4, "big").translate(_MIRROR), "little")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    return head[:22] + page_sum(head + body).to_bytes(4, "little") + head[26:] + body


def stream_pages(packets: list[tuple[bytes, int]], serial: int) -> Iterator[tuple[int, bytes]]:
    """(time, page) of one logical stream of (packet, end granule); the first packet has a page of its own.

    A packet is laced in segments of 255 and a last one of less; pages hold at most SEGMENTS of
    them, so long packets continue on the next page. A page's granule is that of the last packet that ends on it.
    """
    number = 0
    lacing, body, granule, flags, time = bytearray(), bytearray(), -1, FIRST, 0
    for i, (packet, end) in enumerate(packets):
        sizes = bytes([255] * (len(packet) // 255) + [len(packet) % 255])
        at = 0
        for k, size in enumerate(sizes):
            lacing.append(size)
            body += packet[at : at + size]
            at += size
            over = k == len(sizes) - 1
            granule = end if over else granule
            time = max(time, end)
            ending = over and i == len(packets) - 1
            if ending or (over and i == 0) or len(lacing) == SEGMENTS:
                yield time, _page(flags | (LAST if ending else 0), granule, serial, number, bytes(lacing), bytes(body))
                number += 1
                lacing, body, granule, flags = bytearray(), bytearray(), -1, 0 if over else CONTINUED


def write_ogg(samples: bytes, streams: int = 2) -> bytes:
    """8-bit mono samples, a second at a time to each of `streams` logical streams in turn, their pages in order of time.

    A stream's granules count its own samples.
    """
    pages: list[tuple[int, int, bytes]] = []
    for s in range(streams):
        packets, own = [(_IDENT.pack(_MAGIC, 1, s, streams, RATE), 0)], 0
        for at in range(s * PACKET, len(samples), streams * PACKET):
            packet = samples[at : at + PACKET]
            own += len(packet)
            packets.append((packet, own))
        pages += [(time * streams, s, page) for time, page in stream_pages(packets, 0x0A0 + s)]
    return b"".join(page for _, _, page in sorted(pages, key=lambda p: p[:2]))


def read_pages(data: bytes) -> Iterator[tuple[int, int, int, int, bytes, bytes] | None]:
    """(flags, granule, serial, number, lacing, body) of each page; None for each damaged stretch.

    A page whose sum is wrong is passed over, up to the next capture pattern.
    """
    at = 0
    while at < len(data):
        good = False
        if data[at : at + 4] == b"OggS" and at + 27 <= len(data):
            _, version, flags, granule, serial, number, total, n = _HEAD.unpack_from(data, at)
            lacing = data[at + 27 : at + 27 + n]
            end = at + 27 + n + sum(lacing)
            if version == 0 and len(lacing) == n and end <= len(data):
                page = data[at:end]
                good = page_sum(page[:22] + b"\0\0\0\0" + page[26:]) == total
        if good:
            yield flags, granule, serial, number, lacing, page[27 + n :]
            at = end
        else:
            yield None
            at = data.find(b"OggS", at + 1)
            if at < 0:
                return


def read_streams(data: bytes) -> tuple[dict[int, list[tuple[bytes, int | None]]], dict]:
    """Packets of each logical stream, by serial number, as (packet, end granule), and what was met on the way.

    The last packet that ends on a page has the page's granule; packets that end earlier on it
    end before those after them by their lengths, a sample a byte. A packet that lost a page is dropped.
    """
    streams: dict[int, list] = {}
    open_: dict[int, bytearray | None] = {}
    due: dict[int, int] = {}
    met = {"pages": 0, "bad": 0, "lost": 0, "ended": 0}
    for page in read_pages(data):
        if page is None:
            met["bad"] += 1
            continue
        flags, granule, serial, number, lacing, body = page
        met["pages"] += 1
        met["ended"] += bool(flags & LAST)
        packets = streams.setdefault(serial, [])
        part = open_.get(serial)
        if number != due.get(serial, 0) or bool(flags & CONTINUED) != (part is not None):
            met["lost"] += 1
            part = None
        skip = bool(flags & CONTINUED) and part is None
        due[serial] = number + 1
        at, done = 0, []
        for size in lacing:
            part = bytearray() if part is None else part
            part += body[at : at + size]
            at += size
            if size < 255:
                if not skip:
                    done.append(bytes(part))
                part, skip = None, False
        open_[serial] = None if skip else part
        for packet in reversed(done):
            packets.append((packet, granule if granule >= 0 else None))
            granule -= len(packet)
        packets[len(packets) - len(done) :] = packets[len(packets) - len(done) :][::-1]
    return streams, met


def read_ogg(data: bytes) -> tuple[bytes, dict]:
    """The samples of all logical streams in order of their times, and facts: streams, pages, packets, damage and seconds."""
    streams, met = read_streams(data)
    blocks, seconds = [], 0.0
    for packets in streams.values():
        if not packets or packets[0][0][:8] != _MAGIC:
            continue
        _, _, place, turns, rate = _IDENT.unpack(packets[0][0])
        for packet, end in packets[1:]:
            if end is not None and packet:
                begin = ((end - len(packet)) // PACKET * turns + place) * PACKET
                blocks.append((begin, packet))
                seconds = max(seconds, (begin + len(packet)) / rate)
    blocks.sort(key=lambda b: b[0])
    met |= {"streams": len(streams), "packets": sum(map(len, streams.values())), "seconds": seconds}
    return b"".join(b for _, b in blocks), met


def padded(text: bytes | None) -> bytes:
    """A text with zero bytes up to a positive multiple of 64."""
    text = text or b""
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as an Ogg file; null counts as empty."""

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or b"" for t in pc.cast(part.column(1), pa.binary()).to_pylist()]
                media = [write_ogg(padded(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(write, "doc_id long, n_bytes long, media binary")


FACTS = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, streams int, pages int, packets int, damaged int, seconds double"
)


def media_features(media: DataFrame) -> DataFrame:
    """What is read back of (doc_id, n_bytes, media): sizes, sums and features of the first n_bytes samples' audio.

    damaged counts bad stretches, lost pages and streams without an end; null media gives no samples.
    """

    def read(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in FACTS.split(", ")]
        for batch in batches:
            rows = []
            for doc, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = data or b""
                payload, met = read_ogg(data)
                x = np.frombuffer(payload, np.uint8)[: n or 0].astype(np.int64)
                moves = int(np.abs(np.diff(x)).sum())
                feature = f"sum={int(x.sum())};square={int((x * x).sum())};moves={moves};peak={int(x.max(initial=0))};streams={met['streams']};seconds={met['seconds']:.3f}"
                rows.append(
                    (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature)
                    + (met["streams"], met["pages"], met["packets"], met["bad"] + met["lost"] + met["streams"] - met["ended"], met["seconds"])
                )
            kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "double": pa.float64()}
            arrays = [pa.array([r[k] for r in rows], kinds[c.split()[1]]) for k, c in enumerate(FACTS.split(", "))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, FACTS)


def media_round_trip(docs: DataFrame, **columns) -> DataFrame:
    """Every text stored as Ogg in the shared folder and read back. Each row stands for itself, repeated and null ids too; ids are whole numbers, other columns aren't read."""
    return media_features(durable(to_media(docs, **columns), "media"))
