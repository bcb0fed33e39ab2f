import hashlib
import random
import zlib

import pytest

from barloom.llm.ogg import PACKET, media_features, media_round_trip, padded, page_sum, read_ogg, read_streams, stream_pages, to_media, write_ogg


def plain_sum(data):
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum_is_the_bitwise_one():
    rng = random.Random(0)
    for n in (0, 1, 5, 300):
        data = rng.randbytes(n)
        assert page_sum(data) == plain_sum(data)


@pytest.mark.parametrize("size", [64, 254, 255, 256, 510, PACKET - 1, PACKET, PACKET + 1, 5 * PACKET + 77, 200_000])
def test_round_trip_at_lacing_and_packet_edges(size):
    samples = random.Random(size).randbytes(size)
    for streams in (1, 2, 3):
        back, met = read_ogg(write_ogg(samples, streams))
        assert back == samples and met["bad"] == met["lost"] == 0 and met["streams"] == met["ended"] == streams
        assert met["seconds"] == size / 8000


def test_packets_of_lacing_multiples_and_several_on_a_page():
    packets = [(b"head", 0), (b"a" * 255, 255), (b"", 255), (b"b" * 510, 765), (b"c" * 10, 775), (b"d" * 20_000, 20_775)]
    data = b"".join(page for _, page in stream_pages(packets, 7))
    streams, met = read_streams(data)
    assert [p for p, _ in streams[7]] == [p for p, _ in packets]
    assert [g for _, g in streams[7]][1:] == [g for _, g in packets][1:] and met["ended"] == 1


def test_damage_costs_the_packets_it_touches_only():
    samples = random.Random(3).randbytes(6 * PACKET)
    data = bytearray(write_ogg(samples, 2))
    data[len(data) // 2] ^= 1
    back, met = read_ogg(bytes(data))
    assert met["bad"] == 1 and met["lost"] >= 1
    assert len(back) % PACKET == 0 and 2 * PACKET <= len(back) < len(samples)
    assert all(back[i : i + PACKET] in samples for i in range(0, len(back), PACKET))
    assert read_ogg(b"")[0] == b"" and read_ogg(b"junk")[1]["bad"] == 1


def test_table_round_trip(spark):
    rows = [(1, "abc", "x"), (2, None, None), (2, "", "x"), (None, "é" * 100, None), (3, "long " * 40_000, "x"), (4, "abc", "y"), (5, "z" * 64, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    got = {(r.doc_id, r.n_bytes): r for r in media_round_trip(df).collect()}
    assert len(got) == 6
    for doc, text, _ in rows:
        want = padded((text or "").encode())
        r = got[(doc, len((text or "").encode()))]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        assert r.damaged == 0 and len(want) % 64 == 0 and len(want) > 0
        assert r.media_sha256 == hashlib.sha256(write_ogg(want)).hexdigest()
    assert got[(1, 3)].feature == got[(4, 3)].feature
    assert media_round_trip(df.limit(0)).count() == 0
    broken = media_features(to_media(df.where("doc_id = 1")).selectExpr("doc_id", "n_bytes", "cast(null as binary) as media")).collect()
    assert broken[0].payload_bytes == 0
