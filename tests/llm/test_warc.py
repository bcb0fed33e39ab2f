import gzip

from barloom.llm.warc import (
    ARCHIVE_SQL,
    archive_pages,
    archive_round_trip,
    convert_archives,
    read_arc,
    read_archives,
    read_warc,
    sha1_base32,
    warc_fields,
    write_arc,
    write_archives,
    write_warc_record,
)

RECORDS = [
    ("http://a.example/x y", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n\nworld"),
    ("dns:a.example", "1.2.3.4", "20010203", "text/dns", b"a.example 60 IN A 1.2.3.4"),
    ("http://b.example/", "::1", "20019903040506", "text/html", b""),
]


def test_both_versions_are_read_by_their_headers():
    for version in (1, 2):
        data = write_arc(RECORDS, version)
        for file in (data, gzip.compress(data[:200]) + gzip.compress(data[200:])):
            got = list(read_arc(file))
            assert [(r.ip, r.date, r.kind, r.block) for r in got] == [r[1:] for r in RECORDS]
            assert got[0].url == "http://a.example/x%20y"


def test_pages_whose_url_looks_like_a_version_block_are_records():
    odd = [RECORDS[0], ("filedesc://a page", "1.2.3.4", "20010203040506", "text/html", b"1 is its first letter"), ("filedesc:", "::1", "20010203040506", "text/html", b""), *RECORDS[1:]]
    for version in (1, 2):
        data = write_arc(odd, version)
        for file in (data, gzip.compress(data)):
            assert [(r.ip, r.date, r.kind, r.block) for r in read_arc(file)] == [r[1:] for r in odd]
        both = write_arc(RECORDS, 3 - version) + b"\n" + data
        assert [r.block for r in read_arc(both)] == [r[4] for r in RECORDS + odd]


def test_bad_lengths_and_cut_files_cost_one_record():
    data = write_arc(RECORDS, 1)
    wrong = data.replace(b" text/dns 25\n", b" text/dns 24\n")
    assert [r.url for r in read_arc(wrong)] == ["http://a.example/x%20y", "http://b.example/"]
    assert len(list(read_arc(data[:-30]))) == 2
    assert list(read_arc(b"")) == []
    spaced = write_arc(RECORDS[:1], 1).replace(b"x%20y", b"x y")
    assert next(read_arc(spaced)).url == "http://a.example/x y"


def test_fields_are_synthesised_alike_each_time():
    first, dns, late = (warc_fields(r) for r in read_arc(write_arc(RECORDS, 2)))
    assert (first["WARC-Type"], dns["WARC-Type"], dns["Content-Type"]) == ("response", "resource", "text/dns")
    assert first["WARC-Date"] == "2001-02-03T04:05:06Z" and dns["WARC-Date"] == "2001-02-03T00:00:00Z" and late["WARC-Date"].startswith("1970")
    assert first["WARC-Payload-Digest"] == "sha1:" + sha1_base32(b"hello\n\nworld")
    assert first == next(warc_fields(r) for r in read_arc(write_arc(RECORDS, 2)))
    twice = [warc_fields(r, "a.arc")["WARC-Record-ID"] for r in read_arc(write_arc(RECORDS[:1] * 2, 1))]
    assert len({*twice, first["WARC-Record-ID"]}) == 3


def test_digits_of_other_scripts_are_no_header(spark):
    odd = write_arc(RECORDS, 1).replace(b" text/dns 25\n", " text/dns ²5\n".encode()).replace(b"20010203040506", "2001020304050٦".encode())
    assert [r.url for r in read_arc(odd)] == ["http://b.example/"]
    warc = write_warc_record({"N": "1"}, b"abc") + write_warc_record({"N": "2"}, b"de")
    assert [f["N"] for f, _ in read_warc(warc.replace(b"Content-Length: 3", "Content-Length: ³".encode()))] == ["2"]
    block = b"HTTP/1.1 200 OK\r\nX-Page-Id: \xc2\xb2\r\n\r\nabc"
    files = [("a.arc", write_arc([("u", "::1", "20010203", "t", block)])), ("b.arc.gz", gzip.compress(write_arc(RECORDS))), ("c.arc", None), ("d.arc", b"")]
    got = convert_archives(spark.createDataFrame(files, "name string, content binary")).collect()
    assert sorted((r.url, r.page_id, r.payload_bytes) for r in got) == [("dns:a.example", None, 25), ("http://a.example/x%20y", None, 12), ("http://b.example/", None, 0), ("u", None, 3)]
    assert len({r.record_id for r in got}) == 4


def test_warc_records_round_trip_and_damage_is_left_out():
    for compress in (False, True):
        data = b"".join(write_warc_record({"WARC-Type": "resource", "N": str(i)}, b"WARC/1.0\r\n\r\n" * i, compress) for i in range(4))
        assert [(f["N"], b) for f, b in read_warc(data)] == [(str(i), b"WARC/1.0\r\n\r\n" * i) for i in range(4)]
    data = bytearray(write_warc_record({"N": "1"}, b"abc") + write_warc_record({"N": "2"}, b"def"))
    data[data.index(b"abc")] = 0
    assert [f["N"] for f, _ in read_warc(bytes(data))] == ["2"]


def test_pages_round_trip_matches_sql(spark):
    import duckdb

    rows = [(i, f"http://h/{i % 7}", ["same", None, "", f"own {i}", "é" * 500][i % 5], "x") for i in range(60)]
    rows += [(None, None, "same", "x"), (None, "http://h/n", "nowhere else", None), (100, "http://h/l", "long " * 100_000, None), (8, "http://h/1", "own 8", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = [tuple(r) for r in archive_round_trip(df).collect()]
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    want = con.execute(ARCHIVE_SQL).fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert archive_round_trip(df.limit(0)).count() == 0


def test_urls_like_version_blocks_hot_payloads_and_repeated_rows(spark, monkeypatch):
    import duckdb

    monkeypatch.setattr("barloom.llm.common.HOT_ROWS", 2)
    monkeypatch.setattr("barloom.llm.common.HOT_SHARE", 1 << 40)
    rows = [(i, "filedesc://x" if i % 3 else "filedesc:", [None, "a", "b"][i % 2 + (i > 30)]) for i in range(40)] + [(7, "u", "a"), (7, "u", "a"), (1, "u", "a"), (1, "u", "a"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    assert sorted(map(repr, map(tuple, archive_round_trip(df).collect()))) == sorted(map(repr, con.execute(ARCHIVE_SQL).fetchall()))
    ids = [r.record_id for r in convert_archives(archive_pages(df)).collect()]
    assert len(ids) == len(set(ids)) == len(rows)


def test_compressed_archives_hold_each_record_once(spark):
    df = spark.createDataFrame([(i, "u", "abc" * (i % 3), None) for i in range(50)], "page_id long, url string, html string, digest string")
    archives = write_archives(convert_archives(archive_pages(df)), archive_bytes=2000, compress=True)
    kept = [(r.archive, r.n_records) for r in archives.collect()]
    assert len(kept) > 1 and all(a.endswith(".warc.gz") for a, _ in kept) and sum(n for _, n in kept) == 50
    back = read_archives(archives).collect()
    assert sorted(r.page_id for r in back) == list(range(50)) and sum(r.record_type == "response" for r in back) == 3


def test_damaged_gzip_members_cost_their_own_records():
    members = [gzip.compress(part) for part in _parts(write_arc(RECORDS))]
    assert len(members) > 3
    whole = list(read_arc(b"".join(members)))
    assert [r.block for r in whole] == [r[4] for r in RECORDS]
    for hit in range(1, len(members)):
        for damage in ("flip", "cut"):
            broken = bytearray(members[hit])
            middle = len(broken) // 2
            if damage == "flip":
                broken[middle : middle + 4] = bytes(255 - b for b in broken[middle : middle + 4])
            else:
                del broken[middle:]
            left = [r.block for r in read_arc(b"".join([*members[:hit], bytes(broken), *members[hit + 1 :]]))]
            want = [r[4] for k, r in enumerate(RECORDS) if k != hit - 1]
            assert left == want or (damage == "flip" and left == [r[4] for r in RECORDS])
    fields, records = {"WARC-Type": "resource"}, []
    for k in range(4):
        block = f"block {k} ".encode() * 50
        records.append(write_warc_record({"WARC-Type": "resource", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Length": str(len(block)), **fields}, block, compress=True))
    broken = bytearray(records[1])
    broken[30] ^= 255
    assert [b[:7] for _, b in read_warc(b"".join([records[0], bytes(broken), *records[2:]]))] == [b"block 0", b"block 2", b"block 3"]


def _parts(data):
    """The version block and each record of an ARC file."""
    cuts = [r.offset for r in read_arc(data)]
    return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]


def test_content_types_with_spaces_are_headers():
    for version in (1, 2):
        records = [("http://a.b/c d 1999 e", "10.0.0.1", "20010203040506", kind, b"body " * 9) for kind in ("text/html; charset=utf-8", "text/html", "a b c; d=1")]
        got = list(read_arc(write_arc(records, version)))
        assert [(r.ip, r.date, r.kind, r.block) for r in got] == [r[1:] for r in records]
        assert {r.url for r in got} == {"http://a.b/c%20d%201999%20e"}
