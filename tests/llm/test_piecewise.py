import hashlib
import random

import numpy as np
import pytest

from barloom.llm import piecewise as P
from barloom.llm.common import mix
from barloom.llm.piecewise import _key_ranges, edit_distances, edited_likeness, fingerprint_texts, fingerprints, likenesses

SCHEMA = "doc_id long, text string, fingerprint string"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distances_match_the_plain_table():
    rng = random.Random(4)
    pairs = [("", ""), ("a", ""), ("", "bc"), ("A" * 64, "A" * 63 + "b")]
    for _ in range(300):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 64)))
        b = "".join(c if rng.random() < 0.8 else rng.choice("abcd") for c in a)[: rng.randint(0, 64)]
        pairs.append((a, b))
    got = edit_distances([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs])
    assert got.tolist() == [levenshtein(a, b) for a, b in pairs]


def test_fingerprints_do_not_depend_on_company_and_follow_local_edits():
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(3000)}" for _ in range(800))
    other = " ".join(f"v{rng.randrange(3000)}" for _ in range(800))
    near = text.replace("w1", "x1", 3)
    alone = [fingerprints([t.encode()])[0] for t in (text, "", other, near, "ab", text)]
    assert fingerprints([t.encode() for t in (text, "", other, near, "ab", text)]) == alone
    assert alone[0] == alone[5] and alone[1] == "3::"
    assert likenesses([alone[0]] * 3, [alone[0], alone[3], alone[2]]).tolist()[0] == 1
    same, close, far = likenesses([alone[0]] * 3, [alone[0], alone[3], alone[2]])
    assert same == 1 and close > 0.8 and far < 0.5
    assert fingerprints([b"\0" * 100, b"q" * 3_000_000, b"x"])[2] == fingerprints([b"x"])[0]


def plainly(data):
    """A fingerprint byte by byte, from the definition."""
    word = lambda b: int(P._TABLE[b]) if b else 0
    levels = []
    for i in range(len(data)):
        roll = sum(word(data[i - j]) * pow(int(P._STEP), j, 1 << 32) for j in range(P.WINDOW) if i >= j) & 0xFFFFFFFF
        roll = (roll ^ roll >> 16) * 0x7FEB352D & 0xFFFFFFFF
        mark = ((roll ^ roll >> 15) + 1) & 0xFFFFFFFF
        levels.append(-1 if mark % 3 else 31 if not mark else (mark & -mark).bit_length() - 1)
    k = next(k for k in range(40) if len(data) <= 3 * 64 << k)
    while k and sum(v >= k for v in levels) < 32:
        k -= 1

    def signature(least, longest):
        pieces, piece = [], []
        for byte, level in zip(data, levels):
            piece.append(byte)
            if level >= least and len(pieces) < longest - 1:
                pieces, piece = [*pieces, piece], []
        pieces = [*pieces, piece] if piece else pieces
        sums = [sum((b + 1) * pow(P._BASE, n, 1 << 64) for n, b in enumerate(x)) % (1 << 64) for x in pieces]
        return "".join(chr(P.ALPHABET[int(mix(np.array([x], np.uint64))[0]) >> 58]) for x in sums)

    return f"{3 << k}:{signature(k, 64)}:{signature(k + 1, 32)}"


def test_fingerprints_match_a_plain_loop():
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"abcdefgh \n\xc3\xa9") for _ in range(n)) for n in (0, 1, 2, 50, 191, 192, 193, 400, 1500, 4000)]
    texts += [b"a" * 700, bytes(200), b"abc" * 500]
    assert fingerprints(texts) == [plainly(t) for t in texts]


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (doc, text, _) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        f, e, n = (fingerprints([t.encode()])[0] for t in (text, edited, nxt))
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, likenesses([f], [e])[0], likenesses([f], [n])[0])
    return out


@pytest.mark.parametrize("range_bytes", [1500, 1 << 26])
def test_next_documents_match_brute_force(spark, range_bytes):
    rng = random.Random(9)
    rows = [(rng.randrange(10**6) * 5 + i % 5, " ".join(rng.choice(["é", "bb", "ccc"]) for _ in range(rng.randrange(60))), "x") for i in range(150)]
    rows += [(-4, None, None), (7_000_000, "", None), (None, "last of all", None), (6_000_000, "long " * 30_000, "x")]
    rows = list({r[0]: r for r in rows}.values())
    want = brute(rows)
    got = edited_likeness(spark.createDataFrame(rows, SCHEMA).repartition(5), range_bytes=range_bytes).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)


def test_few_rows_repeats_and_none(spark):
    one = edited_likeness(spark.createDataFrame([(1, "abcd", None)], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1
    twice = edited_likeness(spark.createDataFrame([(1, "abcd", None)] * 2 + [(3, "zz", None)], SCHEMA)).collect()
    assert sorted(r.doc_id for r in twice) == [1, 1, 3]
    same = [(None, f"t{k}", None) for k in range(40)] + [(5, f"u{k % 9}", None) for k in range(40)]
    got = edited_likeness(spark.createDataFrame(same, SCHEMA).repartition(3), range_bytes=20).collect()
    assert len(got) == 80 and sorted(str(r.doc_id) for r in got) == ["5"] * 40 + ["None"] * 40
    empty = spark.createDataFrame([], SCHEMA)
    assert edited_likeness(empty).count() == 0 and fingerprint_texts(empty).count() == 0
    assert [r.fingerprint for r in fingerprint_texts(spark.createDataFrame([(1, None, "x")], SCHEMA)).collect()] == ["3::"]


def test_ranges_are_cut_by_bytes_where_sizes_follow_ids(spark):
    rows = [(k, k, 10 if k < 4000 else 20_000 + k) for k in range(5000)] + [(None, k, 3_000) for k in range(500)] + [(-1, 7, 400)] * 300
    keys = spark.createDataFrame(rows, "id long, hash long, bytes long").repartition(5)
    total, most = sum(r[2] for r in rows), 1 << 18
    for ranges in (3, 40, 1):
        found = _key_ranges(keys, ranges, most)
        assert sum(r.bytes for r in found) == total
        assert max(r.bytes for r in found) < 2 * most and len(found) < 3 * total // most + ranges
        order = lambda i, h: (1, 0, h) if i is None else (0, -i, h)
        ends = sorted((order(r.first_id, r.first_hash), order(r.last_id, r.last_hash)) for r in found)
        assert all(a <= b for a, b in ends) and all(x[1] < y[0] for x, y in zip(ends, ends[1:], strict=False))
