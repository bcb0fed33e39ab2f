"""Personal data: the base against plain patterns, the trees on planted spans, redaction."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from barloom.llm.private import KINDS, calibrated, find_private, private_data, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and passes_luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if keep:
                out.append((kind, m.start(), m.end()))
    return out


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(docs):
    got = private_data(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(((d, *(sum(s[0] == k for s in base(t)) for k in KINDS), hashlib.sha256(told(base(t)).encode()).hexdigest()) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got), key=str) == want
    by_id = {}
    for d, t in rows:
        by_id.setdefault(d, []).append(t)
    for r in got:
        spans = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        spans = [(k, int(a), int(b)) for k, a, b in spans]
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) and len(spans) == len(set(spans))
        assert any(set(base(t)) <= set(spans) and len(spans) == len(base(t)) + r["n_added"] for t in by_id[r["doc_id"]])
    return got


def test_base_equals_plain_patterns_on_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_nulls_repeats_long_texts_and_hard_cases(spark):
    texts = [
        None, "", "no", "a@b.cd " * 300, "x@y@z.com a@b.c.@d.e .@. a@b..c -@-.- mailto:jo@x.org;ü@ö.de", "1.2.3.4.5.6.7.8 999.1.2.3.4 01.002.0003.255 0.0.0.0 1.2.3. 4",
        "4111 1111 1111 1111 12 4111-1111-1111-1111 4111111111111111x 4111  1111", "+1 (376) 555-1234 70.118.188.4 +1 2 3 +12345678 ++1 234 5678 +1+234567890", "9" * 6000, "1 2 " * 4000,
        "😀 a@b.cd 😀4111 1111 1111 1111é+1 222 333 4444", "a" * 30_000 + "@", "+1" + "(" * 6000, "1.1.1.1." * 600, "\n1.2.3.4\n+44 20 7946 0958\n",
    ]
    rows = [(k, t, 1, "z") for k, t in enumerate(texts)] + [(3, "dup a@b.cd", 2, "y")] * 2 + [(None, "q@r.st", 3, "x")]
    check(spark.createDataFrame(rows, "doc_id long, text string, kind int, base_spans string"))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert private_data(empty).collect() == []


def planted(rng, n):
    """Texts with phone numbers and cards that the base finds, numbers that aren't any, and some numbers that the base loses to a neighbour."""
    rows, lost = [], {}
    for d in range(n):
        area, line = rng.randint(200, 899), rng.randint(1000, 9999)
        phone = f"+1 ({area}) 555-{line}"
        kind = rng.random()
        if kind < 0.45:
            text = f"please call {phone} today, or write to b{d}@mail{d % 7}.example.org soon"
        elif kind < 0.9:
            text = f"order {rng.randint(10**9, 10**10)} of {rng.randint(10**6, 10**7)}-{rng.randint(100, 999)} shipped; part {rng.randint(1000, 9999)} {rng.randint(1000, 9999)} {rng.randint(100, 999)}"
        else:
            text = f"please call {phone} 70.118.{rng.randint(1, 255)}.{rng.randint(1, 255)} today"
            lost[d] = ("phone", 12, 12 + len(phone))
        rows.append((d, text))
    return rows, lost


def test_trees_add_what_the_base_loses_and_leave_other_numbers(spark):
    rows, lost = planted(random.Random(1), 1500)
    got = {r["doc_id"]: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    added = {d: set(r["spans"].split(",")) - {told([s]) for s in base(rows[d][1])} for d, r in got.items() if r["n_added"]}
    assert all(any(s.startswith("phone") for s in spans) for spans in added.values())
    assert sum(told([lost[d]]) in added.get(d, ()) for d in lost) >= 0.9 * len(lost)
    assert len(set(added) - set(lost)) <= 0.01 * len(rows)


def test_redaction_merges_overlaps_and_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd or +1 222 333 4444.", "k"), (2, None, "l"), (3, "none", "m")], "doc_id long, text string, private_spans string")
    found = find_private(docs)
    assert found.columns == ["doc_id", "text", "base_spans", "private_spans"]
    assert {r["doc_id"]: r["t"] for r in found.select("doc_id", redacted(found).alias("t")).collect()} == {1: "mail [email] or [phone].", 2: None, 3: "none"}
    span = "array<struct<kind:int,start:bigint,end:bigint>>"
    both = spark.createDataFrame([("0123456789", [(2, 2, 6), (3, 4, 8), (1, 9, 10)])], f"text string, private_spans {span}")
    assert both.select(redacted(both)).first()[0] == "01[card]8[ip]"


def test_calibration_rises(spark):
    assert calibrated([(0, 1, 2), (1, 0, 4), (2, 3, 4), (3, 4, 4)]) == [(0, 1, 6), (2, 3, 4), (3, 4, 4)]


def test_stays_in_the_jvm(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = find_private(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert redacted(find_private(docs)) is not None and F is not None
