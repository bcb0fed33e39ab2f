import random

import duckdb

from barloom.llm.licenses import TEMPLATES, anchors, license_sql, scan_licenses, shingles_of, words_of
from barloom.llm.sharding import shard_documents, shard_sql

SCHEMA = "doc_id long, text string, shard string, license string"


def same(df, sql, documents):
    con = duckdb.connect()
    con.register("documents", documents.toArrow())
    want, got = con.execute(sql).fetchall(), [tuple(r) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


def rows():
    rng = random.Random(2)
    out = [(i, "x" * rng.choice([0, 1, 50, 300, 900]), "s", None) for i in range(300)]
    return out + [(None, None, None, None), (500, "y" * 5000, None, None), (7, "same row" * 20, None, None)] + [(9, "dup" * 100, None, None)] * 12


def test_every_shard_fits_and_none_splits_early(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for limit in (1000, 10_000, 10**9):
        got = same(shard_documents(df, limit), shard_sql(limit), df)
        held = {}
        for doc, n, shard, depth, size, count, oversize in got:
            held.setdefault(shard, []).append(n)
            assert size <= limit or (oversize and count == 1)
        assert {s: sum(x) for s, x in held.items()} == {r[2]: r[4] for r in got}
    assert shard_documents(df.limit(0), 10).count() == 0


def test_deep_splits_go_on_alone(spark):
    df = spark.createDataFrame([(i, "ab", None, None) for i in range(40)], SCHEMA)
    got = same(shard_documents(df, 2, broadcast_cells=1), shard_sql(2), df)
    assert len({r[2] for r in got}) == 40


def test_anchor_words_cover_more_than_may_be_missing():
    chosen = anchors(TEMPLATES, 80)
    for text in TEMPLATES.values():
        shingles = shingles_of(words_of(text))
        missing = sum(not any(w in chosen for w in s.split()) for s in shingles)
        assert 100 * missing < 80 * len(shingles) or not shingles


def test_scan_matches_brute_force_sql(spark):
    rng = random.Random(8)
    vocab = ["alpha", "license", "version", "under", "the", "software", "of"]
    out = []
    for i in range(120):
        parts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(list(TEMPLATES.values())).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = "changed"
            parts.insert(rng.randint(0, 3), " ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
        out.append((i, "\n".join(parts), "s", "l"))
    out += [(None, TEMPLATES["mit"], None, None), (200, None, None, None), (201, "", None, None), (202, "mit license", None, None), (3, TEMPLATES["mit-notice"], None, None), (204, "the license " * 30_000 + TEMPLATES["gpl-3.0-notice"], None, None)]
    df = spark.createDataFrame(out, SCHEMA)
    got = same(scan_licenses(df), license_sql(), df)
    assert {r[1] for r in got} >= {"mit", "gpl-3.0-notice", "apache-2.0"} and (204, "gpl-3.0-notice") in {r[:2] for r in got}
    assert scan_licenses(df.limit(0)).count() == 0


def test_rows_that_share_an_id_make_no_window_together(spark):
    words = TEMPLATES["mit-notice"].split()
    half = len(words) // 2
    rows = [(1, " ".join(words[:half]), None, None), (1, " ".join(["x"] * half + words[half:]), None, None), (2, " ".join(words), None, None), (2, "again " + " ".join(words), None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = same(scan_licenses(df), license_sql(), df)
    assert {r[0] for r in got if r[1] == "mit-notice"} == {2}


def test_templates_of_under_five_words_are_found_whole(spark):
    rights = ["all", "rights", "reserved"]
    texts = ["All rights reserved.", "a b\nALL RIGHTS\nreserved!", "all rights are reserved", "overall rights reserved", "all rights reservedly", "x all rights reserved all rights reserved", "", None, "rights"]
    texts += [f"word {TEMPLATES['mit']} All rights reserved."]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(5, "all rights reserved", None, None), (None, "© all rights reserved", None, None)]
    want = {}
    for doc, text, _, _ in rows:
        words = words_of(text or "")
        for k in range(len(words) - 2):
            if words[k : k + 3] == rights:
                want[doc] = min(want.get(doc, k), k)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scan_licenses(df).collect()
    assert {(r.doc_id, r.window_start) for r in got if r.license == "all-rights-reserved"} == set(want.items()) and len(want) == 5
    assert all((r.n_shingles, r.n_shared, r.containment) == (1, 1, 1.0) for r in got if r.license == "all-rights-reserved")
    plain = [tuple(r) for r in scan_licenses(df, {k: v for k, v in TEMPLATES.items() if k != "all-rights-reserved"}).collect()]
    assert sorted(map(repr, plain)) == sorted(repr(tuple(r)) for r in got if r.license != "all-rights-reserved") and plain
    only = scan_licenses(df, {"all-rights-reserved": "All rights reserved."}).collect()
    assert len(only) == 5
