import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from barloom.llm.graph import components
from barloom.llm.near_dedup import _block_links, near_duplicates, superminhash

SCHEMA = "doc_id long, text string, hashes string"


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent=80):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((r[0], len(shingles(r[1], k)), None if r[0] is None else find(r[0])) for r in rows if r[0] is not None)


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 9, 40, 120]))]
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((n, " ".join(words), "x"))
            n += 1
    core = [rng.choice(vocab) for _ in range(60)]
    for _ in range(70):  # copies that are near the threshold of each other
        words = list(core)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((n, " ".join(words), "x"))
        n += 1
    shared = [rng.choice(vocab) for _ in range(60)]
    for _ in range(60):  # a passage that many hold, below the threshold
        rows.append((n, " ".join([rng.choice(vocab) for _ in range(25)] + shared), "x"))
        n += 1
    rng.shuffle(rows)
    return rows + [(9001, None, None), (9002, "", None), (9003, " \t\n", None), (9004, "One Two", None), (9005, "one two", None), (None, "one two", None)]


def test_groups_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    for block in (4096, 4):
        got = near_duplicates(df, shingle=4, block=block).where("doc_id is not null").collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_ids_repeated_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e", "x"), (5, "a b c d e", "x"), (5, "p q r s t", "x"), (3, "p q r s t", "x"), (2, "A B C D E", "x"), (2, "A B C D E", "x")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, None), (5, 2, False), (3, 2, False), (2, 2, True)}
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def framed(n, seed=4):
    """Sets that share a frame, at 0.55 to 0.75 of each other, and for each tenth a near copy."""
    rng = np.random.default_rng(seed)
    frame = rng.integers(1, 2**63, 700, dtype=np.uint64)
    sets = []
    for i in range(n):
        if i % 10 == 9:
            sets.append(np.unique(np.append(sets[-1][:-5], rng.integers(1, 2**63, 5, dtype=np.uint64))))
        else:
            sets.append(np.unique(np.append(rng.permutation(frame)[:680], rng.integers(1, 2**63, int(rng.integers(140, 240)), dtype=np.uint64))))
    return sets


def test_sets_with_a_common_frame_cost_no_comparisons():
    counts = {}
    for n in (500, 1000, 2000):
        sets, compared, got = framed(n), [], set()
        sample = [(len(np.intersect1d(sets[i], sets[j])), i, j) for i, j in [(0, 1), (5, 77), (123, 456)]]
        assert all(0.5 < c / (len(sets[i]) + len(sets[j]) - c) < 0.78 for c, i, j in sample)
        for at in range(0, n, 512):  # blocks of askers against all, as the cells of a group
            rows = [(1, False, i, i, sets[i]) for i in range(at, min(at + 512, n))] + [(1, True, i, i, x) for i, x in enumerate(sets)]
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            columns = [[r[k] if k < 4 else r[k].tobytes() for r in rows] for k in range(5)]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cell", "member", "id", "root", "hashes"])
            for out in _block_links(80, compared)(iter([batch])):
                got |= {(min(a, b), max(a, b)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
        assert got == {(i - 1, i) for i in range(9, n, 10)}
        counts[n] = len(compared)
    assert counts[2000] <= 2 * counts[1000] <= 4 * counts[500] and counts[2000] <= 2 * 200


def test_frames_match_brute_force_in_spark(spark):
    rng = random.Random(6)
    frame = [f"f{i}" for i in range(300)]
    rows = []
    for i in range(150):
        at = rng.randrange(250)
        words = frame[:at] + [f"o{i}x{k}" for k in range(rng.randint(60, 110))] + frame[at:]
        rows.append((2 * i, " ".join(words), None))
        if i % 10 == 0:
            rows.append((2 * i + 1, " ".join(words[:-3]), None))
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=4, block=32).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="needs the test tables")
def test_no_link_of_the_query_set_is_lost(spark):
    """Every document whose id is divisible by 20 against all rows, by whole sets."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=4).collect()}
    sets = {r.doc_id: shingles(r.text, 4) for r in docs.collect()}
    holders = defaultdict(list)
    for i, x in sets.items():
        for s in x:
            holders[s].append(i)
    links = kept = 0
    for i in sets:
        if i % 20 == 0:
            for j, both in Counter(j for s in sets[i] for j in holders[s]).items():
                if i != j and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    links, kept = links + 1, kept + (found[i] == found[j])
    assert links > 50 and kept == links


def test_signature_estimates_similarity_and_ignores_order():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    a, b = x[:2400], x[600:]
    s = superminhash([a, b, a[::-1].copy(), x[:1], x[:0]], 256)
    assert (s[0] == s[2]).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.1
    assert len(set(s[3] >> np.uint64(32))) == 256  # a single element offers each position another step


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))
    assert components(df.limit(0)).count() == 0
