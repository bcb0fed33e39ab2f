"""Each stage of the pipeline, and all of them, on odd rows against plain Python."""

import math
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline as P
from barloom.llm.common import WordHashes
from barloom.llm.mixing import MIX_SQL
from barloom.llm.packing import TokenBytes
from barloom.llm.quality import BITS, features

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed string, score string, copies string"


def doc(i, text, source="web"):
    return (i, text, "en", source, len(text or ""), f"r{i}", "s", None)


def corpus():
    rng = random.Random(4)
    words = lambda k: " ".join(f"w{rng.randrange(4000)}" for _ in range(k))
    rows = [doc(i, words(rng.randint(30, 120)), ["web", "books", None][i % 3]) for i in range(120)]
    passage = words(70)
    rows += [doc(200 + i, f"{words(40)} {passage} {words(40)}") for i in range(5)]  # a passage that repeats
    rows += [doc(300 + i, rows[i][1] + f" and {i}") for i in range(6)] + [doc(310, rows[9][1])]  # near and exact copies
    rows += [doc(None, rows[11][1]), doc(None, words(60)), doc(None, words(50)), doc(7, words(90)), doc(7, rows[7][1])]  # null and repeated ids
    rows += [doc(400, None), doc(401, ""), doc(402, " \n\t"), doc(403, words(30_000))]
    bad = [doc(500 + i, " ".join(["BUY NOW!!"] * rng.randint(10, 40))) for i in range(60)]
    return rows, bad


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, bad = corpus()
    base = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows + bad, SCHEMA).write.parquet(f"{base}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows[:120]] + [(r[0], 0, 0) for r in bad] + [(None, 0, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, rows, bad


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_quality_rejects_what_is_labelled_so_and_keeps_the_rest_whole(spark, tables):
    base, rows, bad = tables
    got = P.quality(spark, frame(spark, rows + bad), base)
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    got = sorted(map(repr, map(tuple, got.collect())))
    clean = sorted(repr(r) for r in rows if r[1] and r[1].strip())
    assert set(clean) <= set(got) <= {repr(r) for r in rows}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup_keeps_one_of_each_group(spark, tables):
    base, rows, _ = tables
    got = [tuple(r) for r in P.near_dedup(spark, frame(spark, rows), base).collect()]
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    assert len(got) == len(groups)
    for members in groups.values():
        known = [m[0] for m in members if m[0] is not None]
        assert sum(m in got for m in members) >= 1
        assert not known or any(g[0] == min(known) and g in members for g in got)


def test_substring_dedup_leaves_a_passage_in_its_first_text(spark, tables):
    base, rows, _ = tables
    got = {r.doc_id: r for r in P.substring_dedup(spark, frame(spark, [r for r in rows if r[0] is not None and r[0] != 7 and not 300 <= r[0] <= 310]), base).collect()}
    texts = {r[0]: r[1] for r in rows}
    for i, r in got.items():
        assert r.n_chars == len(r.text or "") and (r.removed, r.score) == (f"r{i}", "s")
        if i in (201, 202, 203, 204):
            assert 80 <= len(r.text.split()) <= 80 + 30 and texts[i].startswith(r.text[:100])
        else:
            assert r.text == texts[i]
    assert {400, 401, 402, 403, 200} <= set(got)
    copies = [doc(1, "a b c " * 20), doc(2, "a b c " * 20)]
    assert [r.doc_id for r in P.substring_dedup(spark, frame(spark, copies), base).collect()] == [1]


def test_mix_takes_what_its_sql_takes(spark, tables):
    base, rows, _ = tables
    df = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = {}
    for doc_id, _, _, _, _, copies, _ in con.execute(MIX_SQL).fetchall():
        want[doc_id] = want.get(doc_id, 0) + copies
    got = P.mix(spark, df, base)
    assert got.columns == df.columns
    taken = {}
    for r in got.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert taken == {k: v for k, v in want.items() if v}


def placed(pieces):
    held = {}
    for r in pieces:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    return len(held)


def test_run_is_its_stages_one_after_another(spark, tables):
    base, rows, bad = tables
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, base).collect(), docs.schema)
    final = P.run(spark, base).collect()
    tokens = TokenBytes(open(P.public_tokenizers.path("word_bpe_49k.json")).read())
    sizes = sorted(len(tokens.of(r.text or "")) // 4 + 1 for r in docs.collect())
    assert sum(sizes) == sum(r.length for r in final)
    assert placed(final) <= math.ceil(sum(sizes) / 2048) + 1
    assert not {r.doc_id for r in final} & {r[0] for r in bad} and {0, 1, 2, 200} & {r.doc_id for r in final}


def test_empty_tables_pass_through_every_stage(spark, tables):
    base, rows, _ = tables
    for _, stage in P.STAGES:
        assert stage(spark, frame(spark, []), base).count() == 0


def test_training_matches_a_plain_loop(spark):
    """Follow the regularised leader over dense weights, a feature at a time."""
    from barloom.llm.quality import train

    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["good", "fine", "well"] if i % 2 else ["bad", "poor", "ill", "bad"]) for _ in range(rng.randint(1, 9)))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, label int")
    got = train(docs, marks, epochs=2)
    import pyspark.sql.functions as F

    order = [r.doc_id for r in marks.select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)).alias("draw")).orderBy("draw").collect()]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    z, n, hashes, by_id = {}, {}, WordHashes(), dict(texts)

    def weight(k):
        v, s = z.get(k, 0.0), n.get(k, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(s)) / alpha + l2)

    for _ in range(2):
        for i in order:
            counts = {}
            for k in features(by_id[i].encode(), hashes).tolist():
                counts[k] = counts.get(k, 0) + 1
            norm = max(1.0, math.sqrt(sum(counts.values())))
            x = {k: math.sqrt(c) / norm for k, c in counts.items()} | {1 << BITS: 1.0}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[k] * v for k, v in x.items())))))
            for k, v in x.items():
                g = (p - i % 2) * v
                s = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(s + g * g) - math.sqrt(s)) / alpha * w[k]
                n[k] = s + g * g
    want = np.zeros((1 << BITS) + 1)
    for k in z:
        want[k] = weight(k)
    assert np.allclose(got, want, atol=1e-9) and (got != 0).sum() > 10
