"""Spelling variants against a plain search by deletions and wildcards."""

import random
import re
import zlib
from collections import Counter, defaultdict

from barloom.llm.spelling import damaged_words, spelling_forms, spelling_variants


def plain(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return forms({w: k for w, k in n.items() if len(w) >= 7 and k >= 2})


def forms(n):
    keys = defaultdict(set)
    for w in n:
        keys[w].add(w)
        for k in range(len(w)):
            keys[w[:k] + w[k + 1 :]].add(w)
            keys[w[:k] + "*" + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for key, words in keys.items():
        for a in words:
            near[a] |= {b for b in words if a != b and ("*" in key or abs(len(a) - len(b)) == 1)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_equals_a_plain_search_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = rows_of(spelling_variants(docs))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert any(v[3] for v in got.values())


def test_blocks_in_parts_and_long_chains(spark):
    rng = random.Random(3)
    words = {}
    for _ in range(400):
        words["".join(rng.choice("abé") for _ in range(rng.randint(7, 9)))] = rng.choice([2, 3, 20, 30, 200, 2000])
    words |= {"a" * 3000: 2, "a" * 3001: 30, "b" + "a" * 3000: 400, "aaaaaaab": 5}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = forms(words)
    assert max(len({w, v[0], v[1]} - {None}) for w, v in want.items()) == 3
    for block_words, gram_rows in ((4096, 512), (16, 8), (3, 2)):
        assert rows_of(spelling_forms(table, block_words=block_words, gram_rows=gram_rows)) == want


def test_damage_nulls_ties_and_clashing_columns(spark):
    text = "Kitchens Étagere kitchensĀkitchens 123kitchens, ×letters " * 3 + "lettersx " * 2
    rows = [(d, text, "form", 1) for d in (1, 2, 2, None, None)] + [(5, None, "x", 2), (6, "", "x", 2), (None, "m" * 50_000 + " " + "m" * 50_000, "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = rows_of(spelling_variants(docs))
    assert got == plain([r[:2] for r in rows])
    assert "m" * 50_000 in got
    assert "Étagere" in got  # only A-Z are lower-cased
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rows_of(spelling_variants(empty)) == {}
    assert rows_of(spelling_forms(spark.createDataFrame([("smaller", 9), (None, 4), ("small", 3)], "word string, n long"))) == {
        "smaller": (None, "smaller", 9, 0, None), "small": (None, "small", 3, 0, None),
    }


def test_ties_take_the_smallest_word(spark):
    table = spark.createDataFrame([("letters", 2), ("letterz", 20), ("éetters", 20), ("lettera", 20)], "word string, n long")
    got = rows_of(spelling_forms(table))
    assert got["letters"] == ("lettera", "lettera", 2, 3, 20)
    assert got["lettera"][:2] == (None, "lettera")


def test_counts_are_of_all_texts(spark):
    docs = spark.createDataFrame([(k, "kitchens") for k in range(5000)], "doc_id long, text string").repartition(7)
    n = {r["word"]: r["n"] for r in damaged_words(docs).collect()}
    assert sum(n.values()) == 5000
