import random
import re

import numpy as np

from barloom.llm.common import WordHashes
from barloom.llm.substring_dedup import dedup_passages, repeated_units, units, words_of

SCHEMA = "doc_id long, text string, removed string"


def grams(text, n):
    spans = [m.span() for m in re.finditer(r"\S+", text or "")]
    words = (text or "").lower().split()
    return spans, {k: " ".join(words[k : k + n]) for k in range(len(words) - n + 1)}


def long_lines(text, least):
    at = 0
    for line in (text or "").splitlines(keepends=True):
        if len(line.split()) >= least:
            yield at, at + len(line), " ".join(line.lower().split())
        at += len(line)


def bounds(rows, passage=24, spread=16, line=3):
    """For each text in order of id: characters that must go, and those that may, by comparing runs of words with those of the texts before."""
    long_before, short_before, lines_before, out = set(), set(), set(), {}
    for doc, text, _ in sorted(rows, key=lambda r: r[0]):
        must, may = np.zeros(len(text or ""), bool), np.zeros(len(text or ""), bool)
        spans, whole = grams(text, passage + spread - 1)
        for k, words in whole.items():
            if words in long_before:
                inner = spans[k + spread - 1 : k + passage]
                must[inner[0][0] : inner[-1][1]] = True
        seen = {}
        _, part = grams(text, passage)
        for k, words in part.items():
            if words in short_before or k - seen.setdefault(words, k) >= passage:
                may[spans[k][0] : spans[k + passage - 1][1]] = True
        own = set()
        for a, b, words in long_lines(text, line):
            if words in lines_before:
                must[a:b] = may[a:b] = True
            if words in own:
                may[a:b] = True
            own.add(words)
        # a paragraph of lines that an earlier text has is a unit of its own, so blocks of lines may go too
        long_before |= set(whole.values())
        short_before |= set(part.values())
        lines_before |= own
        out[doc] = (must, may)
    return out


def corpus():
    rng = random.Random(2)
    passages = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 20, 45, 60, 150]))) for _ in range(40)]
    rows = []
    for i in range(200):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(f"own{i}x{k}y{j}" for j in range(rng.randint(1, 30))) for k in range(rng.randint(0, 10))]
        rows.append((i, "".join(p + rng.choice([" ", "\n", "  \n", "\n\n"]) for p in parts), "x"))
    rng.shuffle(rows)
    return rows + [(501, "", None), (504, "ünï ".upper() * 40_000, None), (505, "Ünï\t" * 40_000, None)]


def test_between_what_must_and_what_may_go(spark):
    rows = corpus()
    rng = random.Random(3)
    line = " ".join(f"l{k}" for k in range(24))
    rows += [(300 + i, f"before {i}\n{line.upper() if i % 2 else line}  \nafter {rng.random()}", None) for i in range(5)]
    got = dedup_passages(spark.createDataFrame([*rows, (500, None, None)], SCHEMA), line_docs=2).collect()
    assert len(got) == len(rows) + 1
    want, texts, cut = bounds(rows), {r[0]: r[1] for r in rows}, 0
    for r in got:
        if r.doc_id == 500:
            assert r.text is None and r.removed == []
            continue
        text, (must, may) = texts[r.doc_id], want[r.doc_id]
        gone = np.zeros(len(text), bool)
        for g in r.removed:
            gone[g.start : g.end] = True
        assert r.text == "".join(c for c, k in zip(text, gone, strict=True) if not k)
        assert "".join(text[s.start : s.end] for s in r.kept_spans) == r.text
        assert not (must & ~gone).any(), r.doc_id
        visible = np.array([not c.isspace() for c in text], bool)
        assert not (gone & ~may & visible).any(), r.doc_id
        assert all(g.first_id <= r.doc_id for g in r.removed)
        cut += bool(r.removed)
    assert cut > 80


def test_hot_digests_are_found_in_place_alike(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    plain = sorted(map(tuple, repeated_units(df).collect()))
    monkeypatch.setattr("barloom.llm.common.HOT_ROWS", 3)
    monkeypatch.setattr("barloom.llm.common.HOT_SHARE", 1 << 40)
    assert sorted(map(tuple, repeated_units(df).collect())) == plain and plain


def test_null_and_repeated_ids(spark):
    line, other = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(None, line, None), (3, line, None), (3, line, None), (3, f"x y.\n{line}\nz", None), (4, f"{line.upper()}\nRest stays.", None), (None, other, None), (None, other, None), (None, f"{other}\nend", None)]
    got = sorted((str(r.doc_id), r.text) for r in dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got[:4] == [("3", line), ("3", line), ("3", f"x y.\n{line}\nz"), ("4", "Rest stays.")]
    # of null ids the least text, by its hash, keeps what several hold; what an id holds goes; equal texts stay alike
    assert got[4] == ("None", "") and got[5:] in ([("None", ""), ("None", ""), ("None", f"{other}\nend")], [("None", other), ("None", other), ("None", "end")])
    assert dedup_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_document_that_repeats_itself_keeps_a_whole_first_copy(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"{passage} between {passage}", None), (2, "again. " * 200, None)]
    got = {r.doc_id: r.text for r in dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].startswith(f"{passage} between") and len(got[1].split()) < 61 + 32
    assert 24 <= len(got[2].split()) < 200


def test_short_lines_go_where_enough_texts_hold_them(spark):
    lines = ["All rights reserved.", "Share this page now"]
    rows = [(i, "\n".join([f"own a{i}", lines[0], f"b{i}", *lines[1 : 1 + (i < 3)], f"d{i}"]), None) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    few = {r.doc_id: r.text for r in dedup_passages(df).collect()}
    every = {r.doc_id: r.text for r in dedup_passages(df, line_docs=2).collect()}
    assert few[0] == every[0] == rows[0][1]
    for i in range(1, 6):
        assert every[i].split() == f"own a{i} b{i} d{i}".split()
        assert few[i].split() == (f"own a{i} b{i} Share this page now d{i}" if i < 3 else f"own a{i} b{i} d{i}").split()
    assert {r.doc_id: r.text for r in dedup_passages(df, line_words=24).collect()} == {r[0]: r[1] for r in rows}


def test_repeated_short_lines_of_the_documents(spark):
    """Lines of under 24 words that an earlier document holds, counted by whole lines alone: which of them are cut."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    holders, places = {}, []
    for r in docs.orderBy("doc_id").collect():
        at = 0
        for line in (r.text or "").split("\n"):
            words = line.lower().split()
            if 0 < len(words) < 24:
                holders.setdefault(" ".join(words), set()).add(r.doc_id)
                places.append((r.doc_id, at + len(line) - len(line.lstrip()), at + len(line.rstrip()), " ".join(words)))
            at += len(line) + 1
    later = [p for p in places if p[0] != min(holders[p[3]])]
    assert len(later) > 1000

    def stays(**kwargs):
        gone = {r.doc_id: [(g.start, g.end) for g in r.removed] for r in dedup_passages(docs, **kwargs).collect()}
        for doc, start, end, line in later:
            covered = np.zeros(end - start, bool)
            for a, b in gone[doc]:
                covered[max(a - start, 0) : max(b - start, 0)] = True
            if not covered.all():
                yield len(line.split()), len(holders[line])

    assert not list(stays(line_words=1, line_docs=2))
    common = sum(3 <= len(line.split()) and len(holders[line]) >= 5 for _, _, _, line in later)
    assert common > 400 and sum(words >= 3 and texts >= 5 for words, texts in stays()) <= 0.05 * common


def test_extra_columns_of_any_name_pass_through(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "z", 1.5), (2, "d e f", 6, "y", 2.5)], "doc_id long, text string, kept_spans int, one string, start double")
    got = dedup_passages(docs)
    assert got.columns == ["doc_id", "text", "one", "start", "removed", "kept_spans"]
    assert sorted((r.doc_id, r.text, r.one, r.start) for r in got.collect()) == [(1, "a b c", "z", 1.5), (2, "d e f", "y", 2.5)]


def test_words_of_scripts_without_spaces(spark):
    words, starts, ends = words_of("Ab 版权 c所　İx\n")
    assert words == ["ab", "版", "权", "c", "所", "İx".lower()] and starts.tolist() == [0, 3, 4, 6, 7, 9] and ends.tolist() == [2, 4, 5, 7, 8, 11]
    for text in ("", " ", "a", " a", "a ", "a\tb c", "x" * 70_000):
        words, starts, ends = words_of(text)
        assert words == text.split() and [text[a:b] for a, b in zip(starts, ends)] == words
    passage = "".join(chr(0x4E00 + 7 * k) for k in range(90))
    rows = [(1, f"first {passage} one", None), (2, f"other words {passage}。", None)]
    got = {r.doc_id: r.text for r in dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == rows[0][1] and len(got[2]) < len(rows[1][1]) - 50
    assert all(len(c) == 0 for c in units("a b", WordHashes()))
