import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from barloom.llm.packing import TokenBytes, WholeTexts, best_fit, bin_completion, encoder_of, pack_documents

PATH = "/opt/tokenizers/word_bpe_49k.json"


def check_plan(counts, plan, room):
    used = {}
    for times, filling in plan:
        assert times > 0 and sum(length * k for length, k in filling.items()) <= room
        for length, k in filling.items():
            used[length] = used.get(length, 0) + k * times
    assert used == {length: n for length, n in counts.items() if n}


def plain_best_fit(counts, room):
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fit = [g for g in gaps if g >= length]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - length)
        else:
            gaps.append(room - length)
    return len(gaps)


def test_plans_are_whole_and_no_worse_than_best_fit():
    rng = random.Random(5)
    for trial in range(60):
        room = rng.choice([10, 30, 100, 2048])
        counts = {rng.randint(1, room): rng.randint(1, 30) for _ in range(rng.randint(1, 40))}
        fit, plan = best_fit(counts, room), bin_completion(counts, room, nodes=400)
        check_plan(counts, fit, room)
        check_plan(counts, plan, room)
        assert sum(t for t, _ in fit) == plain_best_fit(counts, room), trial
        assert -(-sum(x * n for x, n in counts.items()) // room) <= sum(t for t, _ in plan) <= sum(t for t, _ in fit)


def optimum(counts, room):
    """The least number of sequences, by trying every place for every piece."""
    items = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)
    best = len(items)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(items):
            best = len(gaps)
            return
        for gap in set(g for g in gaps if g >= items[i]):
            k = gaps.index(gap)
            go(i + 1, [*gaps[:k], gap - items[i], *gaps[k + 1 :]])
        go(i + 1, [*gaps, room - items[i]])

    go(0, [])
    return best


def test_completion_beats_best_fit_and_is_the_least_possible_on_small_tables():
    counts = {49: 1, 40: 1, 38: 1, 35: 2, 34: 1, 22: 1, 17: 1, 15: 1, 14: 1}  # 299 in rooms of 100
    plan = bin_completion(counts, 100)
    check_plan(counts, plan, 100)
    assert sum(t for t, _ in plan) == 3 < sum(t for t, _ in best_fit(counts, 100)) == 4
    many = {length: 50 * n for length, n in counts.items()}
    plan = bin_completion(many, 100)
    check_plan(many, plan, 100)
    assert sum(t for t, _ in plan) < sum(t for t, _ in best_fit(many, 100))
    rng, better = random.Random(3), 0
    for _ in range(150):
        room, counts = rng.choice([20, 50, 100]), {}
        for _ in range(rng.randint(6, 11)):
            x = rng.randint(room // 7, room // 2)
            counts[x] = counts.get(x, 0) + 1
        plan, fit = bin_completion(counts, room, width=40), best_fit(counts, room)
        check_plan(counts, plan, room)
        assert sum(t for t, _ in plan) == optimum(counts, room)
        better += sum(t for t, _ in plan) < sum(t for t, _ in fit)
    assert better > 3
    assert bin_completion({}, 10) == []


def test_vocabularies_of_other_rules_encode_whole_texts(spark):
    from tokenizers import Tokenizer

    other = PATH.replace("word_bpe_49k", "byte_bpe_50k")
    assert type(encoder_of(Path(PATH).read_text())) is TokenBytes and type(encoder_of(Path(other).read_text())) is WholeTexts
    whole = Tokenizer.from_file(other)
    rows = [(1, "Hello big World"), (2, "a  b\n\nC"), (3, None)]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), other).collect()}
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items()} and ids[1][:2] == [15496, 1263]


@pytest.fixture(scope="module")
def tokens():
    return TokenBytes(Path(PATH).read_text())


def test_chunked_ids_equal_whole_text_ids(tokens):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    for text in ["", "Hello  world\n\nIt's 12 o'clock!!", "Straße ΣΑΣ ΌΣΟΣ é ́x", "a\tb\x0bc\x85d e f", "<|endoftext|> <|startoftext|>x", "漢字かな 🙂🙂 '' 's", "İstanbul 가 x̧́"]:
        assert np.frombuffer(tokens.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_fill_sequences_without_gaps(spark, tokens):
    rng = random.Random(1)
    words = ["alpha", "Beta", "gam", "delta!", "12", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 40, 90, 400]))), None) for i in range(300)]
    rows += [(None, None, "x"), (400, "", "x"), (5, "same", "x"), (5, "same", "x"), (401, "word " * 20_000, "x")]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, piece string"), PATH, room=256).collect()
    ids = {}
    for doc, text, _ in rows:
        ids.setdefault(doc, []).append(tokens.of(text or "") + b"\0\0\0\0")
    held = {}
    for r in got:
        assert any(zlib.crc32(x[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for x in ids[r.doc_id]) and r.start == 256 * r.piece
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) // 4 for xs in ids.values() for x in xs)
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 256
    assert len(held) <= sum(r.length for r in got) / 256 * 1.05 + 1
    assert pack_documents(spark.createDataFrame(rows, "doc_id long, text string, piece string").limit(0), PATH).count() == 0
