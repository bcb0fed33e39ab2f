"""Repaired conversations against a plain walk over all edits."""

import hashlib
import random
import re
import zlib
from functools import cache

from pyspark.sql import functions as F

from barloom.llm.conversations import damaged, repair, repair_conversations, repaired_conversations, repaired_turns

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """Least (cost, audit) over all edits, at most two insertions between rows; states: 0 begin, 1 after s, 2 user or end, 3 assistant."""

    @cache
    def go(i, state, inserted):
        onward = 2 if state == 3 else 3
        found = [(0, "")] if i == len(rows) and state in (0, 2) else []
        steps = [(3, "I", i, onward, inserted + 1)] if inserted < 2 else []
        if i < len(rows):
            steps.append((4, "D", i + 1, state, 0))
            late, initial = 3 * rows[i].isupper(), rows[i].lower()
            if initial != "-":
                fits = initial == ("a" if state == 3 else "u")
                steps.append((late + 3 * (not fits), "K" if fits else "R", i + 1, onward, 0))
                if state == 0 and initial == "s":
                    steps.append((late, "K", i + 1, 1, 0))
        for cost, edit, *to in steps:
            if rest := go(*to):
                found.append((cost + rest[0], edit + rest[1]))
        return min(found, default=None)

    return go(0, 0, 0)


def plain(rows):
    """Rows (conv_id, turn, role, text) -> a tuple of COLUMNS for each conversation."""
    out = []
    for conv in {r[0] for r in rows}:
        left = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            dice = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
            left += [(turn, "user" if dice == 4 else role, text)] * {0: 0, 3: 2}.get(dice, 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        letters, faults, seen = "", [0, 0, 0], set()
        for _, role, text in left:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "-" if fault in (0, 1) else initial.upper() if fault == 2 else initial
            if fault is not None:
                faults[fault] += 1
        cost, audit = cheapest(letters)
        length, lines, at = sum(e != "D" for e in audit), [], iter(left)
        for edit in audit:
            due = ["user", "assistant"][(len(lines) - length % 2) % 2]
            row = None if edit == "I" else next(at)
            if edit != "D":
                lines.append(f"{due}:" if edit == "I" else f"{row[1] if edit == 'K' else due}:{row[2]}")
        turns = [r[0] for r in left if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:], strict=False))
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_alignments_of_both_kinds_equal_all_edits():
    rng = random.Random(11)
    for k in range(2500):
        rows = "".join(rng.choice("suuaaxSUAX--") for _ in range(rng.randint(0, 10)))
        assert repair(rows) == repair(rows, aligned_rows=-1) == cheapest(rows), rows
    for n in (60, 150):
        rows = "".join(rng.choice("uuaaUA-sx") if rng.random() < 0.3 else "ua"[k % 2] for k in range(n))
        assert repair(rows) == repair(rows, aligned_rows=-1) == cheapest(rows)


def test_equals_plain_edits_on_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()])
    assert rows_of(repaired_conversations(turns)) == want
    # texts beyond what is held are hashed by a pass of their own, long conversations repaired by parity
    assert rows_of(repair_conversations(damaged(turns), held_chars=600, aligned_rows=2)) == want


def test_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(600):
        role = rng.choice(["user", "assistant", "system", "tool", "", None])
        text = rng.choice(["Yes.", "No!", "why", " \t", "", None, "ü?  ", "one. two", "long " * 50])
        rows.append((rng.choice([None, 1, 2, 3, *range(40)]), rng.choice([None, 0, 1, 2, 5, 9]), role, text, "x", 1))
    rows += [(900, t, "user", "same.", "x", 1) for t in range(60)] + [(901, 0, "assistant", "word " * 200_000, "y", 2)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, copies int")
    got = rows_of(repaired_conversations(table))
    assert got == plain([r[:4] for r in rows])
    assert rows_of(repair_conversations(damaged(table), held_chars=100)) == got
    empty = spark.createDataFrame([], table.schema)
    assert rows_of(repaired_conversations(empty)) == []


def test_conversations_of_which_nothing_is_left_stay(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id int, turn int, role string, text string")
    assert rows_of(repaired_conversations(table)) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_have_the_digests(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = damaged(turns)
    repairs = repair_conversations(rows)
    lines = repaired_turns(rows, repairs).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", F.concat("role", F.lit(":"), "text").alias("line")))).alias("lines"))
    joined = repairs.join(lines, "conv_id", "left").select("audit", "repaired_sha256", F.sha2(F.coalesce(F.array_join("lines.line", "\n"), F.lit("")), 256).alias("digest"))
    rows = joined.collect()
    assert rows and all(r["digest"] == r["repaired_sha256"] for r in rows)
