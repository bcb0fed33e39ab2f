"""Conversations put back into a legal order of turns: rows are aligned with every alternating target that could be cheapest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable

#: What an edit costs: another role, a deletion, an inserted turn, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows up to which a conversation is aligned length by length, and characters of text that are held for one conversation.
ALIGNED_ROWS, HELD_CHARS = 200, 1 << 22
_FAR = 1 << 40
_BLANK = "[^\\x20\\x09-\\x0D]"
#: A row as one letter: its role's initial if it is s, u or a, else x; upper case if truncated; - if it has to go.
_LETTERS = "suax"


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows as the damage leaves them, those that it drops marked as gone.

    Null roles and texts, and null ids where the hash is taken, are one space. The hash is crc32 of `conv_id:turn` modulo 20:
    0 drops a row, 1 empties its text, 2 takes its `[.!?]`, 3 repeats it and 4 makes it the user's.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    dice = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumn("dice", dice)
    text = F.when(F.col("dice") == 1, "").when(F.col("dice") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("dice") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("dice") == 0).alias("gone"), F.when(F.col("dice") == 3, 2).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).drop("col")


def _lower(d: np.ndarray | int, truncated: int):
    """What it costs at least, over what the rows cost anyhow, to gain d letters of the target on the rows, or to lose -d of which some are truncated."""
    d = np.asarray(d)
    return np.where(d > 0, INSERT * d, -d * DELETE - np.minimum(-d, truncated) * TRUNCATED)


def _align(rows: str, length: int, most: int) -> tuple[int, str] | None:
    """Cheapest (cost, least audit) that turns rows into the target of this length for at most `most`; None where there is none.

    Wagner-Fischer over what is still to be done, row by row from the end. The diagonal d is the letter of the target
    less the rows so far that need not go; only diagonals that a path within `most` can use are held.
    """
    n, odd = len(rows), length % 2
    stay = np.array([c != "-" for c in rows])
    passed = np.concatenate([[0], np.cumsum(stay)])
    truncated = sum(c.isupper() for c in rows)
    spare = most - DELETE * (n - int(passed[-1])) - TRUNCATED * truncated
    over = length - int(passed[-1])
    d = np.arange(-n, max(spare, 0) // INSERT + 1)
    d = d[_lower(d, truncated) + _lower(over - d, truncated) <= spare]
    if not len(d) or not (d == 0).any() or not (d == over).any():
        return None
    slope = INSERT * np.arange(len(d))

    def with_inserts(base: np.ndarray, j: np.ndarray) -> np.ndarray:
        base[(j < 0) | (j > length)] = _FAR
        out = np.minimum.accumulate((base + slope)[::-1])[::-1] - slope
        if odd:  # a system turn is never inserted
            out[j == 0] = base[j == 0]
        return np.where(j < 0, _FAR, out)

    j = passed[n] + d
    table = [with_inserts(np.where(j == length, 0, _FAR), j)]
    for i in range(n - 1, -1, -1):
        after, j = table[-1], passed[i] + d
        if not stay[i]:
            base = after + DELETE
        else:
            late = TRUNCATED if rows[i].isupper() else 0
            initial = rows[i].lower()
            letter = (j - odd) % 2
            match = np.where((initial == "u") & (letter == 0) | (initial == "a") & (letter == 1), 0, REROLE)
            if odd:
                match = np.where(j == 0, 0 if initial == "s" else _FAR, match)
            base = after + match + late
            base[1:] = np.minimum(base[1:], after[:-1] + DELETE)
        table.append(with_inserts(base, j))
    table.reverse()
    at = int(np.flatnonzero(d == 0)[0])
    cost = int(table[0][at])
    if cost > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < length:  # the least letter that stays on a cheapest path: D, I, K, R
        left = int(table[i][at])
        if i < n and not stay[i]:
            if table[i + 1][at] + DELETE == left:
                audit.append("D")
                i += 1
                continue
        elif i < n and at > 0 and table[i + 1][at - 1] + DELETE == left:
            audit.append("D")
            i, at = i + 1, at - 1
            continue
        if j < length and not (odd and j == 0) and at + 1 < len(d) and table[i][at + 1] + INSERT == left:
            audit.append("I")
            j, at = j + 1, at + 1
            continue
        audit.append("K" if rows[i].lower() == target_letter(j, odd) else "R")
        i, j = i + 1, j + 1
    return cost, "".join(audit)


def target_letter(j: int, odd: int) -> str:
    """Letter j of the target: with odd length it begins with s, and goes on as u and a in turn."""
    return "s" if odd and j == 0 else "ua"[(j - odd) % 2]


def _by_lengths(rows: str) -> tuple[int, str]:
    best = (DELETE * len(rows), "D" * len(rows))
    stay = sum(c != "-" for c in rows)
    truncated = sum(c.isupper() for c in rows)
    base, step = DELETE * (len(rows) - stay) + TRUNCATED * truncated, 0
    while min(_lower(step, truncated), _lower(-step, truncated)) <= best[0] - base:
        for length in sorted({stay - step, stay + step}):
            if length > 1 and _lower(length - stay, truncated) <= best[0] - base:
                found = _align(rows, length, best[0])
                best = min(best, found) if found else best
        step += 1
    return best


def _by_parity(rows: str) -> tuple[int, str]:
    """The same for very long conversations: targets that end alike are one column, so a row has a cell for each parity.

    States: 0 nothing yet, 1 after the system turn, 2 a user turn is due or the end, 3 an assistant turn is due.
    """
    n = len(rows)
    left = np.full((n + 1, 4), _FAR, np.int64)
    left[n] = [0, 2 * INSERT, 0, INSERT]
    for i in range(n - 1, -1, -1):
        c, after = rows[i], left[i + 1].tolist()
        if c == "-":
            now = [DELETE + x for x in after]
        else:
            late, initial = TRUNCATED if c.isupper() else 0, c.lower()
            user, assistant = late + (initial != "u") * REROLE, late + (initial != "a") * REROLE
            now = [min(DELETE + after[s], (assistant + after[2]) if s == 3 else (user + after[3])) for s in range(4)]
            if initial == "s":
                now[0] = min(now[0], late + after[1])
        for _ in range(2):  # an insertion leads to the other parity, so two rounds settle
            now = [min(now[s], INSERT + (now[2] if s == 3 else now[3])) for s in range(4)]
        left[i] = now
    audit, i, s = [], 0, 0
    while i < n or s in (1, 3):
        here = int(left[i][s])
        onward = 2 if s == 3 else 3
        if i < n and left[i + 1][s] + DELETE == here:
            audit.append("D")
            i += 1
        elif left[i][onward] + INSERT == here:
            audit.append("I")
            s = onward
        else:
            late, initial = TRUNCATED if rows[i].isupper() else 0, rows[i].lower()
            if s == 0 and initial == "s" and left[i + 1][1] + late == here:
                onward, letter = 1, "K"
            else:
                letter = "K" if initial == ("a" if s == 3 else "u") else "R"
            audit.append(letter)
            i, s = i + 1, onward
    return int(left[0][0]), "".join(audit)


def repair(rows: str, aligned_rows: int = ALIGNED_ROWS) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows, given as letters; the audit is the least in ASCII among the cheapest."""
    return _by_lengths(rows) if len(rows) <= aligned_rows else _by_parity(rows)


class _Repairs(dict):
    """rows -> (cost, audit), for the short ones remembered."""

    def __init__(self, aligned_rows: int):
        super().__init__()
        self.aligned_rows = aligned_rows

    def of(self, rows: str) -> tuple[int, str]:
        if len(rows) > 64:
            return repair(rows, self.aligned_rows)
        if len(self) > 100_000:
            self.clear()
        if rows not in self:
            self[rows] = repair(rows, self.aligned_rows)
        return self[rows]


class _Digest:
    """SHA-256 of the repaired turns, fed row by row as the audit says."""

    def __init__(self, audit: str):
        self.hash, self.audit, self.at, self.j = hashlib.sha256(), audit, 0, 0
        self.odd = sum(c != "D" for c in audit) % 2

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.j else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.j += 1

    def _role(self) -> str:
        return {"u": "user", "a": "assistant"}[target_letter(self.j, self.odd)]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self._role(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self._role(), text)

    def hex(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


class _Conversation:
    """What is known of one conversation while its rows pass by in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.letters, self.held, self.size = conv_id, [], [], 0
        self.seen: set[bytes] = set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.turns, self.first, self.turn = 0, None, 0, None, None

    def add(self, turn: int | None, role: str, text: str, held_chars: int) -> None:
        if turn is not None and (self.turns == 0 or turn != self.turn):
            self.first = turn if self.turns == 0 else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]
        whole = f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
        mark = whole if len(whole) < 24 else hashlib.blake2b(whole, digest_size=24).digest()
        words = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not words else "duplicate" if mark in self.seen else "truncated" if words[-1] not in ".!?" else None
        self.seen.add(mark)
        if fault:
            self.faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        self.letters.append("-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        if self.held is not None:
            self.held.append((role, text))
            self.size += len(role) + len(text)
            if self.size > held_chars:
                self.held = None  # its digest is made by another pass, which holds no text

    def row(self, repairs: _Repairs) -> tuple:
        cost, audit = repairs.of("".join(self.letters))
        digest = None
        if self.held is not None:
            digest = _Digest(audit)
            for role, text in self.held:
                digest.row(role, text)
            digest = digest.hex()
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, audit, digest)


_KINDS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _emit(rows: list[tuple], names: list[str]):
    import pyarrow as pa

    kinds = [pa.string() if x in ("audit", "repaired_sha256") else pa.int64() for x in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _repairer(held_chars: int, aligned_rows: int):
    """Rows of a partition in order -> a row for each conversation."""
    names = [x.split()[0] for x in _KINDS.split(", ")]

    def run(batches: Iterator):
        repairs, now, out = _Repairs(aligned_rows), None, []
        for batch in batches:
            for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.row(repairs))
                    now = _Conversation(conv_id)
                if not gone:
                    now.add(turn, role, text, held_chars)
            if len(out) >= 500:
                yield _emit(out, names)
                out = []
        if now is not None:
            out.append(now.row(repairs))
        if out:
            yield _emit(out, names)

    return run


def _digests(batches: Iterator):
    """Rows of long conversations in order, each led by its audit -> (conv_id, repaired_sha256); no text is held."""
    now, conv, out = None, None, []
    for batch in batches:
        for conv_id, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if audit is not None:
                if now is not None:
                    out.append((conv, now.hex()))
                now, conv = _Digest(audit), conv_id
            else:
                now.row(role, text)
    if now is not None:
        out.append((conv, now.hex()))
    if out:
        yield _emit(out, ["conv_id", "repaired_sha256"])


def _in_order(rows: DataFrame, *first: str | Column) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def repair_conversations(rows: DataFrame, held_chars: int = HELD_CHARS, aligned_rows: int = ALIGNED_ROWS) -> DataFrame:
    """A row for each conv_id of rows (conv_id, turn, role, text, gone): its faults, the cheapest repair and the digest of what that gives.

    Rows marked gone only name their conversation. Order is by turn, nulls first, then role and text; equal rows are
    alike. A row's first fault counts: blank, duplicate (role and text seen before), truncated (does not end in `[.!?]`).
    Blank and duplicate rows have to go. Rows are aligned with the targets `(s?(ua)+)?`, one of each length that could still be cheapest,
    in the bands that the cheapest so far allows; of equally cheap repairs that with the least audit is taken. `gaps` are
    missing turn numbers between the least and the greatest, `illegal` counts neighbours whose initials aren't su, ua or au.

    A conversation is read in order by one task, as its digest is sequential, and of a long one (over held_chars characters) that
    task holds some 25 bytes a row: it is read once more for its digest, with no text held. Conversations of over aligned_rows rows are
    repaired with a cell for each parity of the rest in place of each length, to the same result.
    Null ids are one conversation; an empty table gives no rows.
    """
    sorted_ = _in_order(rows.select("conv_id", "turn", "role", "text", "gone"))
    found = durable(sorted_.mapInArrow(_repairer(held_chars, aligned_rows), _KINDS), "repairs")
    long_ = found.where("repaired_sha256 IS NULL").select(F.col("conv_id").alias("id"), "audit")
    texts = rows.where("NOT gone").join(long_, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
    led = texts.select("conv_id", "turn", F.lit(None).cast("string").alias("audit"), "role", "text").unionByName(
        long_.select(F.col("id").alias("conv_id"), F.lit(None).cast("long").alias("turn"), "audit", F.lit("").alias("role"), F.lit("").alias("text"))
    )
    hashed = _in_order(led, F.col("audit").isNull()).select("conv_id", "audit", "role", "text").mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    missing = found.where("repaired_sha256 IS NULL").drop("repaired_sha256").alias("f").join(hashed.alias("h"), F.col("f.conv_id").eqNullSafe(F.col("h.conv_id"))).select("f.*", "h.repaired_sha256")
    return found.where("repaired_sha256 IS NOT NULL").unionByName(missing)


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns as repairs (of the same rows) leaves them, counted from 0.

    A conversation's audit is split into edits, each with the number of rows that it has passed; rows meet them by that number.
    """
    from pyspark.sql import Window

    numbered = rows.where("NOT gone").withColumn("row", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    edits = repairs.select("conv_id", F.length(F.regexp_replace("audit", "D", "")).alias("length"), F.posexplode(F.split("audit", "")).alias("step", "edit")).where("edit <> ''")
    order = Window.partitionBy("conv_id").orderBy("step")
    edits = edits.withColumns({
        "row": F.sum((F.col("edit") != "I").cast("int")).over(order), "place": F.sum((F.col("edit") != "D").cast("int")).over(order) - 1,
    }).where("edit <> 'D'")
    due = F.when((F.col("place") - F.col("length") % 2) % 2 == 0, "user").otherwise("assistant")
    joined = edits.alias("e").join(numbered.alias("r"), F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("e.row") == F.col("r.row")) & (F.col("edit") != "I"), "left")
    return joined.select(F.col("e.conv_id"), "place", F.when(F.col("edit") == "K", F.col("r.role")).otherwise(due).alias("role"), F.coalesce("r.text", F.lit("")).alias("text"))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """The conversations of a table, damaged by damaged() and repaired."""
    return repair_conversations(damaged(turns))
