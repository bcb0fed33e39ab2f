"""Document fingerprints by context-triggered piecewise hashing, and the likeness of two of them."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, mix, powers

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW, LEAST_BLOCK, LONGEST = 7, 3, 64
_TABLE = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, np.uint32(0x01000193)
#: Bytes that are hashed together; bounds a task's memory.
CHUNK = 1 << 20
#: Ranges that the driver can hold the ends of.
MOST_RANGES = 400_000


def fingerprints(texts: list[bytes]) -> list[str]:
    """'block:signature:signature' of each UTF-8 text; the second signature is of twice the block size.

    A rolling hash of the last 7 bytes ends a piece where it is -1 modulo the block size, 3 * 2**k;
    so the pieces of 2**(k+1) are unions of those of 2**k. k is such that 64 pieces suffice on
    average, and less while fewer than 32 come out. A piece gives one letter, by a polynomial hash of
    its bytes; what exceeds the longest signature, of 64 and 32 letters, joins the last piece.
    """
    out: list[str] = []
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) + WINDOW <= CHUNK:
            size += len(texts[end]) + WINDOW
            end += 1
        out += _chunk(texts[at:end])
        at = end
    return out


def _chunk(texts: list[bytes]) -> list[str]:
    # Zero bytes between texts give each the empty window to begin with.
    gap = b"\0" * WINDOW
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    sizes = np.array([len(t) for t in texts])
    starts = WINDOW + np.append(0, np.cumsum(sizes + WINDOW)[:-1])
    word = np.where(data > 0, _TABLE[data], np.uint32(0))
    roll = np.zeros(len(data), np.uint32)
    for back in range(WINDOW - 1, -1, -1):
        roll *= _STEP
        roll[back:] += word[: len(word) - back]
    roll ^= roll >> np.uint32(16)
    roll *= np.uint32(0x7FEB352D)
    roll ^= roll >> np.uint32(15)
    mark = roll + np.uint32(1)
    ends = np.flatnonzero(mark % np.uint32(LEAST_BLOCK) == 0)
    inside = np.searchsorted(starts, ends, "right") - 1
    ends = ends[(inside >= 0) & (ends < (starts + sizes)[np.maximum(inside, 0)])]
    low = mark[ends]
    level = np.where(low == 0, 31, np.log2((low & (~low + np.uint32(1))).astype(np.float64) + (low == 0))).astype(np.int64)
    power = powers(len(data) + 1, _BASE)
    inverse = powers(len(data) + 1, pow(_BASE, -1, 1 << 64))
    total = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64))
    first = np.searchsorted(ends, starts)
    last = np.searchsorted(ends, starts + sizes)

    def signature(own: np.ndarray, start: int, stop: int, longest: int) -> str:
        cuts = np.concatenate([[start], own[: longest - 1] + 1])
        if cuts[-1] < stop:
            cuts = np.append(cuts, stop)
        a, b = cuts[:-1], cuts[1:]
        return ALPHABET[(mix((total[b] - total[a]) * inverse[a]) >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    out = []
    for start, size, lo, hi in zip(starts.tolist(), sizes.tolist(), first.tolist(), last.tolist(), strict=True):
        own, levels = ends[lo:hi], level[lo:hi]
        k = max(0, (-(-size // (LEAST_BLOCK * LONGEST)) - 1).bit_length())
        while k and int((levels >= k).sum()) < LONGEST // 2:
            k -= 1
        stop = start + size
        fine, coarse = own[levels >= k], own[levels > k]
        out.append(f"{LEAST_BLOCK << k}:{signature(fine, start, stop, LONGEST)}:{signature(coarse, start, stop, LONGEST // 2)}")
    return out


def edit_distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Levenshtein distances of pairs of strings of up to 64 bytes, all at once: a column of each table is two words of bits."""
    n = len(a)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    rows, one = np.arange(n), np.uint64(1)
    square = [np.frombuffer(b"".join(x.ljust(64, b"\0") for x in side), np.uint8).reshape(n, 64) for side in (a, b)]
    equal = np.zeros((n, 128), np.uint64)
    for j in range(int(la.max(initial=0))):
        live = rows[la > j]
        equal[live, square[0][live, j]] |= np.uint64(1 << j)
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    top, distance = one << np.maximum(la - 1, 0).astype(np.uint64), la.copy()
    for j in range(int(lb.max(initial=0))):
        eq = equal[rows, square[1][:, j]]
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(h | up), up & h
        live = lb > j
        distance += live * (((plus & top) > 0).astype(np.int64) - ((minus & top) > 0))
        plus, minus = (plus << one) | one, minus << one
        up, down = np.where(live, minus | ~(x | plus), up), np.where(live, plus & x, down)
    return np.where(la == 0, lb, distance)


def likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: 1 - edit distance / longer length, at the block sizes that both have.

    Equal fingerprints are 1, those of incompatible block sizes 0; the better of two signatures counts.
    """
    best = np.zeros(len(a))
    left, right, of = [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x == y:
            best[i] = 1
            continue
        p, p1, p2 = x.split(":")
        q, q1, q2 = y.split(":")
        p, q = int(p), int(q)
        for u, v in ((p1, q1), (p2, q2)) if p == q else ((p1, q2),) if p == 2 * q else ((p2, q1),) if q == 2 * p else ():
            if u and v:
                left.append(u.encode())
                right.append(v.encode())
                of.append(i)
    if of:
        longer = np.maximum([len(x) for x in left], [len(x) for x in right])
        np.maximum.at(best, of, 1 - edit_distances(left, right) / longer)
    return best


def fingerprint_texts(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of each whole text more; null counts as empty."""
    docs = docs.drop(out)
    at = docs.columns.index(text_col)

    def add(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            texts = [t or b"" for t in pc.cast(batch.column(at), pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fingerprints(texts), pa.string())], [*batch.schema.names, out])

    return docs.mapInArrow(add, docs.select("*", F.lit("").alias(out)).schema)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _key_ranges(rows: DataFrame, ranges: int, range_bytes: int) -> list[tuple]:
    """The first and last (id, hash) and the bytes of each range of the order by falling id, nulls last, then hash.

    Spark's range partitioning deals keys by their number; each of its parts, sorted and streamed, is cut anew wherever range_bytes
    of text are full, so sizes that follow the ids make no large range. Equal keys stay together.
    """

    def ends(batches):
        import pyarrow as pa

        out, first, last, size = [], None, None, 0
        for batch in batches:
            key = lambda k, b=batch: (b.column(0)[k].as_py(), b.column(1)[k].as_py())
            upto = np.cumsum(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = int(upto[at - 1]) if at else 0
                stop = int(np.searchsorted(upto, before + range_bytes - size, "right"))
                if first is None:
                    first, stop = key(at), max(stop, at + 1)
                stop = max(stop, at)
                while stop < batch.num_rows and key(stop) == (key(stop - 1) if stop > at else last):
                    stop += 1
                if stop > at:
                    last, size = key(stop - 1), size + int(upto[stop - 1]) - before
                if stop < batch.num_rows:
                    out.append((*first, *last, size))
                    first, size = None, 0
                at = stop
        if first is not None:
            out.append((*first, *last, size))
        names = ["first_id", "first_hash", "last_id", "last_hash", "bytes"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names)

    order = (F.col("id").desc_nulls_last(), F.col("hash"))
    cut = rows.select("id", "hash", "bytes").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return cut.mapInArrow(ends, "first_id long, first_hash long, last_id long, last_hash long, bytes long").collect()


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = 16 << 20) -> DataFrame:
    """How alike each text is to its half-replaced form and to the next text, by fingerprints.

    The next document is that of the next lower id; after the last comes the first. Rows of one
    id follow each other by a hash of their text, null ids come last, null text is empty; ids are whole numbers. Rows are cut
    into ranges of range_bytes of text, and one document more at most, by id and hash, so that neither null ids nor a repeated id make a range of
    their own; only rows equal in id and text stay together. A range's first document is also dealt to the range before, so that each
    range, sorted and streamed, has the next document of its last one. Texts are shuffled once, a task a range; the
    driver holds four numbers a range, and beyond MOST_RANGES ranges they get larger instead.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    keys = durable(rows.select("id", "hash", F.octet_length("text").alias("bytes")), "keys")
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    range_bytes = max(range_bytes, total // MOST_RANGES)
    ranges = max(-(-total // range_bytes), 2 * spark.sparkContext.defaultParallelism)
    # Null ids come after all others, as if of a lower id than any.
    rank = lambda i, h: (1, 0, h) if i is None else (0, -i, h)
    found = sorted((rank(r[0], r[1]), rank(r[2], r[3]), r[0], r[1]) for r in _key_ranges(keys, ranges, range_bytes))
    lasts = [last for _, last, _, _ in found]
    heads = {k: (i, h) for k, (_, _, i, h) in enumerate(found)}
    before = {key: (k - 1) % len(heads) for k, key in heads.items()}  # the last range comes before the first
    falling = np.array([last[1] for last in lasts if last[0] == 0], np.int64)

    def number(ids: list, hashes: list) -> list[int]:
        """The range of each key: the first whose last key isn't before it. Only ids that end a range need their hash for that."""
        at = np.array([0 if i is None else -i for i in ids], np.int64)
        low, high = np.searchsorted(falling, at, "left").tolist(), np.searchsorted(falling, at, "right").tolist()
        return [a if a == b and i is not None else bisect_left(lasts, rank(i, h)) for a, b, i, h in zip(low, high, ids, hashes, strict=True)]

    def dealt(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, hashes = part.column(0).to_pylist(), part.column(2).to_pylist()
                k = number(ids, hashes)
                marks = fingerprints(pc.cast(part.column(1), pa.binary()).to_pylist())
                keys = list(zip(ids, hashes, strict=True))
                more = [i for i, key in enumerate(keys) if key in before]
                rows = pa.array([*range(part.num_rows), *more], pa.int64())
                where = np.array(k + [before[keys[i]] for i in more], np.int64)
                tail = np.append(np.zeros(part.num_rows, bool), np.ones(len(more), bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where), pa.array(tail), part.column(0).take(rows), part.column(2).take(rows), part.column(1).take(rows), pa.array(marks).take(rows)],
                    ["range", "tail", "id", "hash", "text", "mark"],
                )

    spread = rows.select("id", "text", "hash").mapInArrow(dealt, "range long, tail boolean, id long, hash long, text string, mark string")
    spread = spread.repartitionById(max(len(found), 1), F.col("range").cast("int")).sortWithinPartitions("range", "tail", F.col("id").desc_nulls_last(), "hash")

    def compared(batches):
        import pyarrow as pa

        def emit(pairs):
            texts, marks, others = [p[0][4] for p in pairs], [p[0][5] for p in pairs], [p[1] for p in pairs]
            edited = []
            for text, other in zip(texts, others, strict=True):
                half = len(text) // 2
                edited.append((text[: len(text) - half] + other[4][:half]).encode())
            changed = fingerprints(edited)
            columns = [
                pa.array([p[0][2] for p in pairs], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array(marks),
                pa.array(changed),
                pa.array(likenesses(marks, changed)),
                pa.array(likenesses(marks, [o[5] for o in others])),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                pairs = []
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if held is not None and held[0] == row[0] and not held[1]:
                        pairs.append((held, row))
                    held = row
                if pairs:
                    yield emit(pairs)

    return spread.mapInArrow(compared, RESULT)
