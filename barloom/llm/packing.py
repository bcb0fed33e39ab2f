"""Best-fit packing of token pieces into sequences by bin completion with branch and bound."""

from __future__ import annotations

import heapq
import json
import unicodedata
import zlib
from bisect import bisect_right
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import durable

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


_MARKS = frozenset(".,!?;:|")


def _byte_chars() -> list[str]:
    """The visible character that stands for each byte in the vocabulary's tokens: itself, or from 256 on in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


_BYTE_CHARS = _byte_chars()


# The text rules under which a text's ids are those of its words in turn, as vocabulary files write them.
BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class WholeTexts:
    """text -> its ids as little-endian unsigned 32-bit numbers, for vocabularies of any rules."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)

    def of(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class TokenBytes(dict):
    """chunk of text without spaces or line ends -> its ids as little-endian unsigned 32-bit numbers.

    The vocabulary neither joins tokens across white space nor keeps it, so a text's ids are those
    of its chunks in turn; and it parts Latin letters from a mark after them, so the letters are
    encoded once, whatever mark follows them. When `limit` chunks are held they become the elder half
    of the memory, in place of the one before; chunks of over 64 characters are never kept.
    """

    def __init__(self, vocabulary: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit, self.elder = Tokenizer.from_str(vocabulary), limit, {}
        self.model = self.tokenizer.model

    def __missing__(self, chunk: str) -> bytes:
        ids = self.elder.get(chunk)
        if ids is None:
            word = chunk[:-1]
            if word and chunk[-1] in _MARKS and word.isalpha() and max(word) < "\u0250":
                ids = self[word] + self[chunk[-1]]
            else:
                ids = np.array(self._encode(chunk), "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.elder = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _encode(self, chunk: str) -> list[int]:
        """Lower-case Latin letters pass the vocabulary's own text rules unchanged, so they go to its model at once."""
        if chunk.isalpha() and chunk == chunk.lower() and max(chunk) < "\u0250" and unicodedata.is_normalized("NFC", chunk):
            word = chunk if chunk.isascii() else "".join(map(_BYTE_CHARS.__getitem__, chunk.encode()))
            return [t.id for t in self.model.tokenize(word)]
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def of(self, text: str) -> bytes:
        # The vocabulary reads A-Z as a-z; only the name of a special token tells them apart.
        if "<|" not in text:
            text = text.encode().lower().decode()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


#: A worker's memory outlives its tasks: most words of a task were met in those before.
_MEMORIES: dict[int, TokenBytes | WholeTexts] = {}


def encoder_of(vocabulary: str) -> TokenBytes | WholeTexts:
    """An encoder by words where the vocabulary's rules are those of BY_WORDS, else one of whole texts."""
    rules = json.loads(vocabulary)
    by_words = all(rules.get(k) == v for k, v in BY_WORDS.items()) and rules["model"].get("type") == "BPE" and not rules.get("truncation")
    return TokenBytes(vocabulary) if by_words else WholeTexts(vocabulary)


def _memory(vocabulary: str) -> TokenBytes | WholeTexts:
    key = hash(vocabulary)
    if key not in _MEMORIES:
        _MEMORIES[key] = encoder_of(vocabulary)
    return _MEMORIES[key]


def token_pieces(docs: DataFrame, tokenizer: str, room: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and end_id, cut only beyond `room`.

    tokenizer: the path of a vocabulary file, read on the driver and sent with the task.
    """
    vocabulary = Path(tokenizer).read_text()

    def cut(batches):
        import pyarrow as pa

        chunks, end = _memory(vocabulary), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = chunks.of(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * room)):
                    part = ids[at : at + 4 * room]
                    for column, value in zip(rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(cut, PIECES)


# A plan is a list of (times, {length: how many}): so many sequences that are filled alike.


def best_fit(counts: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing, a length and a group of equal sequences at a time."""
    groups: dict[int, list[tuple[int, dict[int, int]]]] = {}  # by room left
    left: list[int] = []
    for length in sorted(counts, reverse=True):
        n, keep = counts[length], []
        left.sort()
        for gap in list(left):
            if gap < length or not n:
                continue
            fit, moved = gap // length, []
            for times, filling in groups.pop(gap):
                full = min(times, n // fit)
                rest = min(n - full * fit, fit) if times > full else 0
                n -= full * fit + rest
                for t, k in ((full, fit), (1 if rest else 0, rest), (times - full - (1 if rest else 0), 0)):
                    if t:
                        moved.append((gap - k * length, (t, {**filling, length: k} if k else filling)))
            keep += moved
        for gap, group in keep:
            groups.setdefault(gap, []).append(group)
        fit = room // length
        for t, k in ((n // fit, fit), (1 if n % fit else 0, n % fit)):
            if t:
                groups.setdefault(room - k * length, []).append((t, {length: k}))
        left = list(groups)
    return [group for held in groups.values() for group in held]


def _fillings(lengths: list[int], counts: dict[int, int], gap: int, most: int, steps: int) -> list[dict[int, int]]:
    """Undominated fillings of `gap`, least waste first: at most `most`, after at most `steps` tries.

    A single length that fills the gap dominates all others. Else lengths are added from the
    largest down; one is left out only where something smaller still fits, and a filling is
    dropped if a length that is left over could have stood in for one of its lengths within the gap.
    """
    if counts.get(gap, 0):
        return [{gap: 1}]
    found: list[tuple[int, int, dict[int, int]]] = []
    stack: list[tuple[int, int, dict[int, int]]] = [(bisect_right(lengths, gap) - 1, gap, {})]
    while stack and steps and len(found) < 8 * most:
        steps -= 1
        at, free, filling = stack.pop()
        at = min(at, bisect_right(lengths, free) - 1)
        while at >= 0 and counts[lengths[at]] - filling.get(lengths[at], 0) <= 0:
            at -= 1
        if at < 0:
            if filling and not _dominated(lengths, counts, filling, free):
                found.append((free, len(filling), filling))
                if not free and len(found) >= most:
                    break
            continue
        length = lengths[at]
        if at and free:
            stack.append((at - 1, free, filling))
        more = {**filling, length: filling.get(length, 0) + 1}
        exact = free - length
        if exact and counts.get(exact, 0) - more.get(exact, 0) > 0 and exact <= length:
            found.append((0, len(more), {**more, exact: more.get(exact, 0) + 1}))
        stack.append((at, free - length, more))
    return [f for _, _, f in heapq.nsmallest(most, found, key=lambda x: x[:2])]


def _dominated(lengths, counts, filling, free) -> bool:
    for length in filling if free else ():
        at = bisect_right(lengths, length + free) - 1
        while at >= 0 and lengths[at] > length:
            if counts[lengths[at]] - filling.get(lengths[at], 0) > 0:
                return True
            at -= 1
    return False


def bin_completion(counts: dict[int, int], room: int, nodes: int = 6_000, width: int = 8, steps: int = 400) -> list[tuple[int, dict[int, int]]]:
    """Fill sequences around the largest length left, with branch and bound over the fillings.

    counts: how often each length from 1 to `room` occurs; so the work depends on the number of
    lengths and on `nodes`, not on the number of pieces: a chosen filling is used as often as
    its lengths last, or else once. A branch is left once its waste rules out fewer sequences than the incumbent,
    which begins as best-fit decreasing. Stops at the bound ceil(total / room) or after `nodes` steps;
    what the last branch leaves open is then closed by best fit, if that beats the incumbent.

    Three numbers bound the search, not what is packed: `nodes` branches in all, the `width` best fillings tried at each, and
    `steps` tries to find them. Whatever they are, all pieces are placed and the result is no worse than best fit; what
    they cost is that it may not be the least possible: on 3,000 random tables of 6 to 11 pieces a width of 4 missed it twice, one of 40 never.
    """
    counts = {length: n for length, n in counts.items() if n}
    total = sum(length * n for length, n in counts.items())
    least = -(-total // room)
    best = best_fit(counts, room)
    fewest = sum(t for t, _ in best)
    if fewest == least:
        return best

    live = dict(counts)
    lengths = sorted(live)
    path: list[tuple[int, dict[int, int], list[tuple[dict[int, int], bool]]]] = []  # (times, filling, other fillings)
    waste = used = 0

    def options() -> list[tuple[dict[int, int], bool]]:
        """Fillings to try, as often as their lengths last; after all of them, each once where that differs."""
        top = lengths[-1]
        live[top] -= 1
        found = _fillings(lengths, live, room - top, width, steps) if room > top else []
        live[top] += 1
        whole = [{**f, top: f.get(top, 0) + 1} for f in found] or [{top: 1}]
        often = [f for f in whole if all(live[length] >= 2 * k for length, k in f.items())]
        return [(f, False) for f in whole] + [(f, True) for f in often]

    def put(filling: dict[int, int], once: bool) -> int:
        nonlocal waste, used
        times = 1 if once else min(live[length] // k for length, k in filling.items())
        for length, k in filling.items():
            live[length] -= k * times
            if not live[length]:
                del live[length]
                lengths.pop(bisect_right(lengths, length) - 1)
        waste += times * (room - sum(length * k for length, k in filling.items()))
        used += times
        return times

    def take_back(times: int, filling: dict[int, int]) -> None:
        nonlocal waste, used
        for length, k in filling.items():
            if length not in live:
                lengths.insert(bisect_right(lengths, length), length)
            live[length] = live.get(length, 0) + k * times
        waste -= times * (room - sum(length * k for length, k in filling.items()))
        used -= times

    def close() -> None:
        nonlocal best, fewest
        rest = best_fit(live, room)
        if used + sum(t for t, _ in rest) < fewest:
            best, fewest = [(t, f) for t, f, _ in path] + rest, used + sum(t for t, _ in rest)

    while nodes and fewest > least:
        nodes -= 1
        hopeless = waste > (fewest - 1) * room - total
        if lengths and not hopeless:
            (first, once), *others = options()
            path.append((put(first, once), first, others))
            if nodes % 1024 == 0:
                close()
            continue
        if not hopeless:
            close()
        while path:
            times, filling, others = path.pop()
            take_back(times, filling)
            if others:
                (first, once), *others = others
                path.append((put(first, once), first, others))
                break
        else:
            break
    close()
    return best


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, stretches of its ranks: (first rank, first sequence, how many in each, their offset)."""
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, filling in plan:
        offset = 0
        for length in sorted(filling, reverse=True):
            k = filling[length]
            places.setdefault(length, []).append((ranks.get(length, 0), sequence, k, offset))
            ranks[length] = ranks.get(length, 0) + k * times
            offset += k * length
        sequence += times
    return places


def pack(pieces: DataFrame, room: int = 2048, cell_rows: int = 50_000, **search) -> DataFrame:
    """pieces with sequence_id and offset: which sequence holds each, and where.

    Only the counts of lengths, `room` at most, meet on the driver; the plan made of them has a
    few stretches of ranks a length. Pieces of a length are interchangeable: each gets its rank as
    the rank in a cell of its length, by a hash of the piece, plus the counts of the cells before, so
    that a length that is very common is never sorted in one task. The number of cells follows the
    number of pieces.
    """
    tally = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(bin_completion(tally, room, **search))
    cells = max(1, -(-sum(tally.values()) // cell_rows)) * 4
    celled = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)))
    order = W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = celled.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "cell", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first")
    )
    within = W.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = celled.withColumn("at", F.row_number().over(within) - 1).join(starts, ["length", "cell"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("at") + F.col("first")).alias("rank"))
    tables = {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in places.items()}

    def placed(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for each in np.unique(length):
                rows = np.flatnonzero(length == each)
                first, base, k, begin = tables[int(each)]
                at = np.searchsorted(first, rank[rows], "right") - 1
                past = rank[rows] - first[at]
                sequence[rows] = base[at] + past // k[at]
                offset[rows] = begin[at] + past % k[at] * each
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, room: int = 2048, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each document.

    Null and empty texts hold end_id alone. Null ids and repeated rows are packed like any other
    row; ids are whole numbers; an empty table gives no rows. Sequences are gapless from offset 0 and hold `room` tokens
    at most. tokenizer may be any vocabulary file: of those with the rules of BY_WORDS words are encoded once and
    remembered, others encode whole texts. `search` are the bounds of bin_completion(), which say what they cost.
    """
    return pack(durable(token_pieces(docs, tokenizer, room, id_col=id_col, text_col=text_col), "pieces"), room, **search)
