"""Lines, paragraphs and passages that repeat across documents: units are hashed, digests are grouped, the earliest stays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, durable, meet, mix, powers

#: Words of a passage, how many places in a row may go without one being hashed, and words from which on a line or paragraph is a unit.
PASSAGE_WORDS, SPREAD, LINE_WORDS = 24, 16, 3
#: Texts that must hold a line or paragraph of fewer words than a passage before it counts as repeated; 2 takes every repeat.
LINE_DOCS = 5
#: Scripts that put no spaces between words: each of their characters counts as a word.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))

_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def words_of(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words in lower case, and where each starts and ends in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = ~_SPACE[np.minimum(codes, 0x3001)]
    alone = np.zeros(len(codes), bool)
    if len(codes) and int(codes.max()) >= UNSPACED[0][0]:
        for low, high in UNSPACED:
            alone |= (codes >= low) & (codes <= high)
    joined = word[1:] & word[:-1] & ~alone[1:] & ~alone[:-1]
    starts = np.flatnonzero(word & np.append(True, ~joined)) if len(codes) else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & np.append(~joined, True)) + 1 if len(codes) else np.zeros(0, np.int64)
    if alone.any():
        return [text[a:b].lower() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], starts, ends
    return text.lower().split(), starts, ends


class _Powers:
    """Powers of both bases and of their inverses, as many as the longest text so far asked for."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def of(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.held or len(self.held[0][0]) < n:
            size = max(n, 1 << 14)
            self.held = [(powers(size, base), powers(size, pow(base, -1, 1 << 64))) for base in _BASES]
        return self.held


_powers = _Powers()


def units(text: str, hashes: WordHashes, passage_words: int = PASSAGE_WORDS, spread: int = SPREAD, line_words: int = LINE_WORDS) -> tuple[np.ndarray, ...]:
    """(start, end, digest, digest, again, short) of what may be a repeat, as six columns in order of start.

    Whole lines, with the end of the line, and whole paragraphs are units from line_words words on. Of the runs of
    passage_words words, whatever lines they are in, the one of least hash among each `spread` in a row is: so two texts
    that share passage_words + spread - 1 words in a row share a unit there, wherever in a line it begins. Words are in lower
    case, white space at either side or between them makes no difference. `again` marks all but the first place of a
    digest in this text; places that overlap the first are left out. `short` marks lines and paragraphs of fewer words than a passage.
    """
    words, starts, ends = words_of(text)
    n = len(words)
    if n < min(passage_words, line_words):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, bool, bool))
    first = hashes.of(words)
    sums = []
    for value, (power, inverse) in zip((first, mix(first ^ np.uint64(_BASES[0]))), _powers.of(n + 1), strict=True):
        sums.append((np.append(np.uint64(0), np.cumsum(value * power[:n], dtype=np.uint64)), inverse))

    def digests(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        return [mix((s[b] - s[a]) * inverse[a] + (b - a).astype(np.uint64)) for s, inverse in sums]

    breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10)
    line = np.searchsorted(breaks, starts)
    step = np.diff(line)
    found = []
    for cut in (np.flatnonzero(step > 0) + 1, np.flatnonzero(step > 1) + 1):
        a, b = np.append(0, cut), np.append(cut, n)
        long_ = b - a >= line_words
        found.append((a[long_], b[long_]))
    (la, lb), (pa, pb) = found
    many = line[pa] != line[pb - 1]  # a paragraph of one line is that line
    a, b = np.concatenate([la, pa[many]]), np.concatenate([lb, pb[many]])
    edge = np.append(breaks + 1, len(text))
    begin, end = np.append(0, breaks + 1)[line[a]], edge[line[b - 1]]
    columns = [(begin, end, *digests(a, b), b - a < passage_words)]
    if n >= passage_words:
        at = np.arange(n - passage_words + 1)
        one, two = digests(at, at + passage_words)
        width = min(spread, len(at))
        views = np.lib.stride_tricks.sliding_window_view(one, width)
        chosen = np.unique(views.argmin(axis=1) + np.arange(len(views)))
        columns.append((starts[chosen], ends[chosen + passage_words - 1], one[chosen], two[chosen], np.zeros(len(chosen), bool)))
    start, end, one, two, short = (np.concatenate(c) for c in zip(*columns, strict=True))
    order = np.lexsort((-end, start))
    start, end, one, two, short = start[order], end[order], one[order], two[order], short[order]
    _, place, inverse = np.unique(one, return_index=True, return_inverse=True)
    again = place[inverse] != np.arange(len(one))
    if again.any():
        keep = ~again | (start >= end[place][inverse])
        start, end, one, two, again, short = start[keep], end[keep], one[keep], two[keep], again[keep], short[keep]
    return start, end, one, two, again, short


def _unit_rows(passage_words: int, spread: int, line_words: int):
    def rows(batches):
        import pyarrow as pa

        hashes = WordHashes()

        def emit(held):
            sizes = [len(columns[0]) for _, _, columns in held]
            ids = pa.array([i for i, _, _ in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
            marks = np.repeat(np.array([m for _, m, _ in held], np.int64), sizes)
            start, end, one, two, again, short = (np.concatenate(c) for c in zip(*(columns for _, _, columns in held), strict=True))
            arrays = [ids, pa.array(marks), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(again), pa.array(short)]
            return pa.RecordBatch.from_arrays(arrays, ["id", "mark", "one", "two", "start", "end", "again", "short"])

        for batch in batches:
            held, size = [], 0
            for doc, mark, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                held.append((doc, mark, units(text, hashes, passage_words, spread, line_words)))
                size += len(held[-1][2][0])
                if size > 50_000:
                    yield emit(held)
                    held, size = [], 0
            if held:
                yield emit(held)

    return rows


def repeated_units(
    docs: DataFrame, passage_words: int = PASSAGE_WORDS, spread: int = SPREAD, line_words: int = LINE_WORDS, line_docs: int = LINE_DOCS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, mark, start, end, first_id): each unit that is not the earliest of its kind, with original offsets.

    The earliest has the least id, then the least offset; `mark` is a hash of the text, which tells the texts of a repeated id
    apart. Texts are cut into units once; digests, of 128 bits, are pre-aggregated to the least id before they move. Digests that very many
    units have are few, as their number of rows must exceed a share of all: their rows are looked up in place, and the other rows meet
    the repeated digests in a join, so that no task gathers a line that a third of the documents hold.

    A line or paragraph of fewer words than a passage is a repeat only if line_docs texts hold it.

    Rows that share an id aren't repeats of each other, but a text's own repeats are. Rows of null id rank after all ids, by
    the hash of their text; equal texts of null id stay alike. Texts of null are left out.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark"), F.col(f"`{text_col}`").alias("text"))
    kinds = "id long, mark long, one long, two long, start int, end int, again boolean, short boolean"
    found = durable(source.where("text is not null").mapInArrow(_unit_rows(passage_words, spread, line_words), kinds), "units")
    firsts = found.groupBy("one", "two").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.min(F.when(F.col("id").isNull(), F.col("mark"))).alias("first_mark"),
        F.count_if(~F.col("again")).alias("texts"), F.max("short").alias("short"),
    )
    firsts = durable(firsts.where((F.col("n") > 1) & (~F.col("short") | (F.col("texts") >= line_docs) | F.lit(line_docs <= 2))).drop("texts", "short"), "repeated")
    seen = meet(found, firsts, ["one", "two"])
    later = F.when(F.col("first_id").isNull(), F.col("mark") != F.col("first_mark")).otherwise(F.coalesce(F.col("id") != F.col("first_id"), F.lit(True)))
    return seen.where(later | F.col("again")).select("id", "mark", "start", "end", "first_id")


def _cutter(columns: int, at: int):
    """Replaces column `at` by what its spans leave; the spans are the last column. Spans inside of another one aren't listed; others may overlap."""

    def cut(batches):
        import pyarrow as pa

        span = [("start", pa.int32()), ("end", pa.int32())]
        for batch in batches:
            texts, removed, kept = [], [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(columns).to_pylist(), strict=True):
                left, listed, here = [], [], 0
                for g in sorted(gone or (), key=lambda g: (g["start"], -g["end"])):
                    if g["end"] <= here:
                        continue
                    if g["start"] > here:
                        left.append((here, g["start"]))
                    here = g["end"]
                    listed.append(g)
                if here < len(text or ""):
                    left.append((here, len(text)))
                texts.append("".join(text[a:b] for a, b in left) if listed else text)
                removed.append(listed)
                kept.append([{"start": a, "end": b} for a, b in left])
            arrays = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(columns)]
            arrays += [pa.array(removed, pa.list_(pa.struct([*span, ("first_id", pa.int64())]))), pa.array(kept, pa.list_(pa.struct(span)))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:columns], "removed", "kept_spans"])

    return cut


def dedup_passages(
    docs: DataFrame, passage_words: int = PASSAGE_WORDS, spread: int = SPREAD, line_words: int = LINE_WORDS, line_docs: int = LINE_DOCS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """docs with repeated units cut out of the text, and two columns more.

    `removed` lists what was cut as (start, end, first_id), `kept_spans` what stays as (start,
    end), both in code points of the original text; what was cut may overlap. Units are lines and paragraphs of line_words words on, and
    passages of passage_words, see units(): any run of passage_words + spread - 1 words that an earlier text holds loses all but at most
    spread - 1 words at either side. Lines and paragraphs of fewer words than a passage go where line_docs texts hold them; two or three texts
    may have such a line by chance. line_docs=2 takes every repeat, and line_words=1 lines of a single word.

    Null text stays null and empty stays empty; ids are whole numbers. For rows that share an id and for null ids see
    repeated_units(). Columns named like the two are replaced.
    """
    docs = docs.drop("removed", "kept_spans")
    gone = repeated_units(docs, passage_words, spread, line_words, line_docs, id_col, text_col)
    gone = gone.groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark")).agg(F.collect_set(F.struct("start", "end", "first_id")).alias("__gone"))
    same = F.xxhash64(F.col(f"`{text_col}`")) == F.col("__mark")
    ready = docs.join(gone, same & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left").drop("__id", "__mark")
    spans = "array<struct<start:int,end:int,first_id:bigint>>"
    schema = docs.select("*", F.array().cast(spans).alias("removed"), F.array().cast("array<struct<start:int,end:int>>").alias("kept_spans")).schema
    return ready.mapInArrow(_cutter(len(docs.columns), docs.columns.index(text_col)), schema)
