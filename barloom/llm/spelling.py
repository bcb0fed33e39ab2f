"""Spelling variants: words one edit apart are found by products of letter-count blocks, and each is led to its usual form."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, forget

#: Code points of the shortest word, its least occurrences, and how many times as frequent a form is.
LEAST_LENGTH, LEAST_N, TIMES = 7, 2, 10
#: Words of a block of which all pairs are formed in one task, and rows of one matrix product.
BLOCK_WORDS, GRAM_ROWS = 4096, 512
#: Words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Letters: a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64


def _word_counts(least_length: int):
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least_length)

    def count(batches: Iterator):
        import pyarrow as pa

        totals: Counter[bytes] = Counter()

        def emit():
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in totals], pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"])
            totals.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Latin-1 has just the letters in question; bytes.lower() acts on A-Z alone
                for run, n in Counter(runs.findall(text.encode("latin-1", "replace").lower())).items():
                    h = zlib.crc32(run.decode("latin-1").encode(), seed)
                    if h % 31 == 0:
                        if len(run) == least_length:
                            continue
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    totals[run] += n
                if len(totals) > HELD_WORDS:
                    yield emit()
        if totals:
            yield emit()

    return count


def damaged_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N) -> DataFrame:
    """(word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z lower-cased, after the damage.

    With h the crc32 of `doc_id:run` (a null id is empty), a run loses its code point h % length where 31 divides h. Words of at
    least least_length code points and least_n occurrences are kept; each task counts before it shuffles.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_word_counts(least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _letter_counts(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Counts of each letter, a row a word; codes are the words' letters end to end."""
    letter = np.where(codes >= 0xC0, codes.astype(np.int32) - 0xC0 + 26, codes.astype(np.int32) - 97)
    row = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(row * LETTERS + letter, minlength=len(lengths) * LETTERS).reshape(-1, LETTERS)
    # products are exact in either type: a length of up to 2,000 squared is far below 2**24
    return counts.astype(np.float32 if len(lengths) == 0 or lengths.max() <= 2000 else np.float64)


def _one_edit(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) of words, b as long as a or one longer, are just one replaced or inserted letter apart."""
    out = np.zeros(len(a), bool)
    for lo in range(0, len(a), 1 << 13):
        x, y = a[lo : lo + (1 << 13)], b[lo : lo + (1 << 13)]
        for width in np.unique(lengths[x]).tolist():
            rows = np.flatnonzero(lengths[x] == width)
            for part in np.array_split(rows, max(1, len(rows) * width >> 22)):
                column = np.arange(width)
                p, q = codes[starts[x[part], None] + column], codes[starts[y[part], None] + column]
                other = p != q
                same = lengths[y[part]] == width
                late = p != codes[np.minimum(starts[y[part], None] + column + 1, len(codes) - 1)]
                first = np.where(other.any(axis=1), other.argmax(axis=1), width)
                moved = ~(late & (column >= first[:, None])).any(axis=1)
                out[lo + part] = np.where(same, other.sum(axis=1) == 1, moved)
    return out


class _Words:
    """Rows of some blocks: words as Latin-1 bytes end to end, what block each is in, and what it may be paired as."""

    def __init__(self, table):
        self.words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.append(0, np.cumsum(self.lengths))[:-1]
        self.codes = np.frombuffer(b"".join(self.words), np.uint8)
        self.n = table.column("n").to_numpy()
        self.home, self.probe = (table.column(c).to_numpy(zero_copy_only=False) for c in ("home", "probe"))
        self.ends = table.column("ends").to_numpy(zero_copy_only=False)
        self.length = table.column("length").to_numpy()

    def near(self, rows: np.ndarray, others: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (of rows, of others) in the same block that are one edit apart, each once."""
        def gram(r):
            starts, lengths = self.starts[r], self.lengths[r]
            codes = self.codes[np.arange(int(lengths.sum())) + np.repeat(starts - np.append(0, np.cumsum(lengths))[:-1], lengths)]
            return _letter_counts(codes, lengths)

        x, y = gram(rows), gram(others)
        squared = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
        i, j = np.nonzero((squared <= 2) & (group[rows][:, None] == group[others][None, :]))
        a, b = rows[i], others[j]
        fit = self.home[a] & self.probe[b] & ((self.lengths[a] < self.lengths[b]) | (self.lengths[a] == self.lengths[b]) & (a < b))
        a, b = a[fit], b[fit]
        half = self.length[a] // 2
        if len(a):  # a pair that shares both halves of the shorter word counts where the beginnings meet
            column = np.arange(int(half.max()))
            apart = (self.codes[self.starts[a, None] + column] != self.codes[self.starts[b, None] + column]) & (column < half[:, None])
            fit = ~self.ends[a] | apart.any(axis=1)
            a, b = a[fit], b[fit]
        fit = _one_edit(self.codes, self.starts, self.lengths, a, b)
        return a[fit], b[fit]


def _near_words(gram_rows: int):
    """Rows sorted by block -> (word, n_near, best): for each word of a block what it found there."""

    def emit(words: _Words, a: np.ndarray, b: np.ndarray):
        import pyarrow as pa

        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        _, rank = np.unique(np.array(words.words, dtype=object), return_inverse=True)
        order = np.lexsort((rank[dst], -words.n[dst], src))
        src, dst = src[order], dst[order]
        first = np.flatnonzero(np.append(True, src[1:] != src[:-1]))
        text = lambda rows: pa.array([words.words[r].decode("latin-1") for r in rows.tolist()], pa.string())
        best = pa.StructArray.from_arrays([pa.array(-words.n[dst[first]]), text(dst[first])], ["minus_n", "word"])
        counts = np.diff(np.append(first, len(src)))
        return pa.RecordBatch.from_arrays([text(src[first]), pa.array(counts.astype(np.int64)), best], ["word", "n_near", "best"])

    def pairs(table):
        words = _Words(table)
        keys = [np.asarray(table.column(c).combine_chunks().dictionary_encode().indices) if c == "half" else table.column(c).to_numpy(zero_copy_only=False) for c in ("length", "ends", "half", "i", "j")]
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        group = np.cumsum(change)
        size = np.bincount(group)[group]
        rows = np.flatnonzero(size > 1)
        found_a, found_b, at = [], [], 0
        while at < len(rows):  # whole blocks go into one product together, a large block into several
            end = min(at + gram_rows, len(rows))
            if end < len(rows):
                begun = np.searchsorted(group[rows], group[rows[end]])
                end = int(begun) if begun > at else int(np.searchsorted(group[rows], group[rows[at]], side="right"))
            part = rows[at:end]
            for lo in range(0, len(part), gram_rows):
                for lo2 in range(0, len(part), gram_rows):
                    a, b = words.near(part[lo : lo + gram_rows], part[lo2 : lo2 + gram_rows], group)
                    found_a.append(a)
                    found_b.append(b)
            at = end
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
        return emit(words, a, b) if len(a) else None

    def run(batches: Iterator):
        import pyarrow as pa

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            table = pa.Table.from_batches(held)
            last = table.slice(table.num_rows - 1).select(["length", "ends", "half", "i", "j"]).to_pylist()[0]
            keep = table.num_rows - 1  # the last block may go on in the next batch
            while keep and all(table.column(k)[keep - 1].as_py() == v for k, v in last.items()):
                keep -= 1
            held = table.slice(keep).to_batches()
            if keep and (out := pairs(table.slice(0, keep))) is not None:
                yield out
        if held and (out := pairs(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def _blocks(words: DataFrame, block_words: int, least_length: int) -> DataFrame:
    """(length, ends, half, word, n, home, probe, i, j): words by the blocks that they meet in.

    A block holds words of `length` and of one more that begin (or end) alike: of two words one edit apart, one half of the
    shorter stands in the other. Words of the block's length are paired with each other and, as home, with the longer. A block of over
    block_words is dealt in parts: each pair of a home part i and a probe part j is a block of its own, so no pair is lost.
    """
    size = F.length("word")
    kinds = []
    for longer in (0, 1):
        length = size - longer
        half = F.floor(length / 2).cast("int")
        for ends in (False, True):
            text = F.expr(f"right(word, length(word) - {longer} - cast(floor((length(word) - {longer}) / 2) as int))") if ends else F.substring(F.col("word"), F.lit(1), half)
            kinds.append(F.struct(length.cast("int").alias("length"), F.lit(ends).alias("ends"), text.alias("half"), F.lit(not longer).alias("home")))
    rows = words.select("word", "n", F.explode(F.array(*kinds)).alias("k")).select("k.*", "word", "n").where(F.col("length") >= least_length)
    key = ["length", "ends", "half"]
    large = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_words)
    rows = rows.join(large, key, "left")
    parts = F.ceil(F.col("rows") / block_words).cast("int")
    part = F.pmod(F.xxhash64("word"), parts).cast("int")
    both = F.array(F.struct(F.col("home"), F.lit(True).alias("probe"), F.lit(0).alias("i"), F.lit(0).alias("j")))
    every = F.sequence(F.lit(0), parts - 1)
    as_home = F.transform(every, lambda j: F.struct(F.lit(True).alias("home"), F.lit(False).alias("probe"), part.alias("i"), j.alias("j")))
    as_probe = F.transform(every, lambda i: F.struct(F.lit(False).alias("home"), F.lit(True).alias("probe"), i.alias("i"), part.alias("j")))
    dealt = F.when(F.col("rows").isNull(), both).when(F.col("home"), F.concat(as_home, as_probe)).otherwise(as_probe)
    return rows.select(*key, "word", "n", F.explode(dealt).alias("d")).select(*key, "word", "n", "d.*")


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, gram_rows: int = GRAM_ROWS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n_near, best): words of the table (word, n) that have others one edit away, how many, and the most frequent of these."""
    blocks = _blocks(words, block_words, least_length)
    key = ["length", "ends", "half", "i", "j"]
    found = blocks.repartition(*key).sortWithinPartitions(*key, "word").mapInArrow(_near_words(gram_rows), "word string, n_near long, best struct<minus_n:long,word:string>")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without cycles: forms are followed to the last by doubling, in rounds by the logarithm of the longest way."""
    now, moved = durable(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while moved:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        last, now = now, durable(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(last)
        moved = now.where("moved").limit(1).count()
        stored = now.stored_at
        now = now.select("word", "root")
        now.stored_at = stored
    return now


def spelling_forms(
    words: DataFrame, times: int = TIMES, block_words: int = BLOCK_WORDS, gram_rows: int = GRAM_ROWS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of a table (word, n) of distinct words of Latin letters.

    Two words are near if one inserted, deleted or replaced code point parts them. Letter counts of a block of words are a matrix; its
    product with another gives squared distances, and pairs at most 2 apart are held against the edit itself. Blocks are of adjacent lengths and of
    words that share a half, which all near pairs do. The form is the near word of largest n, the smallest among equals, if
    that n is at least `times` the word's, and root the last of the forms from word on.

    Words shorter than least_length have no near words. Null words are left out; an empty table gives no rows.
    """
    words = durable(words.select(F.col("word"), F.col("n").cast("long").alias("n")).where("word IS NOT NULL"), "words")
    near = near_words(words, block_words, gram_rows, least_length)
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.minus_n")).alias("best_n"), F.col("best.word").alias("best"))
    fit = F.col("best_n") >= times * F.col("n")
    joined = durable(joined.select("word", F.when(fit, F.col("best")).alias("form"), "n", "n_near", F.when(fit, F.col("best_n")).alias("form_n")), "forms")
    last = roots(joined.where("form IS NOT NULL"))
    out = joined.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of whole texts, damaged by damaged_words(), with their near words, forms and roots.

    Null and empty texts have no words. A word of any length is held whole.
    """
    return spelling_forms(damaged_words(docs))
