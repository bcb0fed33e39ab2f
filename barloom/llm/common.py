"""Pieces that several text operators share: durable intermediate tables, word hashing, shingle sets."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key of more than 1 in HOT_SHARE of all rows, and of more than HOT_ROWS, is hot; so there are HOT_SHARE hot keys at most.
HOT_ROWS, HOT_SHARE = 10_000, 20_000
#: ASCII white space; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only a local session may go without one: it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def durable(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cut lineage that outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables that durable() stored and that nothing still to be run reads."""
    for table in tables:
        spark, path = table.sparkSession, table.__dict__.pop("stored_at", None)
        if path:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def meet(rows: DataFrame, table: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """rows (a stored table) with the columns of table that share their keys: an inner join that gathers no hot key.

    table has each key once, with the number of its rows in the column n. The hot keys are at most HOT_SHARE, by
    their share of all rows, so they are broadcast and their rows stay where they lie; all others meet by a shuffle.
    """
    bound = max(HOT_ROWS, rows.count() // HOT_SHARE)
    hot = F.broadcast(table.where(F.col(n) > bound))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(table.where(F.col(n) <= bound), keys)
    return cold.unionByName(rows.join(hot, keys))


def n_words(text: Column) -> Column:
    """Words of a text as a bigint; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class WordHashes(dict):
    """word, as bytes or str -> 64-bit hash, remembered for up to `limit` words at a time."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes | str) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _odd(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the `size`-word shingles of a UTF-8 text, A-Z lower-cased.

    A text of fewer words is one shingle as a whole; one without words has none.
    bytes.lower and bytes.split act on ASCII alone, as the definition of a word asks.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    width = min(size, len(words))
    odd, n = _odd(size + 1), len(words) - width + 1
    out = np.full(n, odd[size]) * np.uint64(width)
    for i in range(width):
        out += h[i : i + n] * odd[i]
    return np.unique(mix(out))


def in_schema_order(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])
