"""A quality classifier: logistic regression on hashed word n-grams, trained by follow the regularised leader."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, mix

#: A word is a run of letters and digits, or one of other visible characters (bytes over 127 are letters).
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")
BITS = 18
EPOCHS = 2


def features(text: bytes | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    """Hashed feature numbers of a text: its words, its word pairs, and a mark for each word said twice in a row."""
    words = TOKEN.findall(text or b"")
    if not words:
        return np.empty(0, np.int64)
    h = hashes.of(words)
    pairs = np.where(h[:-1] == h[1:], np.uint64(0x5851F42D4C957F2D), h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return (mix(np.concatenate([h, pairs])) >> np.uint64(64 - bits)).astype(np.int64)


def _vector(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their counts, damped by a square root and scaled to length 1."""
    at, n = np.unique(found, return_counts=True)
    x = np.sqrt(n)
    return at, x / max(1.0, float(np.sqrt((x * x).sum())))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for a sparse logistic regression with a bias."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-float(np.clip(w @ x, -35, 35)))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, marks: DataFrame, most_rows: int = 8_000, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """Weights, bias last, learnt from docs (doc_id, text) under marks (doc_id, label).

    At most about most_rows marks are learnt from, drawn by a hash of the id: that bounds both
    what is broadcast to find their texts and the model's one sequential task, not what is scored.
    Null labels are left out; no rows, or those of one label, still give a model. The result is
    2**bits + 1 numbers.
    """
    known = marks.where("label is not null and doc_id is not null")
    share = min(1.0, most_rows / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def found(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            vectors = [features(t, hashes, bits).astype(np.int32).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(vectors, pa.binary())], ["draw", "key", "label", "found"])

    def learn(batches):
        import pyarrow as pa

        model, held = Ftrl(bits), []
        for batch in batches:
            held += zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        for _ in range(epochs):
            for label, vector in held:
                model.learn(*_vector(np.frombuffer(vector, np.int32).astype(np.int64)), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], ["weights"])

    texts = rows.select("draw", F.col("doc_id").cast("string"), F.col("label").cast("int"), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    vectors = texts.mapInArrow(
        found, "draw long, key string, label int, found binary"
    )
    one = vectors.repartition(1).sortWithinPartitions("draw", "key", "label", "found")
    learnt = one.mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(learnt[0][0]) if learnt else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """docs with a column `score` more, from 0 to 1, of whole texts; null and empty texts score by the bias alone."""
    sparse = weights.astype(np.float32)
    schema = docs.select("*", F.lit(0.0).alias("score")).schema
    column = docs.columns.index(text_col)

    def scored(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        hashes = WordHashes()
        for batch in batches:
            out = []
            for text in pc.cast(batch.column(column), pa.binary()).to_pylist():
                at, x = _vector(features(text, hashes, bits))
                out.append(1 / (1 + np.exp(-float(np.clip(sparse[at] @ x + sparse[-1], -35, 35)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], schema=pa.schema([*batch.schema, pa.field("score", pa.float64())]))

    return docs.mapInArrow(scored, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **training) -> DataFrame:
    """docs with held_out, score and predicted (1 from `threshold` on).

    labels: (doc_id, quality), other columns of it aren't read; of a document labelled twice the least label counts; a score equal to the
    threshold is 1. Empty and null texts score by the bias alone, whole texts of any length are read. Documents of
    null id are scored and never learnt from. A column of docs that has the name of an added one
    is replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    marks = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("label"))
    scored = score(docs, train(docs, marks, **training))
    return scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
