"""The text pipeline: quality, near duplicates, repeated passages, mixing and packing, each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import durable
from barloom.llm.mixing import mixed_documents
from barloom.llm.near_dedup import near_duplicates
from barloom.llm.packing import pack_documents
from barloom.llm.quality import quality_scores
from barloom.llm.substring_dedup import dedup_passages


def _apart(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): all other columns in one, so that none can have the name of a column that a stage adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")


def _together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again, texts as they are now and n_chars to match."""
    now = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.lit(0)).cast("long")}
    return rows.select(*[now.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels outside the held-out fold. Null and empty texts are scored by the bias alone."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_scores(_apart(docs), labels).where("predicted = 1")
    return scored.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id; null ids rank last.

    Rows are told apart by a number of their own, so rows of null id or of one id are documents like any other: only those
    go whose own text has a near duplicate that stays. Texts without words are linked with nothing and stay.
    """
    numbered = durable(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    placed = numbered.select("__row", "doc_id").join(found, "__row")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "__row")
    least = placed.groupBy("component_id").agg(F.min(rank).alias("x")).select(F.col("x.__row").alias("__row"))
    return numbered.join(least, "__row", "left_semi").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; texts of which nothing is left go, those that were null or empty stay."""
    cut = dedup_passages(_apart(docs))
    return _together(cut.where((F.size("removed") == 0) | F.col("text").rlike(r"\S")), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it; null is a source of its own, and documents without words are never taken."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: Trained weights, signatures and a search for fillings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
