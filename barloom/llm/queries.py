"""The registered queries of the text operators: each runs its operator over a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.conversations import repaired_conversations
from barloom.llm.licenses import license_sql, scan_licenses
from barloom.llm.mixing import MIX_SQL, mix_sources
from barloom.llm.near_dedup import near_duplicates
from barloom.llm.ogg import media_round_trip
from barloom.llm.packing import pack_documents
from barloom.llm.piecewise import edited_likeness
from barloom.llm.private import private_data
from barloom.llm.quality import quality_scores
from barloom.llm.sharding import shard_documents, shard_sql
from barloom.llm.spelling import spelling_variants
from barloom.llm.substring_dedup import dedup_passages
from barloom.llm.warc import ARCHIVE_SQL, archive_round_trip

SHARD_BYTES = 1 << 20


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_read(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_read(spark, sf_dir, "documents"), percent=80)


def op3_superminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, percent=80)


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_read(spark, sf_dir, "documents"), SHARD_BYTES)


def op5_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(_read(spark, sf_dir, "documents"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(_read(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "text", "size(removed) AS n_removed", "removed", "kept_spans", "array_distinct(removed.first_id) AS first_ids"
    )


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)


def op8_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_round_trip(_read(spark, sf_dir, "documents"))


def op9_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), room=2048)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(_read(spark, sf_dir, "conversations"))


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_arc_to_warc": op1_arc_to_warc,
    "op2_license_scan": op2_license_scan,
    "op3_superminhash_near_dedup": op3_superminhash_near_dedup,
    "op4_extendible_shards": op4_extendible_shards,
    "op5_piecewise_fingerprints": op5_piecewise_fingerprints,
    "op6_passage_dedup": op6_passage_dedup,
    "op7_systematic_mix": op7_systematic_mix,
    "op8_ogg_media": op8_ogg_media,
    "op9_quality_ftrl": op9_quality_ftrl,
    "op10_bin_completion": op10_bin_completion,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_private_data": op13_private_data,
}

#: Signatures, fingerprints, containers, trained weights and searched fillings have no SQL form.
ORACLE: dict[str, str] = {
    "op1_arc_to_warc": ARCHIVE_SQL,
    "op2_license_scan": license_sql(),
    "op4_extendible_shards": shard_sql(SHARD_BYTES),
    "op7_systematic_mix": MIX_SQL,
}
