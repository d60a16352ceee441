"""Queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvia.llm import ann, bpe, chat, jaccard, lm, mixing, quality, rules, sharding, substring
from fluvia.llm import _blocks as B


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_read(spark, sf_dir, "documents"), vocabulary(), ids=False)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_read(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(_read(spark, sf_dir, "documents"), words=4, threshold=0.85)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.formatted(turns.unionByName(chat.test_conversation(spark))))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in three arrivals, compacted; the rows that the last manifest names, with a digest of each text."""
    docs = _read(spark, sf_dir, "documents")
    store = sharding.Store(spark, f"{B.shared_folder(spark)}/store-{uuid.uuid4().hex}")
    arrival = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(3)), F.lit(0))
    for k in range(3):
        store.append(docs.where(arrival == k))
    version = store.manifest()["version"]
    while (after := store.compact()) != version:
        version = after
        store.vacuum()
    return store.read().select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(_read(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_read(spark, sf_dir, "documents")).drop("text")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_read(spark, sf_dir, "embeddings"), every=100, k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_bpe, op2_lm_scoring, op3_quality_classifier, op4_ngram_jaccard, op5_chat_formatting, op6_mixing, op7_sharding, op8_quality_rules, op9_substring_dedup, op10_nearest_neighbours)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_formatting": chat.SQL,
        "op7_sharding": "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents",
        "op8_quality_rules": rules.SQL,
    }
