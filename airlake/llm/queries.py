"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airlake.llm import (
    chat,
    fingerprints,
    knn,
    language_id,
    line_dedup,
    mixing,
    phrases,
    quality,
    secrets,
    sentencepiece_codec,
    simhash,
    variants,
    warc,
)
from airlake.llm.common import table


def piece_model(path: str | None = None) -> bytes:
    """The tokenizer model file, by default the public 32k BPE pieces. It is
    read on the driver and reaches executors in a broadcast."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def q_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return sentencepiece_codec.codec_digest(table(spark, sf, "documents"), piece_model())


def q_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf, "documents"))


def q_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf, "documents"))


def q_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf, "pages"))


def q_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.language_predictions(table(spark, sf, "documents"))


def q_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf, "documents"))


def q_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf, "documents"))


def q_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def q_topk(spark: SparkSession, sf: str) -> DataFrame:
    return knn.nearest_embeddings(table(spark, sf, "embeddings"))


def q_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def q_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


def q_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf, "documents"))


def q_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.conversation_digest(table(spark, sf, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": q_sentencepiece,
        "op2_mixing": q_mixing,
        "op3_line_dedup": q_line_dedup,
        "op4_warc": q_warc,
        "op5_language_id": q_language_id,
        "op6_secrets": q_secrets,
        "op7_fingerprints": q_fingerprints,
        "op8_quality": q_quality,
        "op9_topk": q_topk,
        "op10_simhash": q_simhash,
        "op11_phrases": q_phrases,
        "op12_variants": q_variants,
        "op13_chat": q_chat,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.TAKEN_WORDS_SQL,
        "op3_line_dedup": line_dedup.LINE_DIGEST_SQL,
        "op4_warc": warc.ARCHIVE_DIGEST_SQL,
        "op9_topk": knn.NEAREST_SQL,
        "op11_phrases": phrases.COLLOCATIONS_SQL,
        "op13_chat": chat.CONVERSATION_DIGEST_SQL,
    }
