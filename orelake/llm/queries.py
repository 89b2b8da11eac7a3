"""The operators applied to their whole tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.llm import (
    conversations, decontaminate, language, line_dedup, merkle, mixing, passages, pitman_yor, sentence_pieces, simhash,
    token_ids, url_templates, vafile,
)
from orelake.llm.common import table
from orelake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.topk(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    labels = url_templates.page_labels(pages, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return url_templates.judged(pages, labels)


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'llm')}/ids"
    token_ids.write_ids(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path(TOKENIZER))
    return token_ids.read_digests(spark, path)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language.predict(docs, language.fit(docs))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per use of a document in the mixture."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mixed(docs).select("doc_id", "source", "epoch", "place")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = sentence_pieces.encoded(docs, public_tokenizers.path(PIECES))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents", *merkle.FIELDS))


def queries() -> dict[str, Query]:
    return {
        "op1_vafile": op1_vafile,
        "op2_url_templates": op2_url_templates,
        "op3_token_ids": op3_token_ids,
        "op4_language": op4_language,
        "op5_pitman_yor": op5_pitman_yor,
        "op6_mixing": op6_mixing,
        "op7_line_dedup": op7_line_dedup,
        "op8_passages": op8_passages,
        "op9_simhash": op9_simhash,
        "op10_decontaminate": op10_decontaminate,
        "op11_sentence_pieces": op11_sentence_pieces,
        "op12_conversations": op12_conversations,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_vafile": vafile.ORACLE,
        "op2_url_templates": url_templates.ORACLE,
        "op10_decontaminate": decontaminate.ORACLE,
        "op12_conversations": conversations.ORACLE,
        "op13_merkle": merkle.ORACLE,
    }
