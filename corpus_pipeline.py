"""From raw documents to token ids: language ID, near-dedup, decontamination, mixing, ids.

Each stage takes the documents its predecessor kept and reads nothing else but
the benchmark. Between stages the documents are written as Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.llm import decontaminate, language, mixing, simhash, token_ids
from orelake.llm.common import stored, table
from orelake.session import scratch_dir

TOKENIZER = "byte_bpe_50k.json"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: null texts and texts without a letter
    go, and those whose score is lower than that of nearly all held-out texts of
    their size."""
    model = language.fit(docs)
    return language.keep_known(docs, model, language.limits(docs, model))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with fewer than one word in twenty from windows of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of smaller sources again, up to the repetition limit,
    sorted as the mixture is to be read."""
    return mixing.in_order(mixing.mixed(docs)).select(*[f"`{c}`" for c in docs.columns])


def file_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns that give the place of a row in the files they are read
    from, and their names; documents that come from no files are ordered by id."""
    places = {"__llm_file": "_metadata.file_name", "__llm_row": "_metadata.row_index"}
    try:
        return docs.select("doc_id", "text", *[F.col(c).alias(n) for n, c in places.items()]), list(places)
    except AnalysisException:
        return docs, ["doc_id"]


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in Elias-Fano blocks in the order of the mixture, read back as one row
    (doc_id, start, n_tokens, ids_crc32) per use."""
    path = f"{scratch_dir(spark, 'llm')}/ids"
    placed, order = file_order(docs)
    token_ids.write_ids(placed, path, public_tokenizers.path(TOKENIZER), order=order)
    return token_ids.read_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

ORACLE_SQL: str | None = None  # neither the classifier nor the tokenizer has an SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
