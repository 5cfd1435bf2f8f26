"""A training corpus from raw documents: quality rules, line dedup, near-dedup, source mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``documents``; the last returns packed pieces. Stages are written as Parquet and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.llm import rules
from mapstrata.llm.carried import set_aside
from mapstrata.llm.line_dedup import dedup_lines
from mapstrata.llm.mixing import mix_documents
from mapstrata.llm.near_dedup import drop_near_duplicates
from mapstrata.llm.packing import pack
from mapstrata.llm.words import small_batches
from mapstrata.session import checkpoint_folder

TOKENIZER, END_ID = "byte_bpe_50k.json", 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps."""
    small_batches(spark)
    own, back = set_aside(docs, ("text",))
    ledger = rules.quality_ledger(own.withColumn("__raw", F.col("text")), own.columns, text="__raw")
    return back(ledger.where(~rules.fails(rules.POLICY)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that align with an earlier one; those left without a word go."""
    own, back = set_aside(docs, ("doc_id", "text", "n_chars"))
    kept = dedup_lines(own)
    changed = F.col("__removed") > 0
    return back(
        kept.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn(
            "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near duplicates."""
    return drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as their source's share takes them."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2,048."""
    return pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

# Similarity classes and token ids are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages make of ``documents``."""
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
