"""The registered query of each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.llm import ann, quality_classifier, rules
from mapstrata.llm.line_dedup import dedup_lines
from mapstrata.llm.mixing import allocated, mix_plan, sized
from mapstrata.llm.near_dedup import near_duplicates
from mapstrata.llm.packing import pack
from mapstrata.llm.periodic_runs import find_runs, run_digest
from mapstrata.llm.pii import BASE_KINDS, KINDS, count_of, pii_spans, spans_text
from mapstrata.llm.prefix_trie import conversation_paths, trie_nodes
from mapstrata.llm.substring_dedup import remove_repeats
from mapstrata.llm.token_files import read_token_files, write_token_files
from mapstrata.llm.tokens import crc32_of, vocabulary_dtype
from mapstrata.llm.url_filters import Rule, judge_urls
from mapstrata.llm.words import small_batches
from mapstrata.session import checkpoint_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"

# The url rules of the contract.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality_classifier.described(table(spark, sf_dir, "documents"))
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sized(table(spark, sf_dir, "documents"))
    return allocated(rows, mix_plan(rows)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    folder = f"{checkpoint_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), folder, path, end_id=2)
    found = read_token_files(spark, folder)
    return found.select("doc_id", "start", "n_tokens", crc32_of("ids", vocabulary_dtype(path)).alias("ids_crc32"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("__removed").alias("n_removed"), F.length("text").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


@query
def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    pieces = pack(table(spark, sf_dir, "documents"), path, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", crc32_of("ids", vocabulary_dtype(path)).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = ann.search(vectors, vectors.where("id % 20 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rules.quality_ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "failed_bits",
        rules.fails(rules.BASE_POLICY).alias("base_failed"),
        (~rules.fails(rules.POLICY)).alias("kept"),
    )


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", pii_spans("text").alias("pii"))
    spans = F.col("pii")
    return found.select(
        "doc_id",
        *[count_of(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(spans_text(spans, BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        spans_text(spans, KINDS).alias("spans"),
    )


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(conversation_paths(table(spark, sf_dir, "conversations"), rebuild=True))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(find_runs(table(spark, sf_dir, "documents")))
