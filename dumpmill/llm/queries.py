"""The registered queries of this subpackage: thin calls of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, licenses, lines, mixing, packing, quality, rules, search, secrets, simhash, tokens, vectors
from .common import table
from .oracles import ORACLES


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"), bands=lines.BANDS)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).drop("rejected_by")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"), windows=True, full=True)


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_groups(table(spark, sf_dir, "embeddings"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), assigned=True, path="source")
    return found.select("doc_id", "ordinal", F.col("value").alias("finding"), "score", "is_secret")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), live=F.col("live")))


def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_resampling, op2_line_dedup, op3_quality_rules, op4_token_counts, op5_byte_bpe, op6_license_scan, op7_vector_dedup,
        op8_mix_sources, op9_simhash_groups, op10_secret_scan, op11_ranked_search, op12_conversation_repair, op13_harmonic_packing, pipeline)
}
