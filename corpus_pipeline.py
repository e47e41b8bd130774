"""From raw documents to token ids in five stages, each written as Parquet for the next.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpmill.llm import bpe, lines, mixing, quality, simhash
from dumpmill.llm.common import scratch, table, written
from dumpmill.llm.queries import tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps. Null, empty and wordless texts go; rows that tie at the cut
    and repeated rows stay; a text of any length is scored whole."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came before in the corpus; those left without a word go. Null texts stay as they
    are, rows without a doc_id pass unchanged, rows that share one count as one document."""
    return lines.dedup_lines(docs, bands=lines.BANDS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id. Texts without a word are one group;
    of rows without a doc_id one stays for each fingerprint whose group has no doc_id."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. A null source is one of its own, texts without a word are not taken."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, token_ids, token_ends, decoded_sha256) of each document; the last is the hash of
    the bytes that the ids decode to. A null text is empty; repeated rows are encoded row by row."""
    own = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer("byte_bpe_multi_50k.tiktoken"), decoded="decoded")
    return own.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "token_ends", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: SQL can express neither the classifier nor the edit join; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. What a stage has written for itself is removed once its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as own:
            docs = own.kept(written(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
