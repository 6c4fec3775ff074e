"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (cuckoo, filter_audit, hilbert, lines, merges, mixing, planes, prefix_trie, pstable, quality, secret_scan, simhash,
               toxicity)
from .common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of every document, read back."""
    return planes.token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20."""
    return hilbert.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that occur, or nearly occur, before."""
    return lines.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"), counts=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes decoded from them."""
    return merges.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), ["doc_id"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document: 4-word shingles, 4 bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, radius=4)


def op9_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.93 within its label."""
    return pstable.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the base patterns and random-looking tokens."""
    return secret_scan.find_secrets(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each order of the five filters removes at each step, by source."""
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays, group size and digest of every document's lower-cased text."""
    return cuckoo.exact_duplicates(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_mixing, op3_token_files, op4_hilbert, op5_line_dedup, op6_toxicity, op7_byte_bpe,
                                   op8_simhash, op9_pstable, op10_secrets, op11_filter_audit, op12_exact_dedup, op13_prefix_trie)}
ORACLES: dict[str, str] = {"op11_filter_audit": filter_audit.ORACLE_SQL, "op12_exact_dedup": cuckoo.ORACLE_SQL,
                           "op13_prefix_trie": prefix_trie.ORACLE_SQL}
