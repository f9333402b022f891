"""The operators of this package as runnable queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import oracles
from orderlake.llm.hard_negatives import mine_negatives
from orderlake.llm.language_id import identify_languages
from orderlake.llm.license_scan import scan_licenses
from orderlake.llm.nearest import nearest_vectors
from orderlake.llm.packing import pack_apart
from orderlake.llm.piece_tokens import piece_digests
from orderlake.llm.quality_cnn import classify_quality
from orderlake.llm.quality_rules import RULE_COLUMNS, apply_rules
from orderlake.llm.simhash import simhash_components
from orderlake.llm.source_audit import audit_sources
from orderlake.llm.surrogates import replace_entities
from orderlake.llm.tables import read_table
from orderlake.llm.token_files import token_digests, write_token_files
from orderlake.llm.vector_dedup import similar_vectors
from orderlake.session import scratch_path

#: Key of the registered query's surrogates; users bring a secret of their own.
SURROGATE_KEY = "orderlake"

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[function.__name__] = function
    return function


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash_components(read_table(spark, sf_dir, "documents"))


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    return pack_apart(read_table(spark, sf_dir, "documents"))


@_query
def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return classify_quality(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


LLM_ORACLES["op4_license_scan"] = oracles.LICENSE_SCAN


@_query
def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return similar_vectors(read_table(spark, sf_dir, "embeddings"))


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select("doc_id", *[c for c in RULE_COLUMNS if c != "clean_text"])


LLM_ORACLES["op6_quality_rules"] = oracles.QUALITY_RULES


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, read back from the files written."""
    path = scratch_path(spark, "token-files")
    write_token_files(
        read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return token_digests(spark, path)


@_query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    return identify_languages(read_table(spark, sf_dir, "documents"))


@_query
def op9_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's SentencePiece ids and of the text decoded from them."""
    return piece_digests(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@_query
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of its personal data."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY)


@_query
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the words of every source differ from its language's and from other sources'."""
    return audit_sources(read_table(spark, sf_dir, "documents"))


LLM_ORACLES["op11_source_audit"] = oracles.SOURCE_AUDIT


@_query
def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found of every hundredth id."""
    return nearest_vectors(read_table(spark, sf_dir, "embeddings"))


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth id, where every seventh has a wrong label."""
    vectors = read_table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", wrong))


LLM_ORACLES["op13_hard_negatives"] = oracles.HARD_NEGATIVES
