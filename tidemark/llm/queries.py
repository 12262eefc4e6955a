"""Registered queries of this subpackage, with their contracts' columns."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    crosspolytope,
    extraction,
    language,
    learned_partitions,
    manifest,
    mixing,
    oracle,
    packing,
    quality,
    simhash,
    substrings,
    toxicity,
    trie,
)
from tidemark.session import table

VOCABULARY = "word_bpe_49k.json"


def ann(spark: SparkSession, root: str) -> DataFrame:
    return learned_partitions.search(table(spark, root, "embeddings"), F.col("vec_id") % 100 == 0)


def quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, root, "labels")))


def embedding_dedup(spark: SparkSession, root: str) -> DataFrame:
    return crosspolytope.near_duplicates(table(spark, root, "embeddings"))


def html_extraction(spark: SparkSession, root: str) -> DataFrame:
    return extraction.extract(table(spark, root, "pages"))


def suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, root, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def toxicity_scores(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, root, "labels")))


def language_id(spark: SparkSession, root: str) -> DataFrame:
    return language.identify(table(spark, root, "pages"), language.fit(table(spark, root, "documents")))


def simhash_dedup(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


def packed(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"), public_tokenizers.path(VOCABULARY))


def bpe_round_trip(spark: SparkSession, root: str) -> DataFrame:
    return bpe.digests(table(spark, root, "documents"), public_tokenizers.path(VOCABULARY))


def merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Texts of every fifth id are lower-cased after the manifest was made, and fail it if that changes them."""
    documents = table(spark, root, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claimed = F.when(tampered, manifest.leaf_digest(*values, lower))
    return manifest.manifest(documents, "doc_id", "source", manifest.leaf_digest(*values, F.col("text")), claimed)


def mixed_sources(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.mix(table(spark, root, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def conversation_trie(spark: SparkSession, root: str) -> DataFrame:
    return trie.conversation_trie(table(spark, root, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_learned_partitions": ann,
    "op2_bradley_terry_quality": quality_classifier,
    "op3_cross_polytope_dedup": embedding_dedup,
    "op4_page_differencing": html_extraction,
    "op5_suffix_dedup": suffix_dedup,
    "op6_toxicity": toxicity_scores,
    "op7_language_id": language_id,
    "op8_simhash_blocks": simhash_dedup,
    "op9_packing": packed,
    "op10_bpe": bpe_round_trip,
    "op11_merkle_manifest": merkle_manifest,
    "op12_source_mix": mixed_sources,
    "op13_conversation_trie": conversation_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op11_merkle_manifest": oracle.MANIFEST,
    "op12_source_mix": oracle.MIX,
    "op13_conversation_trie": oracle.TRIE,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
