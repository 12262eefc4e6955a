"""From raw documents to packed sequences: five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``; labels come from ``sf_dir``.

Defined results: NULL and empty texts pass the toxicity stage, which finds
nothing in them, and are judged by the quality model like any other; rows with a
NULL id can't be told apart by id, so each of them is judged by its own text; an
id that stands on several texts keeps one row for each group of near-duplicates
whose smallest id it is; an empty table gives no rows.  Other columns pass through
under any name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, quality, simhash, substrings, toxicity
from tidemark.llm.common import free_name
from tidemark.session import cut_lineage, table

#: No SQL states the trained scores, the fingerprints' components or the packing.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model doesn't call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "toxicity_score")
    return toxicity.with_score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking doesn't put below its cut."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality_score")
    return quality.with_score(docs, model, name).where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Of rows that repeat the kept id, one with the group's fingerprint stays; only
    rows with such ids are fingerprinted again and shuffled with their texts.
    """
    found = cut_lineage(simhash.near_duplicates(docs, simhash.SHINGLE_WORDS, simhash.DISTANCE, groups=True))
    kept = found.where(F.col("doc_id") == F.col("component_id")).groupBy("root").agg(
        F.min("doc_id").alias("doc_id"), F.min("fingerprint").alias("fingerprint")
    )
    times = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    # the same plan at every size: the kept ids grow with the documents
    kept = cut_lineage(kept.join(times, "doc_id")).hint("merge")
    once = docs.join(kept.where("times = 1").select("doc_id"), "doc_id", "left_semi")
    repeated = docs.join(kept.where("times > 1").select("doc_id").distinct(), "doc_id", "left_semi")
    fp, name = free_name(docs, "fp"), free_name(docs, "fingerprint")
    several = simhash.with_fingerprint(repeated, fp).withColumn(name, simhash.printed(fp))
    chosen = kept.where("times > 1").select("doc_id", F.col("fingerprint").alias(name))
    several = several.join(chosen, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    unnamed = docs.where(F.col("doc_id").isNull())
    return once.select(*docs.columns).unionAll(several.select(*docs.columns)).unionAll(unnamed.select(*docs.columns))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that one with a smaller id has too.

    A cut may leave part of a character's bytes; such bytes go as well.
    """
    out = substrings.remove_repeats(docs, as_text=True)
    out = out.withColumnRenamed(out.columns[-1], "text")  # what stays is the last column, whatever its free name
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", simhash_stage),
    ("suffix-array dedup", suffix_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
