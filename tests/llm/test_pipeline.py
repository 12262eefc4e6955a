"""The pipeline's stages against the operators they call, and on awkward input."""

import corpus_pipeline as cp
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import queries, simhash


def test_stages_keep_columns_and_decide(spark):
    small = "/root/testdata/sf0.01"  # the smallest table has too few labelled toxic documents to learn from
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    for name, stage in cp.STAGES[:2]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and 0 < out.count() < docs.count(), name
        clean = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).join(docs, "doc_id")
        kept = clean.join(out, "doc_id", "left_semi").count()
        assert kept >= 0.95 * clean.count(), name
    found = simhash.near_duplicates(docs)
    out = cp.simhash_stage(spark, docs, small)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(
        r[0] for r in found.select("component_id").distinct().collect()
    )


def test_repeated_ids_keep_one_row_of_each_group(spark, small):
    a, b = "one two three four five six seven", "quite another text with other words in it"
    for ids, want in (([(5, a), (5, b)], [(5, a), (5, b)]), ([(3, a), (5, a), (5, b), (5, b)], [(3, a), (5, b)])):
        docs = spark.createDataFrame(ids, "doc_id long, text string").withColumn("fp", F.lit("x"))
        got = cp.simhash_stage(spark, docs, small)
        assert got.columns == docs.columns and sorted((r.doc_id, r.text) for r in got.collect()) == want


def test_run_packs_what_the_stages_keep(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, small)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = cp.run(spark, small).groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {k: (n, n) for k, n in tokens.items()}


def test_awkward_rows_pass_every_stage(spark, small):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words here", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            assert stage(spark, frame, small).columns == frame.columns
            stage(spark, frame, small).collect()
    pieces = cp.packing_stage(spark, docs, small).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(p.length for p in pieces) == wanted


def test_registered():
    assert [n.split("_")[0] for n in queries.QUERIES][:-1] == [f"op{i}" for i in range(1, 14)]
